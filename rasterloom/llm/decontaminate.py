"""Benchmark decontamination by winnowing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rasterloom.llm import words as W
from rasterloom.llm.tables import numbered, schema, stored

WINDOW = 10
#: The fingerprint bitmap grows with the benchmark up to this size (1 MB), then it only filters less.
MAX_BITS = 1 << 23

HITS = "array<struct<pos:int,len:int,h1:bigint,h2:bigint>>"
HIT = pa.struct([("pos", pa.int32()), ("len", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])


def fingerprinted(words, size):
    """Windows of ``size`` words: first word, fingerprint and the window's two hashes.

    The fingerprint is the least k-gram hash of the window. Neighbouring windows mostly share it,
    which is what winnowing keeps of a text.
    """
    at, _, gram = words.anchors(size)
    return at, W.mix(gram, seed=size), words.hashes(at, at + size, 0), words.hashes(at, at + size, 1)


def _item_windows(window):
    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                words = W.NamedWords(part.column("text"), W.ALNUM)
                item = part.column("item")
                for size in range(1, window + 1):
                    at, print_, h1, h2 = fingerprinted(words, size)
                    own = (words.counts == size) | ((size == window) & (words.counts > window))
                    keep = own[words.row[at]]
                    if keep.any():
                        yield pa.RecordBatch.from_arrays([
                            item.take(pa.array(words.row[at[keep]])), pa.array(np.full(keep.sum(), size, np.int32)),
                            *(pa.array(W.signed(x[keep])) for x in (print_, h1, h2)),
                        ], ["item", "len", "print", "h1", "h2"])
    return run


def _document_hits(bitmap, sizes, keep):
    def run(batches):
        bits = bitmap.value
        mask = W.U64(64 * len(bits) - 1)
        for batch in batches:
            for part in W.slices(batch, "text"):
                words = W.NamedWords(part.column("text"), W.ALNUM)
                found = []
                for size in sizes:
                    at, print_, h1, h2 = fingerprinted(words, size)
                    spot = print_ & mask
                    near = np.flatnonzero(bits[(spot >> W.U64(6)).astype(np.int64)] >> (spot & W.U64(63)) & W.U64(1))
                    found.append((at[near], np.full(len(near), size, np.int32), W.signed(h1[near]), W.signed(h2[near])))
                at, size, h1, h2 = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 4
                order = np.argsort(at, kind="stable")
                at, size, h1, h2 = at[order], size[order], h1[order], h2[order]
                pos = (at - words.first[words.row[at]]).astype(np.int32)
                hits = pa.StructArray.from_arrays([pa.array(pos), pa.array(size.astype(np.int32)), pa.array(h1), pa.array(h2)], fields=list(HIT))
                bounds = pa.array(np.searchsorted(at, words.first).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), part.column("uid"), pa.array(words.counts.astype(np.int64)), pa.ListArray.from_arrays(bounds, hits)],
                    [*keep, "uid", "n_words", "hits"])
    return run


def _merged(batches):
    """Windows of each row, sorted, to the stretches that they cover; windows that overlap or touch make one."""
    for batch in batches:
        at = batch.column("at")
        inner, bounds = at.flatten(), at.offsets.to_numpy()
        bounds = bounds - bounds[0]
        row = np.repeat(np.arange(batch.num_rows), np.diff(bounds)) << 32  # rows lie apart
        pos, end = (inner.field(c).to_numpy().astype(np.int64) + row for c in ("pos", "end"))
        reach = np.maximum.accumulate(end) if len(end) else end
        first = np.flatnonzero(np.append(True, pos[1:] > reach[:-1])) if len(pos) else np.zeros(0, np.int64)
        last = np.append(first[1:], len(pos)) - 1
        spans = pa.StructArray.from_arrays(
            [pa.array((x & 0xFFFFFFFF).astype(np.int32)) for x in (pos[first], reach[last] if len(first) else reach)], names=["pos", "end"])
        yield pa.RecordBatch.from_arrays(
            [batch.column("uid"), pa.ListArray.from_arrays(pa.array(np.searchsorted(first, bounds).astype(np.int32)), spans), batch.column("items")],
            ["uid", "spans", "items"])


def contamination(docs, benchmark, window=WINDOW, keep=("doc_id",)):
    """Words of each document that lie in an occurrence of a window of benchmark words.

    ``docs``: text and the columns to ``keep``; ``benchmark``: item_id, text. Other columns are ignored. A window is
    ``window`` consecutive words of an item, or the whole of a shorter item. Null and empty texts
    have no words and hit nothing; a null item_id counts as the empty string; repeated rows are
    judged one by one; an empty benchmark leaves every document clean.

    Winnowing keeps of every window its least k-gram hash (k = half a window), so each shared window
    shares a fingerprint: the guarantee is exact at the window's own length. Document fingerprints
    are joined with the benchmark's in two steps. A bitmap of at most 1 MB of the benchmark's
    fingerprints goes to all tasks and holds back what cannot match. Around what is left, matches are
    extended to the windows that the fingerprint stands for, as two independent hashes of their words, and
    joined on both. Overlapping windows merge to spans.

    Returns the kept columns, uid, n_words, spans (array of struct(pos, end) in words), items (sorted ids).
    """
    spark = docs.sparkSession
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text")
    known = stored(items.mapInArrow(_item_windows(window), "item string, len int, print bigint, h1 bigint, h2 bigint"), "items")
    sizes = sorted(r[0] for r in known.select("len").distinct().collect())  # at most ``window`` numbers
    want = 16 * max(256, known.agg(F.count_distinct("print")).first()[0])
    bits = min(MAX_BITS, 1 << (want - 1).bit_length())
    cell = known.select(F.expr(f"shiftrightunsigned(print & {bits - 1}L, 6)").alias("cell"), F.expr("shiftleft(1L, cast(print & 63L as int))").alias("bit"))
    bitmap = np.zeros(bits // 64, W.U64)
    for r in cell.groupBy("cell").agg(F.bit_or("bit").alias("bit")).toLocalIterator():  # at most bits / 64 rows
        bitmap[r.cell] = r.bit % (1 << 64)
    rows = numbered(docs, *dict.fromkeys([*keep, "text"])).mapInArrow(
        _document_hits(spark.sparkContext.broadcast(bitmap), sizes, keep), schema(docs, keep, f"uid bigint, n_words bigint, hits {HITS}"))
    rows = stored(rows, "hits")
    found = rows.select("uid", F.explode("hits").alias("hit")).select("uid", "hit.*").join(known.select("h1", "h2", "item").distinct(), ["h1", "h2"])
    found = found.groupBy("uid").agg(
        F.sort_array(F.collect_set(F.struct("pos", (F.col("pos") + F.col("len")).alias("end")))).alias("at"),
        F.sort_array(F.collect_set("item")).alias("items"))
    spans = found.mapInArrow(_merged, "uid bigint, spans array<struct<pos:int,end:int>>, items array<string>")
    return rows.drop("hits").join(spans, "uid", "left")
