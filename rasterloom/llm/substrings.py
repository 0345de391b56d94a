"""Removal of passages that occur more than once, by counting the windows that share an anchor."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rasterloom.llm import words as W
from rasterloom.llm.tables import numbered, spread_join, stored

WINDOW = 35


def kept_hash(words, row, gone=None):
    """SHA-256 of a row's words, without those marked in ``gone``, joined by one space."""
    low, high = words.first[row], words.first[row + 1]
    start, end, data = words.start[low:high], words.end[low:high], words.data
    if gone is not None:
        start, end = start[~gone], end[~gone]
    if not len(start):
        return hashlib.sha256(b"").hexdigest()
    # Copy the bytes of the kept words and one byte behind each; that byte becomes the space.
    size = end - start + 1
    to = np.cumsum(size)
    index = np.arange(to[-1]) + np.repeat(start - (to - size), size)
    index[to - 1] = start[0]
    out = data[index]
    out[to - 1] = 32
    return hashlib.sha256(out[:-1].tobytes()).hexdigest()


def _lists(at, words, rows, *values):
    bounds = pa.array(np.searchsorted(at, words.first).astype(np.int32))
    return [pa.ListArray.from_arrays(bounds, pa.array(v)) for v in values]


def _index(window):
    """One row per document: identity of its word sequence, digest, and the anchors of its windows."""
    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                words = W.NamedWords(part.column("text"), W.PLAIN)
                _, anchor, gram = words.anchors(window)
                first = np.ones(len(anchor), bool)
                first[1:] = anchor[1:] != anchor[:-1]
                anchor, gram = anchor[first], W.signed(gram[first])
                pos = (anchor - words.first[words.row[anchor]]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column("uid"), part.column("doc_id"), part.column("mark"), pa.array(words.counts.astype(np.int64)),
                    pa.array(W.signed(words.sequences(0))), pa.array(W.signed(words.sequences(1))),
                    pa.array([kept_hash(words, r) for r in range(words.rows)]), *_lists(anchor, words, words.rows, gram, pos),
                ], ["uid", "doc_id", "mark", "n_words", "h1", "h2", "whole", "gram", "pos"])
    return run


def _same(part, words):
    """Rows whose text is the one the index was made of, should two texts of an id have one mark."""
    return (W.signed(words.sequences(0)) == part.column("h1").to_numpy()) & (W.signed(words.sequences(1)) == part.column("h2").to_numpy())


def _candidates(window):
    """Windows whose anchor's hash occurs elsewhere too."""
    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                words = W.NamedWords(part.column("text"), W.PLAIN)
                at, anchor, _ = words.anchors(window)
                seeds = part.column("seeds")
                counts = np.diff(seeds.offsets.to_numpy())
                known = seeds.flatten().to_numpy().astype(np.int64) + np.repeat(words.first[:-1], counts)
                hot = np.zeros(len(words) + 1, bool)
                hot[known[np.repeat(_same(part, words), counts)]] = True
                at = at[hot[anchor]]
                yield pa.RecordBatch.from_arrays([
                    part.column("uid").take(pa.array(words.row[at])), pa.array((at - words.first[words.row[at]]).astype(np.int32)),
                    *(pa.array(W.signed(words.hashes(at, at + window, lane))) for lane in (0, 1)),
                ], ["uid", "start", "w1", "w2"])
    return run


def covered(starts, window):
    """Stretches of one document that windows cover.

    ``starts``: sorted first words of windows that occur elsewhere. Windows that overlap or touch make
    one stretch, whatever documents their other occurrences are in.
    """
    cut = np.flatnonzero(np.diff(starts) > window) + 1
    return [(int(x[0]), int(x[-1]) + window) for x in np.split(starts, cut)] if len(starts) else []


def _parse(window):
    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                words = W.NamedWords(part.column("text"), W.PLAIN)
                same = _same(part, words)
                out = []
                for row in np.flatnonzero(same).tolist():
                    starts = np.sort(part.column("starts")[row].values.to_numpy())
                    spans = covered(starts, window)
                    gone = np.zeros(words.first[row + 1] - words.first[row], bool)
                    for low, high in spans:
                        gone[low:high] = True
                    out.append((part.column("uid")[row].as_py(), [{"pos": a, "end": b} for a, b in spans], int(gone.sum()), kept_hash(words, row, gone)))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out) if out else [[]] * 4, PARSED)], names=list(PARSED_NAMES))
    return run


SPANS = pa.list_(pa.struct([("pos", pa.int32()), ("end", pa.int32())]))
PARSED = [pa.int64(), SPANS, pa.int64(), pa.string()]
PARSED_NAMES = ["uid", "spans", "n_removed", "kept_sha256"]


def repeated_passages(docs, window=WINDOW):
    """Stretches of each document covered by windows of ``window`` words that occur anywhere else in the corpus.

    ``docs``: doc_id, text; other columns are ignored. Words are runs of other than white space. Null
    texts have no words. Each word covered by a window of ``window`` words that also starts elsewhere
    (same document included) is removed; windows are judged on the input. Repeated rows are copies of
    each other, so nothing of them is kept if they are long enough.

    A document's index is its winnowed anchors: the least k-gram hash of each window, so two equal windows
    have equal anchors in equal places, and a window without a common anchor occurs once. Documents with
    the same word sequence count as one. Each window that has a common anchor is hashed, and those hashed
    alike are counted. This is not a relative Lempel-Ziv parse: no window has a source, and a span may join
    passages from several documents, so it need not occur elsewhere as a whole. Only windows with common
    anchors travel, and all groupings are counts combined before the shuffle and joined back, so a passage
    in a third of all documents splits.

    Returns uid, doc_id, n_words, n_removed, kept_sha256, spans (struct(pos, end) in words).
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    # A text is found again by its id and a hash; of an id with many texts each row meets its own text only.
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("mark"))
    again = lambda rows: texts.join(rows.withColumnsRenamed({"doc_id": "own_id", "mark": "own_mark"}), (
        F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark"))))
    index = stored(numbered(texts, "doc_id", "text", "mark").mapInArrow(
        _index(window), f"uid bigint, doc_id {id_type}, mark bigint, n_words bigint, h1 bigint, h2 bigint, whole string, gram array<bigint>, pos array<int>"), "blocks")
    blocks = index.filter(F.col("n_words") >= window).groupBy("h1", "h2").agg(F.min("uid").alias("uid"), F.count(F.lit(1)).alias("copies"))
    seeds = index.join(blocks.select("uid"), "uid").select("uid", F.explode(F.arrays_zip("gram", "pos")).alias("x")).select("uid", "x.*")
    common = seeds.groupBy("gram").count().filter("count > 1").select("gram")
    seeds = stored(spread_join(seeds, common, ["gram"]).groupBy("uid").agg(F.collect_list("pos").alias("seeds")), "seeds")
    seeds = index.select("uid", "doc_id", "mark", "h1", "h2").join(seeds, "uid")
    windows = again(seeds).select("uid", "text", "h1", "h2", "seeds").mapInArrow(_candidates(window), "uid bigint, start int, w1 bigint, w2 bigint")
    common = windows.groupBy("w1", "w2").count().filter("count > 1").drop("count")
    starts = stored(spread_join(windows, common, ["w1", "w2"]).groupBy("uid").agg(F.collect_set("start").alias("starts")), "starts")
    # Every copy of a word sequence shares its first row's parse, or is gone whole.
    starts = starts.join(index.select("uid", "doc_id", "mark", "h1", "h2"), "uid").join(blocks.filter("copies = 1").select("uid"), "uid")
    parsed = again(starts).select("uid", "text", "h1", "h2", "starts").mapInArrow(
        _parse(window), "uid bigint, spans array<struct<pos:int,end:int>>, n_removed bigint, kept_sha256 string")
    # A repeated doc_id with the same text has copies, so each uid is parsed once.
    copied = index.join(blocks.filter("copies > 1").select("h1", "h2"), ["h1", "h2"]).select(
        "uid", F.array(F.struct(F.lit(0).alias("pos"), F.col("n_words").cast("int").alias("end"))).alias("spans"),
        F.col("n_words").alias("n_removed"), F.sha2(F.lit(""), 256).alias("kept_sha256"))
    done = parsed.unionByName(copied)
    return index.select("uid", "doc_id", "n_words", "whole").join(done, "uid", "left").select(
        "uid", "doc_id", "n_words", F.coalesce("n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        F.coalesce("kept_sha256", "whole").alias("kept_sha256"), "spans")
