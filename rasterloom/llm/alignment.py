"""Alignment of the tokens of two tokenizers, by divide and conquer at shared cuts."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rasterloom.llm import words as W
from rasterloom.llm.packing import token_cache
from rasterloom.llm.tables import numbered, schema, spread_join, stored
from rasterloom.llm.tokens import PieceIds, cached, cuts, load

MARK = "▁"  # stands for a space in the second tokenizer's pieces


def _mixed(name):
    """Does a piece go on from ASCII letters to digits or signs, or the other way?"""
    return len(cuts(np.frombuffer(name.replace(MARK, " ").encode(), np.uint8))) > 0


class ByteTokens:
    """Ids and byte lengths by a byte-level tokenizer."""

    def __init__(self, path):
        self.cache = token_cache(path)
        vocabulary = load(path).get_vocab(with_added_tokens=False)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
        others = iter(range(256, 512))
        byte = {chr(b if b in visible else next(others)): b for b in range(256)}
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(map(byte.get, token))

    def encode(self, data, at):
        return self.cache.encode(_column(data, at))


class PieceTokens:
    """Ids and byte lengths by a sentencepiece model whose pieces hold spaces at their beginning only, and letters, digits and signs apart.

    Such a text's tokens are those of its stretches of spaces with the run of letters, digits or signs
    behind them, and of the further runs, so each distinct stretch is encoded once. The model puts a space before what it is
    given: a stretch is given without its first one, and a run without any behind a line feed, which
    joins with nothing.
    """

    def __init__(self, path):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        text = [name for i, name in enumerate(names) if not model.is_byte(i) and not model.is_control(i) and not model.is_unknown(i)]
        if MARK not in names or any(MARK in name.lstrip(MARK) or "\n" in name or _mixed(name) for name in text) or len(model.encode("\n")) != 2:
            raise ValueError(f"{path} has pieces with spaces inside or of letters and signs: its texts cannot be encoded in stretches")
        self.bytes = [bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace(MARK, " ").encode() for i, name in enumerate(names)]
        lone = [names.index(MARK)]  # the model gives nothing for an empty string

        def encode(strings):
            made = model.encode([s[1:] if s[0] == " " else "\n" + s for s in strings], num_threads=1)
            return [(ids or lone) if s[0] == " " else ids[2:] for s, ids in zip(strings, made)]

        self.pieces = PieceIds(encode)

    def encode(self, data, at):
        space = data == 32
        begins = space.copy()
        begins[1:] &= ~space[:-1]
        begins[cuts(data)] = True
        begins[at[:-1][np.diff(at) > 0]] = True  # each row begins with a space of its own
        start = np.flatnonzero(begins)
        ids, to = self.pieces.of(data, start, np.append(start[1:], len(data)))
        return ids, to[np.searchsorted(start, at)]


def _column(data, at):
    return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data))


def spaced(column):
    """Bytes and bounds of a slice of texts, a space before each; null and empty texts have no bytes."""
    data, at = W.buffers(column)
    some = np.diff(at) > 0
    to = np.append(0, np.cumsum(np.diff(at) + some))
    out = np.full(to[-1], 32, np.uint8)
    inside = np.ones(to[-1], bool)
    inside[to[:-1][some]] = False
    out[inside] = data
    return out, to


def same_bytes(tokens, ids, bounds, data, at):
    """Rows whose tokens' bytes, joined, are those of the row; and the byte at which each token ends, counted in what the tokens join to."""
    made = pa.array(tokens.bytes, pa.large_binary()).take(pa.array(ids))
    _, ends, joined = made.buffers()
    ends = np.frombuffer(ends, np.int64)[:len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
    joined = np.frombuffer(joined, np.uint8)[:ends[-1]] if len(ids) else np.zeros(0, np.uint8)
    to = ends[bounds]
    same = np.diff(to) == np.diff(at)
    if same.all() and len(joined) == len(data):
        wrong = np.flatnonzero(joined != data)
        same[np.searchsorted(at, wrong, "right") - 1] = False
    else:
        for row in np.flatnonzero(same):
            same[row] = np.array_equal(joined[to[row]:to[row + 1]], data[at[row]:at[row + 1]])
    return same, ends[1:]


def shared_cuts(ends_a, ends_b, low, high):
    """For each end in ``ends_a``: is it an end in ``ends_b`` too? By divide and conquer, all intervals of a level at once.

    ``low``, ``high``: intervals of ``ends_a`` to begin with. In each interval the end in the middle is
    looked for in ``ends_b`` by bisection; if it is not there its neighbours are, further and further
    out. A common end cuts the interval in two, which are intervals of the next level; an interval
    without one is a leaf.
    """
    cut = np.zeros(len(ends_a), bool)
    probe = np.zeros(len(low), np.int64)
    while len(low):
        open_ = probe < high - low  # else all ends of the interval were looked for: a leaf
        low, high, probe = low[open_], high[open_], probe[open_]
        step = (probe + 1) // 2
        middle = (low + high - 1) // 2
        at = middle + np.where(probe % 2 == 1, step, -step)
        found = np.searchsorted(ends_b, ends_a[at])
        hit = (found < len(ends_b)) & (ends_b[np.minimum(found, len(ends_b) - 1)] == ends_a[at]) if len(ends_b) else np.zeros(len(at), bool)
        cut[at[hit]] = True
        # Ends between the middle and a hit are no common ones, but the halves may look at them again.
        low, high, probe = (np.concatenate(x) for x in zip(
            (low[~hit], high[~hit], probe[~hit] + 1), (low[hit], at[hit], 0 * at[hit]), (at[hit] + 1, high[hit], 0 * at[hit])))
    return cut


def _texts(n):
    """Decimal ids followed by each sign that may come behind one."""
    return pa.array([f"{i}{sign}" for sign in ",|;" for i in range(n)], pa.large_binary())


class Aligned:
    """Tokens of a slice of texts by both tokenizers, their groups and links."""

    def __init__(self, column, a, b):
        data, at = spaced(column)
        self.rows, self.size = len(at) - 1, len(data)
        (ids_a, of_a), (ids_b, of_b) = a.encode(data, at), b.encode(data, at)
        same_a, ends_a = same_bytes(a, ids_a, of_a, data, at)
        same_b, ends_b = same_bytes(b, ids_b, of_b, data, at)
        keep = same_a & same_b & (np.diff(at) > 0)
        self.ids_a, self.ends_a, self.of_a = self._kept(keep, ids_a, ends_a, of_a, at)
        self.ids_b, self.ends_b, self.of_b = self._kept(keep, ids_b, ends_b, of_b, at)
        self.cut = shared_cuts(self.ends_a, self.ends_b, self.of_a[:-1], self.of_a[1:])

    @staticmethod
    def _kept(keep, ids, ends, bounds, at):
        """Tokens of the rows kept, with ends in bytes of the slice."""
        size = np.diff(bounds)
        inside = np.repeat(keep, size)
        first = np.append(0, ends)[bounds[:-1]]
        ends = ends + np.repeat(at[:-1] - first, size)
        return ids[inside], ends[inside], np.append(0, np.cumsum(np.where(keep, size, 0)))

    @property
    def groups(self):
        """Groups of each row."""
        return np.diff(np.append(0, np.cumsum(self.cut))[self.of_a])

    def links(self):
        """Row, A id and B id of each pair of tokens that share bytes. What two tokens share ends where one of them ends, and nowhere else."""
        mark = np.zeros((2, self.size + 1), bool)
        mark[0, self.ends_a] = mark[1, self.ends_b] = True
        ends = np.flatnonzero(mark[0] | mark[1])
        a, b = (np.cumsum(m)[ends] - m[ends] for m in mark)  # ends before this one
        return np.searchsorted(self.of_a, a, "right") - 1, self.ids_a[a], self.ids_b[b]

    def digests(self, texts, n_texts):
        """SHA-256 of each row's groups, written out; '' for rows without tokens."""
        group_a = np.append(0, np.cumsum(self.cut))[:-1]
        last_a = self.cut
        common = self.ends_a[self.cut]
        group_b = np.searchsorted(common, self.ends_b)
        last_b = np.append(group_b[1:] != group_b[:-1], True) if len(group_b) else np.zeros(0, bool)
        sign = np.concatenate([np.where(last_a, 1, 0), np.where(last_b, 2, 0)])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        index = (np.concatenate([self.ids_a, self.ids_b]).astype(np.int64) + sign * n_texts)[order]
        made = texts.take(pa.array(index))
        if not len(index):
            return [""] * self.rows
        _, to, joined = made.buffers()
        to = np.frombuffer(to, np.int64)[self.of_a + self.of_b]
        joined = memoryview(joined)
        return [hashlib.sha256(joined[low:high - 1]).hexdigest() if high > low else "" for low, high in zip(to[:-1].tolist(), to[1:].tolist())]


def _align(a, b, keep):
    def run(batches):
        first, second = cached(ByteTokens, a), cached(PieceTokens, b)
        n_texts = max(len(first.bytes), len(second.bytes))
        texts = _texts(n_texts)
        for batch in batches:
            for part in W.slices(batch, "text"):
                found = Aligned(part.column("text"), first, second)
                row, id_a, id_b = found.links()
                code = (row.astype(W.U64) << W.U64(40)) | (id_a.astype(W.U64) << W.U64(20)) | id_b.astype(W.U64)
                code, times = np.unique(code, return_counts=True)
                bounds = pa.array(np.searchsorted(code, np.arange(part.num_rows + 1, dtype=W.U64) << W.U64(40)).astype(np.int32))
                code = (code & W.U64((1 << 40) - 1)).astype(np.int64)
                uid = part.column("uid")
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in keep), uid, pa.array([uid[0].as_py()] * part.num_rows, pa.int64()),
                    *(pa.array(np.asarray(x, np.int64)) for x in (np.diff(found.of_a), np.diff(found.of_b), found.groups, np.bincount(row, minlength=part.num_rows))),
                    pa.array(found.digests(texts, n_texts)), pa.ListArray.from_arrays(bounds, pa.array(code)),
                    pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32))),
                ], [*keep, "uid", "slice", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"])
    return run


def _slice_pairs(batches):
    """Pairs of each slice in a batch, once, and how many of its documents hold them."""
    for batch in batches:
        lists = batch.column("pairs")
        size = np.diff(lists.offsets.to_numpy())
        code = lists.flatten().to_numpy()
        names, place = np.unique(batch.column("slice").to_numpy(), return_inverse=True)
        place = np.repeat(place, size)
        for i, name in enumerate(names.tolist()):
            pair, n = np.unique(code[place == i], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pair), name)), pa.array(pair), pa.array(n.astype(np.int64))], ["slice", "pair", "n"])


def _looked_up(keep):
    def run(docs, counts):
        code, first = np.unique(counts.column("pair").to_numpy(), return_index=True)
        n, best = counts.column("n").to_numpy()[first], counts.column("best").to_numpy(zero_copy_only=False)[first]
        docs = docs.combine_chunks()
        lists = docs.column("pairs").combine_chunks()
        at = lists.offsets.to_numpy().astype(np.int64)
        place = np.searchsorted(code, lists.flatten().to_numpy())
        times = docs.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        upto = lambda x: np.append(0, np.cumsum(x))[at - at[0]]
        n_best, total = np.diff(upto(times * best[place])), np.diff(upto(times * n[place]))
        own = [c for c in docs.column_names if c not in ("slice", "pairs", "times")]
        return pa.table([*(docs.column(c) for c in own), pa.array(n_best), pa.array(total)], [*own, "n_best", "count_sum"])
    return run


def align(docs, byte_tokenizer, piece_tokenizer, keep=("doc_id",)):
    """Groups and links between the tokens of a byte-level tokenizer (A) and a sentencepiece model (B) in each document.

    ``docs``: text and the columns to ``keep``; others are ignored. A encodes a space and the text; B
    the text, before which it puts a space itself. Bytes at which tokens of both end cut a text into groups, the smallest
    stretches that both tokenizers have in common. Tokens that share a byte are linked. The count of a
    pair of ids is the number of documents in which it is linked; repeated rows count each for itself.
    A null or empty text, and one that tokens do not give back byte for byte, has no tokens: zeros and
    an empty digest. An empty table gives no rows. Both paths must be readable by all executors; models whose
    texts cannot be encoded piece by piece are refused.

    A text is encoded by its distinct pieces. Its groups are found by divide and conquer (see
    ``shared_cuts``). Documents travel in slices of about 1 MB, and a slice sends each of its pairs
    once, so a pair that all documents hold gives one row for each slice. Counts combine before the
    shuffle; they come back to the slices by a join in which hot pairs can be split, and each slice
    looks its documents' pairs up in its own table. Broadcast is only the highest count of each A id,
    bounded by A's vocabulary.

    Returns uid, the kept columns, n_a, n_b, n_groups, n_links, groups_sha256, n_best (links whose
    count is the highest of their A id), count_sum (counts of all links, added).
    """
    columns = "uid bigint, slice bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"
    names = [f"k{i}" for i in range(len(keep))]
    source = docs.select(*(F.col(c).alias(k) for c, k in zip(keep, names)), F.col("text"))
    made = stored(numbered(source, *names, "text").mapInArrow(_align(byte_tokenizer, piece_tokenizer, names), schema(source, names, columns)), "aligned")
    pairs = stored(made.filter("n_links > 0").select("slice", "pairs").mapInArrow(_slice_pairs, "slice bigint, pair bigint, n bigint"), "pairs")
    counts = stored(pairs.groupBy("pair").agg(F.sum("n").alias("n")).withColumn("a", F.shiftright("pair", 20)), "counts")
    best = counts.groupBy("a").agg(F.max("n").alias("most"))
    counts = counts.join(F.broadcast(best), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    looked = spread_join(pairs.select("slice", "pair"), counts, ["pair"]).select("slice", "pair", "n", "best")
    out = schema(source, names, "uid bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint")
    some = made.filter("n_links > 0").groupBy("slice").cogroup(looked.groupBy("slice")).applyInArrow(_looked_up(names), out)
    none = made.filter("n_links = 0").drop("slice", "pairs", "times").withColumns({"n_best": F.lit(0).cast("bigint"), "count_sum": F.lit(0).cast("bigint")})
    return some.unionByName(none).withColumnsRenamed(dict(zip(names, keep)))
