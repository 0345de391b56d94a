"""Token sequences of a fixed length, packed by minimum bin slack."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rasterloom.llm import words as W
from rasterloom.llm.hilbert import ranked
from rasterloom.llm.tables import numbered, stored
from rasterloom.llm.tokens import LIMIT, PieceIds, cached, encoder, load

LENGTH = 1024
END_ID = 0
LETTER, NUMBER, OTHER, SPACE = range(4)


class TokenCache:
    """Token ids of texts, by way of the distinct pieces that the tokenizer's pattern cuts them into.

    A piece is encoded by the tokenizer once and then looked up by its string. Kept for the life of a
    Python worker; emptied when it holds ``limit`` pieces. The pattern is that of byte-level tokenizers
    with ``use_regex``; a file with another one is refused.
    """

    def __init__(self, path, limit=LIMIT):
        self.tokenizer = load(path)
        cut = self.tokenizer.pre_tokenizer
        if self.tokenizer.normalizer is not None or type(cut).__name__ != "ByteLevel" or not cut.use_regex or cut.add_prefix_space:
            raise ValueError(f"{path} does not cut texts by the byte-level pattern")
        self.parts = PieceIds(encoder(self.tokenizer), limit)
        self.kinds = np.full(0x110000, -1, np.int8)

    def kind(self, codes):
        """Class of each code point, as the tokenizer sees it: does it join a letter, a digit or a sign?"""
        kinds = self.kinds[codes]
        if (kinds < 0).any():
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str
            for code in np.unique(codes[kinds < 0]).tolist():
                joined = [len(split(x + chr(code))) == 1 for x in "a1!"]
                self.kinds[code] = joined.index(True) if any(joined) else SPACE
            kinds = self.kinds[codes]
        return kinds

    def pieces(self, codes, at):
        """First code points of the pieces of texts laid end to end; ``at``: bounds of the texts.

        Runs of one class make a piece, with one space before them. Of white space before something
        else the last character stands apart. A single apostrophe and certain letters behind it make a
        piece (fixed by the pattern: 's 't 're 've 'm 'll 'd).
        """
        kinds = self.kind(codes)
        head = np.zeros(len(codes) + 1, bool)
        head[at] = True
        run = head[:-1].copy()
        run[1:] |= kinds[1:] != kinds[:-1]
        start = np.flatnonzero(run)
        end = np.append(start[1:], len(codes))
        space = kinds[start] == SPACE
        begins = np.zeros(len(codes) + 1, bool)
        begins[start[space]] = True
        begins[end[space & ~head[end]] - 1] = True
        plain = start[~space]
        begins[plain[head[plain] | (codes[plain - 1] != 32)]] = True

        quote = start[(codes[start] == 39) & (end - start == 1) & begins[start] & ~head[end]]
        if len(quote):
            behind = np.append(codes, [0, 0])
            one, two = behind[quote + 1], np.where(head[np.minimum(quote + 2, len(codes))], 0, behind[quote + 2])
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
            begins[quote[short | long] + 1] = False
            begins[quote[short] + 2] = True
            begins[quote[long & ~short] + 3] = True
        return np.flatnonzero(begins[:-1])

    def encode(self, column):
        """Token ids of all rows of a text column, end to end, and the bounds of the rows."""
        data, at = W.buffers(column)
        text = data.tobytes().decode()
        at = np.append(0, np.cumsum((data & 0xC0) != 0x80))[at]
        codes = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        if not len(codes):
            return np.zeros(0, np.uint32), np.zeros(len(at), np.int64)
        start = self.pieces(codes, at)
        end = np.append(start[1:], len(codes))
        lead = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))  # byte at which each code point begins
        ids, to = self.parts.of(data, lead[start], lead[end])
        return ids, to[np.searchsorted(start, at)]


def token_cache(path):
    return cached(TokenCache, path)


def _pieces(tokenizer, length, end_id, keep_ids):
    def run(batches):
        cache = token_cache(tokenizer)
        for batch in batches:
            for part in W.slices(batch, "text"):
                ids, at = cache.encode(part.column("text"))
                rows = []
                for row in range(part.num_rows):
                    own = np.append(ids[at[row]:at[row + 1]], np.uint32(end_id)).astype("<u4")
                    for low in range(0, len(own), length):
                        piece = own[low:low + length]
                        rows.append((row, low, len(piece), zlib.crc32(piece), len(own), piece.tobytes() if keep_ids else None))
                row, start, size, crc, total, blob = zip(*rows)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid").take(row), part.column("doc_id").take(row), *(pa.array(x, pa.int64()) for x in (start, size, crc, total)), pa.array(blob, pa.binary())],
                    ["uid", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])
    return run


def fill(counts, room):
    """Lengths and copies, of those in ``counts``, whose sum comes closest to ``room`` from below.

    Subset sums as bits of an integer: after each length, bit s says that s can be reached. Copies of
    a length are added by doubling. Walking back takes as many of the longest lengths as it can.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for size in sorted(counts):
        if size > room:
            break
        steps.append((size, reach))
        left, copies = min(counts[size], room // size), 1
        while left:
            take = min(copies, left)
            reach |= reach << (size * take) & mask
            left, copies = left - take, 2 * copies
        if reach >> room & 1:
            break
    total = reach.bit_length() - 1
    used = {}
    for size, before in reversed(steps):
        n = next(n for n in range(min(counts[size], total // size), -1, -1) if before >> (total - n * size) & 1)
        if n:
            used[size] = n
            total -= n * size
    return used


def plan(counts, length):
    """Patterns of piece lengths by minimum bin slack: (copies of each length, times used).

    The longest length left is set, the rest of the window is filled with least slack, and the pattern
    is used as often as the counts allow. Each pattern uses up a length for all but a few pieces, so
    there are few patterns, however many pieces there are.
    """
    counts, patterns = {k: v for k, v in counts.items() if v}, []
    while counts:
        longest = max(counts)
        counts[longest] -= 1
        pattern = fill({k: v for k, v in counts.items() if v}, length - longest)
        counts[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(counts[k] // n for k, n in pattern.items())
        patterns.append((pattern, times))
        for k, n in pattern.items():
            counts[k] -= n * times
            if not counts[k]:
                del counts[k]
    return patterns


def pack(docs, tokenizer, length=LENGTH, end_id=END_ID, keep_ids=False):
    """Cut documents into pieces and place them in sequences of at most ``length`` tokens.

    ``docs``: doc_id, text; other columns are ignored. A document is its token ids and ``end_id``; a
    null or empty text is the end id alone. Repeated rows are packed each for itself; an empty table
    gives no pieces. ``tokenizer`` is the path of a tokenizer file that all executors can read.

    A document's full windows are sequences of their own. What remains of each document is shorter
    than a window and stays whole. How many remainders have each length, at most ``length`` - 1
    numbers, decides everything: the patterns are planned on these counts and so cost the same for any
    number of documents. Each remainder then finds its place from its rank among those of its length.
    Ranks come from a range-partitioned sort, so a length that a third of all documents have is
    spread like any other.

    Returns uid, doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset and, with
    ``keep_ids``, the ids as little-endian 32-bit binary.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    made = numbered(docs, "doc_id", "text").mapInArrow(
        _pieces(tokenizer, length, end_id, keep_ids),
        f"uid bigint, doc_id {id_type}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, ids binary")
    made = stored((made if keep_ids else made.drop("ids")).withColumn("piece", F.monotonically_increasing_id()), "pieces")
    rest = made.filter(F.col("length") < length)
    counts = {r["length"]: r["count"] for r in rest.groupBy("length").count().collect()}  # below ``length`` rows
    first, places, sequence, before = {}, [], 0, 0
    for size in sorted(counts):
        first[size] = before
        before += counts[size]
    taken = dict.fromkeys(counts, 0)
    for pattern, times in plan(counts, length):
        offset = 0
        for size, n in sorted(pattern.items(), reverse=True):
            low = first[size] + taken[size]
            places.append((size, low, low + n * times, n, sequence, offset))
            taken[size] += n * times
            offset += n * size
        sequence += times
    spark = docs.sparkSession
    places = spark.createDataFrame(places, "size bigint, low bigint, high bigint, n bigint, first_sequence bigint, base bigint")
    # Bounded by the number of lengths, not of documents.
    rest = ranked(rest, ["length", "piece"]).join(F.broadcast(places), F.expr("length = size and rank >= low and rank < high"))
    rest = rest.withColumn("sequence_id", F.expr("first_sequence + (rank - low) div n")).withColumn("offset", F.expr("base + (rank - low) % n * size"))
    full = made.filter(F.col("length") == length).withColumn("sequence_id", F.col("piece") + sequence).withColumn("offset", F.lit(0).cast("bigint"))
    columns = ["uid", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    return full.select(columns).unionByName(rest.select(columns))
