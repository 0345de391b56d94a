"""Token sequences of a fixed length, packed by exact complements and best fit."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rasterloom.llm import words as W
from rasterloom.llm.hilbert import ranked
from rasterloom.llm.tables import numbered, stored
from rasterloom.llm.tokens import SpacedTokens, cached

LENGTH = 2048
END_ID = 0


def _pieces(tokenizer, length, end_id, keep_ids):
    def run(batches):
        cache = cached(SpacedTokens, tokenizer)
        for batch in batches:
            for part in W.slices(batch, "text"):
                ids, at = cache.encode(part.column("text"))
                rows = []
                for row in range(part.num_rows):
                    own = np.append(ids[at[row]:at[row + 1]], np.uint32(end_id)).astype("<u4")
                    for number, low in enumerate(range(0, len(own), length)):
                        piece = own[low:low + length]
                        rows.append((row, number, low, len(piece), zlib.crc32(piece), piece.tobytes() if keep_ids else None))
                row, number, start, size, crc, blob = zip(*rows)
                row = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [part.column("uid").take(row), part.column("doc_id").take(row), pa.array(number, pa.int32()),
                     *(pa.array(x, pa.int64()) for x in (start, size, crc)), pa.array(blob, pa.binary())],
                    ["uid", "doc_id", "piece", "start", "length", "ids_crc32", "ids"])
    return run


class Sums:
    """Index of the sums of one, two and three lengths of which pieces are left.

    ``left[s]``: pieces of length s. The pairs of a sum are looked for once and kept under it; those
    whose pieces have run out are struck off when the sum is asked for again. A triple is a length and
    a pair of what is missing then.
    """

    def __init__(self, left):
        self.left, self.pairs = left, {}

    def pair(self, total, besides=0):
        """The pair with this sum that is there most often; one piece of length ``besides`` is spoken for."""
        left = self.left
        if total not in self.pairs:
            self.pairs[total] = np.arange(1, total // 2 + 1)
        a = self.pairs[total]
        a = self.pairs[total] = a[(left[a] > 0) & (left[total - a] > 0)]
        if not len(a):
            return ()
        b = total - a
        times = np.minimum(left[a] - (a == besides), left[b] - (b == besides))
        times = np.where(a == b, (left[a] - (a == besides)) // 2, times)
        best = int(times.argmax())
        return (int(a[best]), int(b[best])) if times[best] > 0 else ()

    def filling(self, room):
        """One, two or three lengths with exactly the sum ``room``, of pieces that are left; else ()."""
        left = self.left
        if left[room]:
            return (room,)
        longest = int(np.flatnonzero(left)[-1]) if left.any() else 0
        if room > 3 * longest:
            return ()
        if room <= 2 * longest and (two := self.pair(room)):
            return two
        for one in np.flatnonzero(left[:room - 1])[::-1].tolist():
            if 3 * one < room:  # ``one`` is the longest of the three
                break
            if two := self.pair(room - one, one):
                return one, *two
        return ()


def plan(counts, length):
    """Patterns of piece lengths, (copies of each length, times used), that use up ``counts`` ({length: pieces}).

    The longest piece left opens a sequence. If one, two or three lengths that are left fill the gap
    exactly, they are taken. Otherwise the piece that fits best, the longest that fits, goes in and the
    rest of the gap is looked up again. A pattern is used as often as the counts allow, which uses up
    one of its lengths, so there are few patterns, however many pieces there are. What is closed with a
    gap has no piece left that would fit it.
    """
    left = np.zeros(length + 1, np.int64)
    for size, n in counts.items():
        left[size] = n
    sums, patterns = Sums(left), []
    while left.any():
        pattern, room = {}, length

        def take(size):
            pattern[size] = pattern.get(size, 0) + 1
            left[size] -= 1
            return size

        room -= take(int(np.flatnonzero(left)[-1]))
        while room:
            if more := sums.filling(room):
                for size in more:
                    room -= take(size)
            elif len(fits := np.flatnonzero(left[:room + 1])):
                room -= take(int(fits[-1]))
            else:
                break
        times = 1 + min(int(left[size]) // n for size, n in pattern.items())
        for size, n in pattern.items():
            left[size] -= n * (times - 1)
        patterns.append((pattern, times))
    return patterns


def places(counts, patterns):
    """Where pieces go: (length, low, high, copies, first sequence, first offset) for stretches of ranks of one length; and the number of sequences.

    The pieces of a length are numbered from the sum of the pieces of all shorter ones.
    """
    next_rank, rows, sequence, before = {}, [], 0, 0
    for size in sorted(counts):
        next_rank[size] = before
        before += counts[size]
    for pattern, times in patterns:
        offset = 0
        for size, n in sorted(pattern.items(), reverse=True):
            low = next_rank[size]
            next_rank[size] = low + n * times
            rows.append((size, low, low + n * times, n, sequence, offset))
            offset += n * size
        sequence += times
    return rows, sequence


def pack_complements(docs, tokenizer, length=LENGTH, end_id=END_ID, keep_ids=False):
    """Place documents whole in sequences of at most ``length`` tokens, as few as the method finds.

    ``docs``: doc_id, text; other columns are ignored. A document is its token ids and ``end_id``; a
    null or empty text is the end id alone. Only a longer one is cut, into pieces of ``length`` tokens
    and a last one that may be shorter. Repeated rows are packed each for itself; null ids are ids like
    others; an empty table gives no pieces. ``tokenizer`` is the path of a tokenizer file that all
    executors can read and that drops white space; another one is refused.

    Pieces of full length are sequences of their own. All others have fewer than ``length`` lengths,
    and how many pieces each length has decides everything: the patterns (see ``plan``) are made on
    these counts and cost the same for any number of documents. Each piece then finds its place from
    its rank among those of its length. Ranks come from a range-partitioned sort, so a length that a
    third of all documents have is spread like any other.

    Returns uid, doc_id, piece, start, length, ids_crc32, sequence_id, offset and, with ``keep_ids``,
    the ids as little-endian 32-bit binary.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    made = numbered(docs, "doc_id", "text").mapInArrow(
        _pieces(tokenizer, length, end_id, keep_ids),
        f"uid bigint, doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary")
    made = stored((made if keep_ids else made.drop("ids")).withColumn("row", F.monotonically_increasing_id()), "pieces")
    rest = made.filter(F.col("length") < length)
    counts = {r["length"]: r["count"] for r in rest.groupBy("length").count().collect()}  # below ``length`` rows
    spots, sequences = places(counts, plan(counts, length))
    spots = docs.sparkSession.createDataFrame(spots, "size bigint, low bigint, high bigint, n bigint, first_sequence bigint, base bigint")
    # Bounded by the number of lengths, not of documents.
    rest = ranked(rest, ["length", "row"]).join(F.broadcast(spots), F.expr("length = size and rank >= low and rank < high"))
    rest = rest.withColumn("sequence_id", F.expr("first_sequence + (rank - low) div n")).withColumn("offset", F.expr("base + (rank - low) % n * size"))
    full = made.filter(F.col("length") == length).withColumn("sequence_id", F.col("row") + sequences).withColumn("offset", F.lit(0).cast("bigint"))
    columns = ["uid", "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *(["ids"] if keep_ids else [])]
    return full.select(columns).unionByName(rest.select(columns))
