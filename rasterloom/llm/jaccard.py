"""Exact Jaccard self-join on word shingles: size bands, bitmap signatures, sorted-array intersection."""

from __future__ import annotations

from bisect import bisect_right
from math import exp, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rasterloom.llm import words as W
from rasterloom.llm.components import components
from rasterloom.llm.tables import Seen, numbered, schema, shuffled, spread_join, stored

#: A tile holds at most about so many documents and so many shingles.
TILE_ROWS, TILE_SHINGLES = 512, 1 << 22
#: Bits of a document's signature, at least.
SIGNATURE_BITS = 1024


class Bands:
    """Size bands and the number of hash ranges that a set of each band is cut into.

    Let two sets of sizes x <= y link at a similarity of num / den. Then they differ in at most
    (x + y) (den - num) / (den + num) shingles. Cut into more hash ranges than that, at least one
    range holds the same shingles in both. So many more ranges are added that hardly any set has that
    many empty ones, and empty ranges need no key; a set that has more names its empty ranges too.
    """

    def __init__(self, num, den):
        self.num, self.den = num, den
        self.edges = [1]
        while self.edges[-1] < 1 << 40:
            self.edges.append(max(self.edges[-1] + 1, self.edges[-1] * 7 // 5))

    def differing(self, band):
        x = self.edges[band + 1] - 1
        return (x + x * self.den // self.num) * (self.den - self.num) // (self.den + self.num)

    def ranges(self, band):
        """Number of ranges, and how many of them may be empty in both sets."""
        differing = self.differing(band)
        spare = 1
        for _ in range(3):  # more ranges leave more of them empty
            m = differing + 1 + spare
            empty = m * exp(-self.edges[band] / m)
            spare = int(empty + 3 * sqrt(empty) + 2)
        return differing + 1 + spare, spare

    def of(self, n):
        """Bands in which a set of n shingles has partners at least as small as itself, and its own."""
        low = -(-n * self.num // self.den)
        return range(bisect_right(self.edges, low) - 1, bisect_right(self.edges, n))


def range_keys(values, bands):
    """Keys of a sorted set; two linked sets that differ share at least one."""
    content = np.zeros(len(values) + 1, W.U64)
    np.cumsum(W.mix(values, 7), out=content[1:])
    for band in bands.of(len(values)):
        if bands.differing(band) == 0:
            continue  # only equal sets link
        m, spare = bands.ranges(band)
        place = (values >> W.U64(32)) * W.U64(m) >> W.U64(32)
        bound = np.searchsorted(place, np.arange(m + 1, dtype=W.U64))
        filled = bound[1:] > bound[:-1]
        keys = W.mix(content[bound[1:]] - content[bound[:-1]] + W.mix(np.arange(m, dtype=W.U64) + W.U64(band << 40), 8), 9)
        yield keys if m - filled.sum() > spare else keys[filled]


def _sets(part, size):
    """Row, sorted shingle hashes, and the set's two names."""
    words = W.NamedWords(part.column("text"), W.LOWER)
    for row, (values, second) in enumerate(W.shingle_sets(words, size)):
        yield row, values, (W.set_hash(values, 1), W.set_hash(second, 3))


def signature(values):
    """A set as a bitmap, in 64-bit words: SIGNATURE_BITS, or for larger sets the next power of two above their size."""
    bits = np.zeros(max(SIGNATURE_BITS, 1 << (len(values) - 1).bit_length()), bool)
    bits[(values % W.U64(len(bits))).astype(np.int64)] = True
    return np.packbits(bits).view(W.U64)


class Signatures:
    """Signatures of sets in order of size. Sets that may link are of like size; the longer bitmap is folded to the shorter."""

    def __init__(self, bits):
        self.bits = bits
        self.words = np.array([len(b) for b in bits])
        self.at = {}

    def among(self, i, near):
        """Bitmap of set i, and those of the later sets ``near`` folded to its length."""
        words = self.words[i]
        if words not in self.at:
            rows = np.flatnonzero(self.words >= words)
            self.at[words] = rows[0], np.array([np.bitwise_or.reduce(self.bits[r].reshape(-1, words), axis=0) for r in rows])
        first, folded = self.at[words]
        return self.bits[i], folded[near - first]


def least_overlap(a, b, num, den):
    """Shingles that sets of sizes a and b must share to link."""
    return -(-num * (a + b) // (num + den))


def most_overlap(bits, size, others, sizes):
    """Upper bound of the overlaps of a set with others: a bit set in one signature only is a shingle in that set only."""
    return np.minimum(size - np.bitwise_count(bits & ~others).sum(axis=1), sizes - np.bitwise_count(others & ~bits).sum(axis=1))


def _identities(size, keep):
    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                found = [(len(v), *names, signature(v).tobytes()) for _, v, names in _sets(part, size)]
                n, h1, h2, bits = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), part.column("uid"), *(pa.array(x, pa.int64()) for x in (n, h1, h2)), pa.array(bits, pa.binary())],
                    [*keep, "uid", "n", "h1", "h2", "bits"])
    return run


def _keys(size, bands):
    def run(batches):
        seen = Seen()  # copies in one task send their keys once
        for batch in batches:
            for part in W.slices(batch, "text"):
                keys, owners = [], []
                for _, values, names in _sets(part, size):
                    if len(values) and seen.add(names):
                        for k in range_keys(values, bands):
                            keys.append(k)
                            owners.append(np.full(len(k), names[0], np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(W.signed(np.concatenate(keys))), pa.array(np.concatenate(owners))], ["key", "h1"])
    return run


def _tile(name, number=0):
    """A tile's number from a name and a number in it."""
    return int(W.mix(np.array([name], np.int64).view(W.U64) + W.U64(number << 32), 14).view(np.int64)[0])


class _Run:
    """One key with more owners than a tile holds, taken as its rows come, so that no task holds its owners."""

    def __init__(self, key, star, half):
        self.key, self.star, self.half = key, star, half
        self.first, self.rest, self.number, self.last = None, np.zeros(0, np.int64), 0, None

    def add(self, owners, end=False):
        """(tile, owners) that these rows complete: each block with the first one; or without ``star`` (None, owners)."""
        owners = owners[np.append(True, owners[1:] != owners[:-1])] if len(owners) else owners
        if len(owners) and owners[0] == self.last:
            owners = owners[1:]
        if not len(owners) and not end:
            return
        self.last = owners[-1] if len(owners) else self.last
        if not self.star:
            if len(owners):
                yield None, owners
            return
        self.rest = np.append(self.rest, owners)
        while len(self.rest) >= self.half or (end and len(self.rest)):
            block, self.rest = self.rest[:self.half], self.rest[self.half:]
            if self.first is None:
                self.first = block
            else:
                self.number += 1
                yield _tile(self.key, self.number), np.append(self.first, block)


def _runs(star, size):
    """Sets that share a key, as tiles: rows come sorted by key and owner.

    Near copies share many keys; keys with the same owners make one tile. Of a key with more than ``size``
    owners each block of half as many meets the first one or, without ``star``, its owners are named with the key
    in ``hot`` and have no tile.
    """
    def run(batches):
        seen, key, owner, large = Seen(), np.zeros(0, np.int64), np.zeros(0, np.int64), None

        def batch_of(found):
            key, tile, members = zip(*found)
            rows = [len(m) for m in members]
            tile = [np.full(n, t or 0, np.int64) for n, t in zip(rows, tile)]
            none = np.repeat([t is None for _, t, _ in found], rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(tile), mask=none), pa.array(np.concatenate(members)), pa.array(np.repeat(np.array(key, np.int64), rows), mask=~none)],
                ["tile", "h1", "hot"])

        def tiles(key, owner):
            """Keys that are complete."""
            fresh = np.ones(len(key), bool)
            fresh[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
            key, owner = key[fresh], owner[fresh]
            start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            end = np.append(start[1:], len(key))
            several = end - start > 1
            start, end = start[several], end[several]
            names = W.signed(W.Residues(W.mix(owner.view(W.U64), 12), 0).hashes(start, end, 13))
            for low, high, name in zip(start.tolist(), end.tolist(), names.tolist()):
                if high - low > size:
                    yield from ((int(key[low]), *x) for x in _Run(int(key[low]), star, size // 2 or 1).add(owner[low:high], end=True))
                elif seen.add(name):
                    yield 0, _tile(name), owner[low:high]

        def more(owners, end=False):
            yield from ((large.key, *x) for x in large.add(owners, end))

        for batch in batches:
            new_key, new_owner = batch.column("key").to_numpy(), batch.column("h1").to_numpy()
            if not len(new_key):
                continue
            found = []
            if large is not None:
                same = int(np.searchsorted(new_key, large.key, "right"))
                found += more(new_owner[:same], end=same < len(new_key))
                new_key, new_owner = new_key[same:], new_owner[same:]
                large = None if len(new_key) else large
            key, owner = np.append(key, new_key), np.append(owner, new_owner)
            if len(key):
                last = np.searchsorted(key, key[-1])  # the last key may go on in the next batch
                found += tiles(key[:last], owner[:last])
                key, owner = key[last:], owner[last:]
                if len(np.unique(owner)) > size:
                    large = _Run(int(key[0]), star, size // 2 or 1)
                    found += more(owner)
                    key, owner = key[:0], owner[:0]
            if found:
                yield batch_of(found)
        found = [*(more(owner[:0], end=True) if large is not None else ()), *(tiles(key, owner) if len(key) else ())]
        if found:
            yield batch_of(found)
    return run


TILES = "tile bigint, h1 bigint, hot bigint"


def _stars(keys):
    """Tiles of the owners of keys (key, h1, weight): all of a key in one, or each block with that of the weightiest."""
    rows = keys.repartition("key").sortWithinPartitions("key", F.desc("weight"), "h1").select("key", "h1").mapInArrow(_runs(True, TILE_ROWS), TILES)
    return rows.select("tile", "h1").distinct().withColumn("label", F.col("h1"))


def _candidate_groups(keys, plausible):
    """(h1, group) of sets that plausible pairs connect, of all pairs that share a key.

    Keys with few owners are tiles. Keys with many owners, which a large group of near copies has, are taken in
    three steps, none of which has more rows than owners unless their sets do not belong together: first each owner
    meets others under the one key that most share with it, then under each key one owner of each group
    so far, and at last the owners outside of a key's largest group meet all of its owners.
    """
    runs = stored(keys.repartition("key").sortWithinPartitions("key", "h1").mapInArrow(_runs(False, TILE_ROWS), TILES), "runs")
    hot = stored(runs.filter("hot is not null").select("hot", "h1").distinct(), "hot")
    # A key's owners are counted before the shuffle and meet the count again in a join that can split a hot key.
    counts = hot.groupBy("hot").count()
    most = spread_join(hot, shuffled(counts), ["hot"]).groupBy("h1").agg(F.max_by("hot", F.struct("count", "hot")).alias("key")).withColumn("weight", F.lit(0))
    cold = runs.filter("tile is not null").select("tile", "h1").distinct().withColumn("label", F.col("h1"))
    edges = stored(plausible(cold.unionByName(_stars(most))), "edges")
    if hot.isEmpty():
        return components(edges).withColumnsRenamed({"node": "h1", "component": "group"})
    for meeting in (_one_of_each, _outside):
        groups = stored(components(edges), "groups").withColumnsRenamed({"node": "h1", "component": "label"})
        labelled = stored(hot.join(shuffled(groups), "h1", "left").withColumn("label", F.coalesce("label", "h1")), "labelled")
        edges = stored(edges.unionByName(plausible(meeting(labelled))), "edges")
    return components(edges).withColumnsRenamed({"node": "h1", "component": "group"})


def _one_of_each(labelled):
    """Tiles of each key's groups so far, by one owner each. The largest groups meet all others."""
    return _stars(labelled.groupBy("hot", "label").agg(F.min("h1").alias("h1"), F.count(F.lit(1)).alias("weight")).withColumnRenamed("hot", "key"))


def _outside(rows):
    """Tiles for what earlier steps may have missed: owners outside their key's largest group against all its owners.

    ``rows``: hot, h1, label of the group so far. An owner outside, in part i of its kind, meets part j of all
    owners of the key, each part at most about half a tile. Owners of one group need no test.
    """
    main = rows.groupBy("hot", "label").count().groupBy("hot").agg(
        F.max_by("label", F.struct("count", "label")).alias("main"), F.sum("count").alias("n"), F.max("count").alias("top"))
    half = TILE_ROWS // 2 or 1
    main = main.where("n > top").select(
        "hot", "main", F.ceil(F.col("n") / half).cast("int").alias("parts"), F.ceil((F.col("n") - F.col("top")) / half).cast("int").alias("out_parts"))
    rows = stored(spread_join(rows, shuffled(main), ["hot"]), "outside")
    place = lambda n: F.pmod(F.xxhash64("h1"), F.col(n))
    named = lambda i, j: F.xxhash64("hot", i.cast("int"), j.cast("int")).alias("tile")
    out = rows.where("label != main").withColumn("j", F.explode(F.expr("sequence(0, parts - 1)"))).select("h1", "label", named(place("out_parts"), F.col("j")))
    all_ = rows.withColumn("i", F.explode(F.expr("sequence(0, out_parts - 1)"))).select("h1", "label", named(F.col("i"), place("parts")))
    return out.unionByName(all_).distinct()


def _plausible(num, den):
    """Edges that join all sets of a tile whose signatures do not rule out a link; rows come sorted by tile and size.

    Sets of one label are joined already.
    """
    def edges(tile, owner, n, bits, label):
        cut = np.flatnonzero(np.append(True, tile[1:] != tile[:-1]))
        for low, high in zip(cut.tolist(), [*cut[1:].tolist(), len(tile)]):
            group, signs = np.unique(label[low:high], return_inverse=True)[1], Signatures([np.frombuffer(b, W.U64) for b in bits[low:high]])
            for i in range(low, high - 1):
                near = np.arange(i + 1, low + np.searchsorted(n[low:high], n[i] * den // num, "right"))
                near = near[group[near - low] != group[i - low]]
                if not len(near):
                    continue
                own, others = signs.among(i - low, near - low)
                near = near[most_overlap(own, n[i], others, n[near]) >= least_overlap(n[i], n[near], num, den)]
                for j in near.tolist():
                    if group[j - low] != group[i - low]:
                        yield int(owner[i]), int(owner[j])
                        group[group == group[j - low]] = group[i - low]

    def run(batches):
        seen, held = Seen(), None
        for batch in _and_end(batches):
            now = None if batch is None else tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("tile", "h1", "n", "bits", "label"))
            if held is not None and now is not None:
                now = tuple(np.concatenate(x) for x in zip(held, now))
            rows, held = (held, None) if now is None else (now, None)
            if rows is None or not len(rows[0]):
                continue
            if now is not None:
                last = int(np.argmax(rows[0] == rows[0][-1]))  # the last tile may go on
                rows, held = tuple(x[:last] for x in rows), tuple(x[last:] for x in rows)
            pairs = [p for p in edges(*rows) if seen.add(p)] if len(rows[0]) else []
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs)], ["a", "b"])
    return run


def _and_end(batches):
    yield from batches
    yield None


def _packed(size):
    def run(batches):
        for batch in batches:
            for part in W.slices(batch, "text"):
                h1, h2 = part.column("h1").to_numpy(), part.column("h2").to_numpy()
                keep, blobs = [], []
                for row, values, names in _sets(part, size):
                    if names == (h1[row], h2[row]):
                        keep.append(row)
                        blobs.append(values.tobytes())
                yield pa.RecordBatch.from_arrays([part.column("uid").take(pa.array(keep, pa.int64())), pa.array(blobs, pa.binary())], ["uid", "shingles"])
    return run


def tile_links(ids, sets, num, den, labels=None):
    """Edges that join all linked sets of a tile: a spanning forest of its links.

    Sets are taken by size, so partners of a set are a stretch of those behind it. Signatures bound
    each overlap from above. Pairs that are already joined, by equal ``labels`` or by links found here, need no test; all others
    that pass are intersected exactly.
    """
    order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), ids[i]))
    ids, sets = [ids[i] for i in order], [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets])
    signs = Signatures([signature(s) for s in sets])
    group = np.arange(len(sets)) if labels is None else np.unique([labels[i] for i in order], return_inverse=True)[1]
    edges = []
    for i in range(len(sets) - 1):
        high = np.searchsorted(sizes, sizes[i] * den // num, "right")
        near = np.arange(i + 1, high)
        near = near[group[near] != group[i]]
        need = least_overlap(sizes[i], sizes[near], num, den)
        if not len(near):
            continue
        own, others = signs.among(i, near)
        bound = most_overlap(own, sizes[i], others, sizes[near])
        for j, least in zip(near[bound >= need].tolist(), need[bound >= need].tolist()):
            if group[i] != group[j] and len(np.intersect1d(sets[i], sets[j], assume_unique=True)) >= least:
                edges.append((ids[i], ids[j]))
                group[group == group[j]] = group[i]
    return edges


def _verify(num, den):
    def run(table):
        rows = {u: (np.frombuffer(x.as_buffer(), W.U64), c) for u, x, c in zip(
            table.column("uid").to_pylist(), (x for c in table.column("shingles").chunks for x in c), table.column("label").to_pylist())}
        edges = tile_links(list(rows), [s for s, _ in rows.values()], num, den, [c for _, c in rows.values()])
        a, b = zip(*edges) if edges else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def _parts(rows, weight):
    return F.ceil(F.greatest(rows / TILE_ROWS, weight / TILE_SHINGLES)).cast("int")


def _celled(classes, num, den):
    """Classes with their cell: candidate group and size band; k tiles of the cell; tile t of the class; is the group one tile?"""
    # Partners differ by a factor of at most den / num; a band is a little wider, against rounding.
    step = float(np.log(den / num) * 1.0001)
    classes = classes.withColumn("band", F.floor(F.log("n") / step).cast("int"))
    cells = stored(classes.groupBy("group", "band").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("weight")), "cells")
    whole = cells.groupBy("group").agg((_parts(F.sum("rows"), F.sum("weight")) <= 1).alias("small"))
    cells = cells.select("group", "band", _parts(F.col("rows"), F.col("weight")).alias("k")).join(whole, "group")
    return classes.join(cells, ["group", "band"]).withColumn("t", F.expr("cast(pmod(xxhash64(uid), k) as int)"))


#: A small group is one tile. In a larger one, each tile of a cell meets the cell's first tile, and the first tiles of neighbouring bands meet.
FIRST_TILES = """if(small, array(concat_ws(':', group)),
    if(t > 0, array(concat_ws(':', group, band, t)),
       concat(transform(sequence(0, k - 1), x -> concat_ws(':', group, band, x)),
              array(concat_ws(':', group, band, 'up'), concat_ws(':', group, band - 1, 'up')))))"""


def _rest_tiles(classes, labels):
    """Tiles for what the first ones may have missed: classes outside their group's largest component against all of the group.

    ``labels``: uid, label (component so far). A class outside, in tile i of its kind, meets tile j of all
    classes of its own and the two neighbouring bands. Classes of one label need no test.
    """
    rows = classes.filter("not small").join(shuffled(labels), "uid", "left").withColumn("label", F.coalesce("label", "uid"))
    main = rows.groupBy("group", "label").count().groupBy("group").agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    rows = stored(rows.join(main, "group").withColumn("outside", F.col("label") != F.col("main")), "labelled")
    out = rows.filter("outside").groupBy("group", "band").agg(_parts(F.count(F.lit(1)), F.sum("n")).alias("m"))
    cells = rows.groupBy("group", "band").agg(F.first("k").alias("m"))
    near = F.explode(F.expr("sequence(band - 1, band + 1)"))

    def meeting(rows, cells, tile):
        """Each row with the tiles of the cells in its own and the neighbouring bands."""
        cells = cells.withColumnRenamed("band", "other")
        return rows.withColumn("other", near).join(cells, ["group", "other"]).withColumn("other_tile", F.explode(F.expr("sequence(0, m - 1)"))).select("uid", "label", tile.alias("tile"))

    mine = F.expr("cast(pmod(xxhash64(uid), own) as int)")
    outside = rows.filter("outside").join(out.withColumnRenamed("m", "own"), ["group", "band"])
    a = meeting(outside, cells, F.concat_ws(":", "group", "band", mine, "other", "other_tile"))
    b = meeting(rows, out, F.concat_ws(":", "group", "other", "other_tile", "band", "t"))
    return a.unionByName(b).distinct()


def near_duplicates(docs, shingle=5, num=80, den=100, keep=("doc_id",)):
    """Groups of documents that are linked, directly or over others, by a Jaccard similarity of num / den or more.

    ``docs``: doc_id, text and the columns to ``keep``; others are ignored. A document's set holds its
    distinct runs of ``shingle`` white-space separated words, A-Z lower-cased; with fewer words, all of
    them as one.
    Null and empty texts have the empty set and link with nothing. Repeated rows are rows like others:
    equal sets link.

    Sets that are equal are one class. Classes are cut into hash ranges (see ``Bands``), which finds
    every pair above the limit. Classes that share a range and whose signatures do not rule out a link
    form candidate groups; so a shingle that many texts hold joins none of them. Inside a group, tiles
    of one size band or of two neighbouring ones are compared: a bitmap bounds each overlap from above
    before the sorted arrays are intersected. Large groups are mostly copies of one text, so their tiles
    first meet one tile of their band only; then everything outside of the largest component so found
    meets all of the group. Pairs already joined are not tested, so the links found are fewer than all
    pairs, but no two documents that links connect stay apart, and a group costs about its size.

    Returns uid, the kept columns, n_shingles, group (a long, equal for linked documents).
    """
    # A text is found again by its id and a hash; of an id with many texts each row meets its own text only.
    mark = F.xxhash64("text").alias("mark")
    source = docs.select(*(F.col(c).alias(f"k{i}") for i, c in enumerate(keep)), F.col("doc_id").alias("own_id"), mark, "text")
    kept = [f"k{i}" for i in range(len(keep))]
    rows = stored(numbered(source, *kept, "own_id", "mark", "text").mapInArrow(
        _identities(shingle, [*kept, "own_id", "mark"]), schema(source, [*kept, "own_id", "mark"], "uid bigint, n bigint, h1 bigint, h2 bigint, bits binary")), "sets")
    docs = docs.select("doc_id", "text")
    bands = Bands(num, den)
    keys = docs.select("text").mapInArrow(_keys(shingle, bands), "key bigint, h1 bigint")
    classes = rows.filter("n > 0").groupBy("h1", "h2").agg(F.min("uid").alias("uid"), *(
        F.min_by(c, "uid").alias(c) for c in ("own_id", "mark")), F.first("n").alias("n"), F.first("bits").alias("bits"))
    classes = stored(classes, "classes")

    def plausible(tiles):
        """Distinct edges between sets that meet in a tile."""
        met = spread_join(tiles, shuffled(classes.select("h1", "n", "bits")), ["h1"]).repartition("tile").sortWithinPartitions("tile", "n", "h1")
        return met.select("tile", "h1", "n", "bits", "label").mapInArrow(_plausible(num, den), "a bigint, b bigint").distinct()

    groups = _candidate_groups(keys, plausible)
    classes = classes.drop("bits")
    candidates = stored(_celled(classes.join(shuffled(groups), "h1"), num, den), "candidates")
    # Texts travel once at every size.
    sets = docs.withColumn("text_mark", F.xxhash64("text")).join(
        shuffled(candidates), F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("text_mark") == F.col("mark"))).select("uid", "text", "h1", "h2").mapInArrow(_packed(shingle), "uid bigint, shingles binary")
    sets = stored(sets, "shingles")
    compare = lambda tiles: sets.join(shuffled(tiles), "uid").select("uid", "tile", "label", "shingles").groupBy("tile").applyInArrow(_verify(num, den), "a bigint, b bigint")
    links = stored(compare(candidates.select("uid", F.col("uid").alias("label"), F.explode(F.expr(FIRST_TILES)).alias("tile"))), "links")
    linked = stored(components(links), "linked")
    rest = _rest_tiles(candidates, linked.withColumnsRenamed({"node": "uid", "component": "label"}))
    more = stored(compare(rest), "links")
    if not more.isEmpty():
        linked = components(links.unionByName(more))
    named = classes.join(shuffled(linked.withColumnRenamed("node", "uid")), "uid", "left").select("h1", "h2", F.coalesce("component", "uid").alias("group"))
    back = [F.col(k).alias(c) for k, c in zip(kept, keep)]
    full = rows.filter("n > 0").join(shuffled(named), ["h1", "h2"]).select("uid", *back, F.col("n").alias("n_shingles"), "group")
    return full.unionByName(rows.filter("n = 0").select("uid", *back, F.col("n").alias("n_shingles"), F.col("uid").alias("group")))
