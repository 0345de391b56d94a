"""Exact top-k inner-product search: ball trees per shard, searched best first."""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from rasterloom.llm.tables import stored

#: Vectors of a shard, queries of a block and vectors of a tree's leaf.
SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 1 << 14, 1 << 10, 256
#: Blocks that one task searches in one shard.
WAVE_BLOCKS = 8
EXACT = 1 << 53


def integers(vectors, scale):
    """floor(scale * x) of each component; shorter vectors are padded with zeros. Python integers where doubles are not exact."""
    width = max([1, *map(len, vectors)])
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    if not out.size or np.abs(out).max() * scale < EXACT:
        return np.floor(out * scale)
    return np.array([[math.floor(x * scale) if abs(x) * scale < EXACT else int(x) * scale for x in row] for row in out.tolist()], object)


def products(a, b):
    """Exact inner products of the rows of two integer matrices, as doubles or Python integers."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    if a.dtype != object and b.dtype != object:
        most = width * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
        if most < 1 << 24:
            return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.float64)
        if most < EXACT:
            return a @ b.T
    a, b = (np.array([[int(x) for x in r] for r in m.tolist()], object).reshape(m.shape) for m in (a, b))
    return a.dot(b.T)


def ball_tree(points):
    """Order of the points and nodes (low, high, left child or -1, right child); each node's centre and radius.

    A node is halved at the median of its widest dimension, so repeated points do not deepen the tree.
    """
    order, nodes, centres, radii = np.arange(len(points)), [], [], []

    def build(low, high):
        own = points[order[low:high]]
        centre = own.mean(axis=0)
        at = len(nodes)
        nodes.append([low, high, -1, -1])
        centres.append(centre)
        radii.append(float(np.sqrt(((own - centre) ** 2).sum(axis=1).max())))
        if high - low > LEAF_ROWS:
            axis = int(np.argmax(own.max(axis=0) - own.min(axis=0)))
            middle = (low + high) // 2
            order[low:high] = order[low:high][np.argpartition(own[:, axis], middle - low)]
            nodes[at][2] = build(low, middle)
            nodes[at][3] = build(middle, high)
        return at

    build(0, len(points))
    return order, np.array(nodes), np.array(centres), np.array(radii)


def bounds(queries, centres, radii):
    """Upper bound of each query's inner product with any point of each ball, with room for rounding."""
    width = min(queries.shape[1], centres.shape[1])
    norms = np.sqrt((queries ** 2).sum(axis=1))[:, None]
    reach = norms * radii[None, :]
    upper = (queries[:, :width] @ centres[:, :width].T + reach) + 1e-9 * (norms * np.sqrt((centres ** 2).sum(axis=1))[None, :] + reach) + 1e-6
    return np.nan_to_num(upper, nan=np.inf, posinf=np.inf, neginf=np.inf)  # beyond doubles nothing is ruled out


class Best:
    """The k best (score, id) of each query so far, higher scores first, ties to the smaller id."""

    def __init__(self, n, k, least):
        self.k, self.least = k, least
        self.found, self.waiting = [np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64)], []
        self.n = n

    def add(self, query, score, name):
        self.waiting.append((query, score, name))
        if sum(len(w[0]) for w in self.waiting) > self.k * self.n:
            self.settle()

    def settle(self):
        if not self.waiting:
            return
        query, score, name = (np.concatenate(x) for x in zip(self.found, *self.waiting))
        order = np.lexsort((name, -score, query)) if score.dtype != object else sorted(range(len(score)), key=lambda i: (query[i], -score[i], name[i]))
        query, score, name = query[order], score[order], name[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self.k
        last = place == self.k - 1
        if score.dtype == object:
            self.least = self.least.astype(object)
        self.least[query[last]] = np.maximum(self.least[query[last]], score[last])
        self.found, self.waiting = [query[keep], score[keep], name[keep]], []


def search(queries, query_ids, points, ids, nodes, centres, radii, k, least):
    """Branch and bound over one tree for a block of queries.

    ``least`` is the k-th best score known of each query, from other shards at first; it rises as this
    tree is searched. Nodes are taken by their highest upper bound; only queries whose bound reaches
    their k-th score go into a node.
    """
    best = Best(len(queries), k, least)
    upper = bounds(queries.astype(float), centres, radii)
    heap = [(-upper[:, 0].max(initial=-np.inf), 0)]
    while heap:
        _, at = heapq.heappop(heap)
        active = np.flatnonzero(upper[:, at] >= best.least)
        if not len(active):
            continue
        low, high, left, right = nodes[at]
        if left >= 0:
            for child in (left, right):
                heapq.heappush(heap, (-upper[active, child].max(), int(child)))
            continue
        score = products(queries[active], points[low:high])
        wanted = (score >= best.least[active][:, None]) & (query_ids[active][:, None] != ids[low:high][None, :])
        q, p = np.nonzero(wanted)
        best.add(active[q], score[q, p], ids[low + p])
        if not np.isfinite(best.least[active].astype(float)).all():
            best.settle()
    best.settle()
    return best.found


def _rows(table, column):
    return [np.asarray(x) for c in table.column(column).chunks for x in np.split(c.flatten().to_numpy(zero_copy_only=False), c.value_lengths().to_numpy().cumsum()[:-1])] \
        if table.num_rows else []


def _blob(x):
    """A matrix as bytes; Python integers as text."""
    return x.tobytes() if x.dtype != object else ("#" + ",".join(map(str, x.ravel().tolist()))).encode()


SHARD = "shard bigint, ids binary, big boolean, points binary, nodes binary, centres binary, radii binary"


def _build(scale):
    def run(table):
        points = integers(_rows(table, "vector"), scale)
        ids = table.column("vec_id").to_numpy()
        order, nodes, centres, radii = ball_tree(points.astype(float))
        return pa.table({
            "shard": pa.array([table.column("shard")[0].as_py()], pa.int64()), "ids": [ids[order].astype(np.int64).tobytes()],
            "big": [points.dtype == object], "points": [_blob(points[order])], "nodes": [nodes.astype(np.int64).tobytes()],
            "centres": [centres.tobytes()], "radii": [radii.tobytes()]})
    return run


def _block(scale):
    def run(table):
        queries = integers(_rows(table, "vector"), scale)
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64()), "query_ids": [table.column("vec_id").to_numpy().astype(np.int64).tobytes()],
                         "big_queries": [queries.dtype == object], "queries": [_blob(queries)]})
    return run


def _load(row):
    ids, query_ids = (np.frombuffer(row[c], np.int64) for c in ("ids", "query_ids"))
    nodes = np.frombuffer(row["nodes"], np.int64).reshape(-1, 4)
    points, queries = (
        np.array([int(x) for x in row[c][1:].decode().split(",")], object).reshape(n, -1) if row[big] else np.frombuffer(row[c]).reshape(n, -1)
        for c, big, n in (("points", "big", len(ids)), ("queries", "big_queries", len(query_ids))))
    return queries, query_ids, points, ids, nodes, np.frombuffer(row["centres"]).reshape(len(nodes), -1), np.frombuffer(row["radii"])


def _first_scores(k):
    """k-th best score of each query in the leaf with its highest bound: what a shard has to offer to the others."""
    def run(blocks, trees):
        out = [[], [], []]
        for row in _pairs(blocks, trees):
            queries, query_ids, points, ids, nodes, centres, radii = _load(row)
            if object in (queries.dtype, points.dtype):
                continue  # a rounded score may not cut exact integers
            leaves = np.flatnonzero(nodes[:, 2] < 0)
            choice = leaves[bounds(queries.astype(float), centres[leaves], radii[leaves]).argmax(axis=1)]
            for leaf in np.unique(choice).tolist():
                q = np.flatnonzero(choice == leaf)
                low, high = nodes[leaf, :2]
                score = products(queries[q], points[low:high])
                if score.dtype == object:
                    continue
                score[query_ids[q][:, None] == ids[low:high][None, :]] = -np.inf
                if high - low >= k:
                    for x, y in zip(out, ([row["block"]] * len(q), q.tolist(), np.partition(score, high - low - k, axis=1)[:, high - low - k].tolist())):
                        x += y
        return pa.table({"block": pa.array(out[0], pa.int64()), "q": pa.array(out[1], pa.int32()), "least": pa.array(out[2], pa.float64())})
    return run


def _search(k):
    def run(blocks, trees):
        out = [[], [], []]
        for row in _pairs(blocks, trees):
            loaded = _load(row)
            least = np.full(len(loaded[1]), -np.inf)
            for x in row["known"] or ():
                least[x["q"]] = x["least"]
            if object in (loaded[0].dtype, loaded[2].dtype):
                least[:] = -np.inf
            q, score, name = search(*loaded, k, least)
            limit = (1 << 63) - 1
            for x, y in zip(out, (loaded[1][q].tolist(), name.tolist(), [min(limit, max(-limit - 1, int(v))) for v in score.tolist()])):
                x += y
        return pa.table({c: pa.array(x, pa.int64()) for c, x in zip(("query_id", "vec_id", "score"), out)})
    return run


def _pairs(blocks, trees):
    """Rows of a block of queries and the one tree of the group; groups without either give nothing."""
    tree = trees.to_pylist()
    return [b | tree[0] for b in blocks.to_pylist()] if tree else []


def top_k(vectors, queries, k=20, scale=64):
    """The k vectors with the highest inner product of each query, exactly.

    ``vectors`` and ``queries``: vec_id (long), embedding (array of numbers); other columns are ignored.
    Components become floor(scale * x). Candidates are all vectors but those with the query's own
    vec_id; ties go to the smaller vec_id. Vectors that are null, hold null or non-finite components or
    have no vec_id take no part. Vectors of different lengths are compared as if padded with zeros;
    repeated rows are candidates each; scores beyond a long are cut to its range. Fewer than k
    candidates give fewer rows, empty tables none.

    Vectors are dealt to shards of about SHARD_ROWS by a hash, so a hot source or copies of a vector
    spread. Each shard is one stored ball tree. Queries travel in blocks, each to every shard. First
    each shard names the k-th best score of the most promising leaf; the highest over all shards is
    shared as the score to beat. The search then opens nodes in order of their upper bounds and raises
    that score as it goes. A shard returns at most k rows a query.

    Returns query_id, rank (from 1), vec_id, score.
    """
    spark = vectors.sparkSession
    fine = F.col("vector").isNotNull() & F.col("vec_id").isNotNull() & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | F.abs(x).isin(float("inf")))
    clean = lambda df: df.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")).filter(fine)
    vectors, queries = clean(vectors), clean(queries)
    shards = -(-vectors.count() // SHARD_ROWS)
    blocks = -(-queries.count() // BLOCK_ROWS)
    salt = F.xxhash64("vec_id", F.monotonically_increasing_id())
    trees = vectors.withColumn("shard", F.pmod(salt, F.lit(max(1, shards)))).groupBy("shard").applyInArrow(_build(scale), SHARD)
    asked = queries.withColumn("block", F.pmod(salt, F.lit(max(1, blocks)))).groupBy("block").applyInArrow(
        _block(scale), "block bigint, query_ids binary, big_queries boolean, queries binary")
    trees, asked = stored(trees, "trees"), stored(asked, "queries")
    every = lambda n, name: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(max(1, n) - 1).cast("bigint"))).alias(name)
    wave = F.floor(F.col("block") / WAVE_BLOCKS).alias("wave")
    trees = trees.select("*", every(-(-blocks // WAVE_BLOCKS), "wave")).groupBy("shard", "wave")
    meet = lambda blocks, f, out: blocks.select("*", wave, every(shards, "shard")).groupBy("shard", "wave").cogroup(trees).applyInArrow(f, out)
    first = meet(asked, _first_scores(k), "block bigint, q int, least double").filter("least > double('-infinity')")
    known = first.groupBy("block", "q").agg(F.max("least").alias("least")).groupBy("block").agg(F.collect_list(F.struct("q", "least")).alias("known"))
    found = meet(asked.join(stored(known, "scores"), "block", "left"), _search(k), "query_id bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
