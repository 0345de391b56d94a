"""Decontamination, repeated passages, Jaccard join and shards against plain versions."""

import hashlib
import zlib
from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest

from rasterloom.llm import components, decontaminate, hilbert, jaccard, substrings, words


def bag(rows):
    return Counter(map(repr, rows))


@pytest.mark.parametrize("size", [10, 4])
def test_contamination(spark, docs, corpus, size):
    texts = [t for _, t in corpus]
    items = [(1, texts[3]), (2, texts[40]), (2, texts[41]), ("x", "a b"), (None, texts[7]), (4, None), (5, ""), (6, "!!"), (7, "NEW3")]
    items = [(None if i is None else str(i), t, "n") for i, t in items]
    found = decontaminate.contamination(docs, spark.createDataFrame(items, "item_id string, text string, item string"), size)
    got = [(r.doc_id, r.n_words, sum(s.end - s.pos for s in r.spans or []), r.items or []) for r in found.collect()]
    assert bag(got) == bag([(i, *x) for (i, _), x in zip(corpus, brute.contamination(texts, [x[:2] for x in items], size))])


def test_contamination_of_nothing(spark, docs, empty):
    items = spark.createDataFrame([("a", None)], "item_id string, text string")
    assert decontaminate.contamination(docs, items).filter("spans is not null").count() == 0
    assert decontaminate.contamination(empty, items).count() == 0


@pytest.mark.parametrize("size", [35, 5])
def test_repeated_passages(docs, corpus, size):
    found = substrings.repeated_passages(docs, size).collect()
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found]
    assert bag(got) == bag([(i, *x) for (i, _), x in zip(corpus, brute.repeated([t for _, t in corpus], size))])
    assert all(sum(s.end - s.pos for s in r.spans or []) == r.n_removed for r in found)


def test_repeated_passages_of_nothing(empty):
    assert substrings.repeated_passages(empty).count() == 0


@pytest.mark.parametrize(("tile", "shingle", "num", "den"), [(512, 5, 80, 100), (2, 4, 85, 100), (3, 1, 50, 100)])
def test_near_duplicates(docs, corpus, monkeypatch, tile, shingle, num, den):
    monkeypatch.setattr(jaccard, "TILE_ROWS", tile)
    found = jaccard.near_duplicates(docs, shingle, num, den).collect()
    expected = brute.groups([t for _, t in corpus], shingle, num, den)
    assert bag((r.doc_id, r.n_shingles) for r in found) == bag((i, n) for (i, _), (n, _) in zip(corpus, expected))

    def parts(rows):
        out = {}
        for doc, group in rows:
            out.setdefault(group, []).append(doc)
        return bag(sorted(x, key=repr) for x in out.values())

    assert parts((r.doc_id, r.group) for r in found) == parts((i, g) for (i, _), (_, g) in zip(corpus, expected))


def test_near_duplicates_of_nothing(empty):
    assert jaccard.near_duplicates(empty).count() == 0


def test_linked_sets_share_a_key():
    r = np.random.default_rng(3)
    for num, den in ((85, 100), (80, 100), (1, 2)):
        bands = jaccard.Bands(num, den)
        for _ in range(300):
            n = int(r.integers(1, 400))
            a = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64))
            b = a.copy()
            while True:  # change it as far as the limit allows
                c = np.unique(np.append(b[r.random(len(b)) > 0.02], r.integers(0, 1 << 63, int(r.integers(0, 3)), dtype=np.uint64)))
                both = len(np.intersect1d(a, c))
                if not len(c) or both * den < num * (len(a) + len(c) - both) or r.random() < 0.02:
                    break
                b = c
            if len(a) != len(b) or (a != b).any():
                keys = [set(np.concatenate([*jaccard.range_keys(x, bands), np.zeros(0, np.uint64)]).tolist()) for x in (a, b)]
                assert keys[0] & keys[1], (len(a), len(b))


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (500, 499), (499, 500)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert found == dict.fromkeys(range(61), 0) | dict.fromkeys(range(100, 140), 100) | {499: 499, 500: 499}
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_words_match_the_patterns(corpus):
    column = pa.array([t for _, t in corpus] + ["Ab-C_9é\x7fz\x0b— x", "  \x1c\x85"])
    for table, pattern, change in ((words.PLAIN, brute.PLAIN, str), (words.LOWER, brute.PLAIN, brute.lower), (words.ALNUM, brute.ALNUM, brute.lower)):
        w = words.Words(column, table)
        texts = [t or "" for t in column.to_pylist()]
        expected = [x.encode() for t in texts for x in pattern.findall(change(t))]
        raw = [w.data[a:b].tobytes() for a, b in zip(w.start, w.end)]
        assert [x.lower() if change is brute.lower else x for x in raw] == expected
        assert len(set(w.hash.tolist())) == len(set(expected))
        assert w.counts.tolist() == [len(pattern.findall(change(t))) for t in texts]


@pytest.mark.parametrize(("n", "bits"), [(1, 3), (2, 3), (3, 2), (4, 1)])
def test_curve_visits_neighbours(spark, n, bits):
    from pyspark.sql import functions as F

    side = 1 << bits
    cells = spark.range(side ** n).select(*(F.expr(f"cast(floor(id / {side ** i}) % {side} as int)").alias(f"c{i}") for i in range(n)))
    rows = cells.withColumn("h", hilbert.curve_index([F.col(f"c{i}") for i in range(n)], bits)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(side ** n))
    steps = [sum(abs(a[i] - b[i]) for i in range(n)) for a, b in zip(rows, rows[1:])]
    assert set(steps) <= {1}


def test_shards(spark, docs, corpus, empty):
    found = hilbert.hilbert_shards(docs, ["label", "n", "size"], shards=7).collect()
    expected = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in corpus)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == expected
    counts = Counter(r.shard for r in found)
    assert set(counts) == set(range(7)) and max(counts.values()) - min(counts.values()) <= 1
    for s in counts:
        assert sorted(r.slot for r in found if r.shard == s) == list(range(counts[s]))
    assert hilbert.hilbert_shards(empty, ["label", "size"]).count() == 0
    few = hilbert.hilbert_shards(docs.limit(3), ["label"], shards=7).collect()
    assert sorted(r.shard for r in few) == [0, 1, 2]


def test_shards_prune(spark):
    rows = spark.range(20_000).selectExpr("id as doc_id", "'t' as text", "cast(id * 7919 % 1000 as int) as x", "cast(id * 104729 % 997 as int) as y")
    found = hilbert.hilbert_shards(rows, ["x", "y"], shards=64).join(rows, "doc_id").groupBy("shard").agg({"x": "max", "y": "max"})
    low = hilbert.hilbert_shards(rows, ["x", "y"], shards=64).join(rows, "doc_id").groupBy("shard").agg({"x": "min", "y": "min"})
    boxes = found.join(low, "shard").collect()
    # A query on either dimension touches about the root of all shards, not all of them.
    for d in "xy":
        assert sum(r[f"min({d})"] <= 500 <= r[f"max({d})"] for r in boxes) <= 20


@pytest.mark.parametrize("value", ["concat('https://common.example/', lpad(cast(v as string), 4, '0'))", "v / 1000", "cast(v / 1000 as decimal(12, 4))", "v / 1000 - 5", "date_add(date'2020-01-01', v)"])
def test_shards_order_whole_values(spark, value):
    """One dimension whose values share a long beginning or lie between two whole numbers; every tenth is null."""
    rows = spark.range(4000).selectExpr("id as doc_id", "'t' as text", "cast(id * 7919 % 1000 as int) as v").selectExpr("doc_id", "text", f"if(v % 10 = 0, null, {value}) as x", "if(v % 10 = 0, -1, v) as at")
    found = hilbert.hilbert_shards(rows, ["x"], shards=16).join(rows, "doc_id").groupBy("curve").agg({"at": "min", "*": "count"}).orderBy("curve").collect()
    low = [r["min(at)"] for r in found]
    assert low == sorted(low) and low[0] == -1 and len(low) >= 25
    assert max(r["count(1)"] for r in found[1:]) <= 4000 / 16


def test_digest_is_of_the_kept_words():
    column = pa.array(["a  b\tc", None, "é ü"])
    w = words.Words(column, words.PLAIN)
    assert substrings.kept_hash(w, 0) == hashlib.sha256(b"a b c").hexdigest()
    assert substrings.kept_hash(w, 0, np.array([False, True, False])) == hashlib.sha256(b"a c").hexdigest()
    assert substrings.kept_hash(w, 1) == hashlib.sha256(b"").hexdigest()
    assert substrings.kept_hash(w, 2) == hashlib.sha256("é ü".encode()).hexdigest()
