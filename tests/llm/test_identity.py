"""Texts that a polynomial modulo a power of two cannot tell apart, repeated ids and hot keys."""

import re
import time
import zlib

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest

from rasterloom.llm import components, decontaminate, jaccard, packing, personal, substrings
from rasterloom.llm import words as W

SCHEMA = "doc_id bigint, text string"


def thue_morse(n):
    return "".join("ab"[i.bit_count() % 2] for i in range(n)), "".join("ba"[i.bit_count() % 2] for i in range(n))


@pytest.fixture(scope="module")
def twins(spark):
    a, b = thue_morse(1024)
    return spark.createDataFrame([(1, a), (2, b)], SCHEMA)


def test_residues():
    r = np.random.default_rng(4)
    a, b = (r.integers(0, W.PRIME, 500, dtype=np.uint64) for _ in range(2))
    a[:3], b[:3] = [0, W.PRIME - 1, W.PRIME - 1], [5, W.PRIME - 1, 1]
    assert W.times(a, b).tolist() == [int(x) * int(y) % W.PRIME for x, y in zip(a, b)]
    values = r.integers(0, 1 << 63, 300, dtype=np.uint64)
    start, end = np.array([0, 10, 40, 299]), np.array([300, 60, 40, 300])
    for lane in (0, 1):
        want = [sum(int(v) * pow(W.BASES[lane], k, W.PRIME) for k, v in enumerate(values[s:e])) % W.PRIME for s, e in zip(start, end)]
        raw = np.array(want, np.uint64) ^ ((end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
        assert W.Residues(values, lane).hashes(start, end, 7).tolist() == W.mix(raw, 7).tolist()


def test_near_duplicates_tell_twins_apart(twins):
    found = jaccard.near_duplicates(twins, shingle=4, num=85, den=100).collect()
    assert len({r.group for r in found}) == 2


def test_contamination_tells_twins_apart(spark, twins):
    items = spark.createDataFrame([("i", thue_morse(1024)[0])], "item_id string, text string")
    assert {r.doc_id: r["items"] for r in decontaminate.contamination(twins, items).collect()} == {1: ["i"], 2: None}


def test_repeated_passages_tell_twins_apart(spark):
    a, b = thue_morse(1024)
    docs = spark.createDataFrame([(1, " ".join([a] * 35)), (2, " ".join([b] * 35))], SCHEMA)
    assert [r.n_removed for r in substrings.repeated_passages(docs).collect()] == [0, 0]


def test_packing_tells_twins_apart(spark):
    path = P.path("byte_bpe_50k.json")
    texts = thue_morse(2048)
    found = {r.doc_id: r.ids_crc32 for r in packing.pack(spark.createDataFrame(list(enumerate(texts)), SCHEMA), path, length=1 << 16).collect()}
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    for i, text in enumerate(texts):
        assert found[i] == zlib.crc32(np.array([*tokenizer.encode(text).ids, 0], "<u4"))
    assert found[0] != found[1]


@pytest.mark.parametrize("name, n", [(7, 20_000), (None, 2_000)])
def test_many_texts_of_one_id(spark, name, n):
    """20,000 rows of one id: each meets its own text, not those of all others."""
    rows = [(name, " ".join(f"w{i}x{k}" for k in range(40))) for i in range(n)]
    rows += [(1, rows[5][1]), (2, rows[6][1] + " more")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(8)
    found = substrings.repeated_passages(docs).filter("n_removed > 0").groupBy("n_removed").count().collect()
    assert {r.n_removed: r["count"] for r in found} == {40: 4}
    groups = jaccard.near_duplicates(docs).groupBy("group").count().filter("count > 1").collect()
    assert sorted(r["count"] for r in groups) == [2, 2]


def near_copies(spark, n):
    """One text in n versions, each with a word of its own, and as many texts that share a passage only."""
    base = [f"b{k}" for k in range(60)]
    rows = [(i, " ".join([*base[:30], f"own{i}", *base[30:]])) for i in range(n)]
    rows += [(n + i, " ".join([*base[:8], *(f"t{i}x{k}" for k in range(25))])) for i in range(n // 4)]
    return spark.createDataFrame(rows, SCHEMA).repartition(8)


@pytest.mark.parametrize("tile", [8, 64, 512])
def test_hot_keys_lose_no_link(spark, monkeypatch, tile):
    monkeypatch.setattr(jaccard, "TILE_ROWS", tile)
    found = jaccard.near_duplicates(near_copies(spark, 300), shingle=4, num=80, den=100).collect()
    groups = {}
    for r in found:
        groups.setdefault(r.group, set()).add(r.doc_id)
    assert sorted(map(len, groups.values())) == [1] * 75 + [300] and set(range(300)) in groups.values()


def test_what_grows_is_never_broadcast(spark, monkeypatch):
    """Tiles unfold from small stored tables, which Spark takes for as small; they stay out of the driver."""
    plans = []
    for module in (jaccard, components):
        def noted(df, name="llm", real=module.stored):
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return real(df, name)

        monkeypatch.setattr(module, "stored", noted)
    monkeypatch.setattr(jaccard, "TILE_ROWS", 8)
    found = jaccard.near_duplicates(near_copies(spark, 100), shingle=4, num=80, den=100)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    joins = [set(re.findall(rf"{kind}Join \[(\w+)#", "\n".join(plans))) for kind in ("SortMerge", "BroadcastHash")]
    assert joins[0] >= {"_h1", "_hot", "_hi", "_lo", "uid", "h1"}
    assert joins[1] <= {"group"}, "one row a group or a cell of it"


def test_edges_grow_like_the_group(spark, monkeypatch):
    """Rows of tiles and plausible edges of one large group of near copies: in proportion to its size."""
    made = {}
    real = jaccard.stored
    for n in (500, 2000):
        counts = made.setdefault(n, {"runs": 0, "hot": 0, "edges": 0, "outside": 0})

        def counting(df, name="llm"):
            table = real(df, name)
            if name in counts:
                counts[name] += table.count()
            return table

        monkeypatch.setattr(jaccard, "stored", counting)
        monkeypatch.setattr(jaccard, "TILE_ROWS", 64)
        jaccard.near_duplicates(near_copies(spark, n), shingle=4, num=80, den=100).count()
    for kind in ("runs", "hot", "edges"):
        assert made[2000][kind] < 5 * made[500][kind] + 100, made
    assert made[2000]["edges"] < 4 * 2000, made  # the lists of three steps, each with those before


@pytest.mark.parametrize("rows", [7, 300, 100_000])
def test_owners_of_large_keys_come_block_by_block(rows):
    r = np.random.default_rng(0)
    sizes = {-5: 3, -2: 119, 4: 64, 7: 65, 9: 1, 11: 1800}
    key, owner = np.repeat(list(sizes), list(sizes.values())), np.concatenate([r.permutation(10_000)[:n] for n in sizes.values()])
    batches = [pa.RecordBatch.from_arrays([pa.array(x[i:i + rows]) for x in (key, owner)], ["key", "h1"]) for i in range(0, len(key), rows)]
    for star in (True, False):
        tiles, hot = {}, {}
        for b in jaccard._runs(star, 64)(iter(batches)):
            for tile, h1, k in zip(*(b.column(c).to_pylist() for c in ("tile", "h1", "hot"))):
                (hot if tile is None else tiles).setdefault(k if tile is None else tile, set()).add(h1)
        at = 0
        for k, n in sizes.items():
            own, at = owner[at:at + n].tolist(), at + n
            if star or n <= 64:  # all meet the first block; one owner meets nobody
                first = set(own[:32] if n > 64 else own)
                assert n == 1 or all(any(x in t and first <= t for t in tiles.values()) for x in own)
            else:
                assert hot[k] == set(own)
        assert sum(map(len, tiles.values())) < 2.2 * len(owner) and max(map(len, tiles.values())) <= 64


def test_spans_merge_in_linear_time():
    r = np.random.default_rng(1)
    rows = [sorted({(int(p), int(p) + int(n)) for p, n in zip(r.integers(0, 300, k), r.integers(1, 12, k))}) for k in (0, 1, 40, 0, 90)]
    rows.append([(2 * i, 2 * i + 1) for i in range(100_000)])  # touch nowhere
    rows.append([(i, i + 10) for i in range(100_000)])  # all one
    at = pa.array([[{"pos": p, "end": e} for p, e in row] for row in rows], pa.list_(pa.struct([("pos", pa.int32()), ("end", pa.int32())])))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows))), at, pa.array([["i"]] * len(rows))], ["uid", "at", "items"])
    start = time.perf_counter()
    found = [[(s["pos"], s["end"]) for s in row] for b in decontaminate._merged(iter([batch])) for row in b.column("spans").to_pylist()]
    assert time.perf_counter() - start < 5
    for row, spans in zip(rows, found):
        want = []
        for p, e in row:
            if want and p <= want[-1][1]:
                want[-1] = want[-1][0], max(want[-1][1], e)
            else:
                want.append((p, e))
        assert spans == want


def test_masking_in_linear_time():
    text, email = "a@b.c " * 100_000, personal.KINDS.index("email")
    start = time.perf_counter()
    assert personal.mask(text, [(6 * i, email, 6 * i + 5, True) for i in range(100_000)]) == "[EMAIL] " * 100_000
    assert time.perf_counter() - start < 5
    ip, card, phone = map(personal.KINDS.index, ("ip", "card", "phone"))
    assert personal.mask("0123456789", [(1, ip, 4, True), (3, card, 6, True), (5, phone, 8, True)]) == "0[IP]89"
