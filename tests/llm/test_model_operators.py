"""Search, packing, urls, personal data and the classifiers."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest

from rasterloom.llm import packing, personal, quality, topk, toxicity, urls
from rasterloom.llm.queries import tokenizer_path
from rasterloom.llm.training import labelled_sample


def vectors(spark, rows):
    return spark.createDataFrame([(*r, "n") for r in rows], "vec_id bigint, embedding array<double>, shard string")


@pytest.mark.parametrize("rows", [1 << 14, 64])
def test_top_k(spark, monkeypatch, rows):
    monkeypatch.setattr(topk, "SHARD_ROWS", rows)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    monkeypatch.setattr(topk, "LEAF_ROWS", 32)
    r = np.random.default_rng(4)
    data = [(i, (r.normal(size=6) * 0.3).tolist()) for i in range(300)] + [(1000 + i, [0.5] * 6) for i in range(60)] + [(1000, [0.5] * 6), (7, [0.1])]
    odd = [(2000, None), (2001, [1.0, None]), (2002, [float("nan")] * 6), (2003, [float("inf")] * 6), (None, [1.0] * 6), (2004, [])]
    table = vectors(spark, data + odd)
    got = sorted((x.query_id, x.rank, x.vec_id, x.score) for x in topk.top_k(table, table.filter("vec_id % 20 = 0"), 20, 64).collect())
    usable = [*data, (2004, [])]
    whole = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in usable]
    expected = []
    for q, v in whole:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in whole if i != q)[:20]
            expected += [(q, n, i, -s) for n, (s, i) in enumerate(scored, 1)]
    # The repeated vec_id 1000 asks twice; its answers are ranked as one list.
    assert [x for x in got if x[0] != 1000] == sorted(x for x in expected if x[0] != 1000)
    assert {x[3] for x in got if x[0] == 1000} <= {x[3] for x in expected if x[0] == 1000}


def test_top_k_of_few_and_none(spark):
    few = vectors(spark, [(0, [1.0, 2.0]), (1, [1e300, 1.0]), (20, [1e9, -1e9])])
    got = {(x.query_id, x.vec_id): x.score for x in topk.top_k(few, few.filter("vec_id % 20 = 0")).collect()}
    assert got[0, 20] == 64 * 64_000_000_000 - 128 * 64_000_000_000
    assert got[0, 1] == (1 << 63) - 1 and len(got) == 4
    none = few.filter("vec_id < 0")
    assert topk.top_k(none, none).count() == 0 and topk.top_k(few, none).count() == 0


def test_bounds_hold():
    r = np.random.default_rng(1)
    points, queries = r.integers(-60, 60, (3000, 8)).astype(float), r.integers(-60, 60, (40, 8)).astype(float)
    order, nodes, centres, radii = topk.ball_tree(points)
    upper = topk.bounds(queries, centres, radii)
    assert sorted(order.tolist()) == list(range(3000)) and (nodes[:, 2] >= 0).any()
    for i, (low, high, _, _) in enumerate(nodes):
        assert (queries @ points[order[low:high]].T).max(axis=1).__le__(upper[:, i]).all()


def test_token_pieces():
    cache = packing.TokenCache(tokenizer_path())
    r = random.Random(1)
    parts = ["a", "B", "é", "1", "²", "'", "s", "t", "re", "ve", "ll", "'s", " ", "  ", "\n", "\t", "\u00a0", "!", "中", "🙂", "\u0301", " '", "<|endoftext|>", "\x1c", "\u3000"]
    texts = ["".join(r.choice(parts) for _ in range(r.randrange(14))) for _ in range(5000)] + ["", None, " ", "'"]
    ids, at = cache.encode(pa.array(texts))
    expected = cache.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert all(ids[at[i]:at[i + 1]].tolist() == e.ids for i, e in enumerate(expected))
    cache.limit = 10  # forgetting what is known changes nothing
    again, _ = cache.encode(pa.array(texts))
    assert (again == ids).all()


def test_pack(spark, docs, corpus, empty):
    found = packing.pack(docs, tokenizer_path(), 256, keep_ids=True).collect()
    tokenizer = packing.token_cache(tokenizer_path()).tokenizer
    expected = Counter(tuple(e.ids + [0]) for e in tokenizer.encode_batch([t or "" for _, t in corpus], add_special_tokens=False))
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in found:
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
        by_doc[p.uid].append((p.start, np.frombuffer(p.ids, "<u4").tolist(), p.doc_tokens))
        by_sequence[p.sequence_id].append((p.offset, p.length))
    whole = Counter()
    for pieces in by_doc.values():
        ids = [x for _, piece, _ in sorted(pieces) for x in piece]
        assert all(n == len(ids) for *_, n in pieces)
        whole[tuple(ids)] += 1
    assert whole == expected
    for pieces in by_sequence.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 256
    total = sum(len(k) * n for k, n in expected.items())
    assert len(by_sequence) * 256 <= total * 1.03 + 256
    assert packing.pack(empty, tokenizer_path()).count() == 0


def test_plan_fills_windows():
    r = random.Random(2)
    for _ in range(40):
        length = r.randrange(2, 120)
        counts = {r.randrange(1, length): r.randrange(1, 200) for _ in range(r.randrange(1, 40))}
        used, sequences = Counter(), 0
        for pattern, times in packing.plan(counts, length):
            assert times > 0 and sum(k * n for k, n in pattern.items()) <= length
            sequences += times
            for k, n in pattern.items():
                used[k] += n * times
        assert used == Counter(counts)
    # The fill is the best there is.
    for _ in range(60):
        counts, room = {r.randrange(1, 30): r.randrange(1, 4) for _ in range(4)}, r.randrange(1, 60)
        reach = {0}
        for k, n in counts.items():
            reach = {s + k * i for s in reach for i in range(n + 1)}
        found = packing.fill(counts, room)
        assert sum(k * n for k, n in found.items()) == max(s for s in reach if s <= room)
        assert all(n <= counts[k] for k, n in found.items())


URLS = ["http://a.net/x", "https://Example.NET/en/1", "http://www.example.net/enx", "http://example.com/de/1?q=/de/", "http://example.com/fr/", "ftp://x.org/fr/?a",
        "http://borg/fr/", "http://net", "http://a.net", "no scheme", "", None, "x://y://net/z", "http://net/", "http://a.b.org/FR/", "http://h.net#f/", "//net/", "http://ünï.net/\n/x"]


def test_urls(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS + URLS[:3])] + [(None, "http://a.net/", "h")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, tokens string")
    found = urls.verdicts(pages, spark.createDataFrame([], "doc_id bigint, quality int, toxic int")).collect()
    assert len(found) == len(rows)
    for r in found:
        url = dict((i, u) for i, u, _ in rows)[r.page_id]
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
            host, path = brute.lower(rest[:cut]), rest[cut:].split("?")[0].split("#")[0]
        rules = [x for x in urls.RULES if (host == x[1] or host.endswith("." + x[1])) and path.startswith(x[2])]
        best = max(rules, key=lambda x: len(x[1] + x[2]), default=None)
        assert (r.host, r.path, r.rule, r.verdict) == (host, path, best and best[1] + best[2], best[0] if best else "allow")


def test_url_rules_are_mined(spark):
    r = random.Random(5)
    rows = []
    for i in range(600):
        host, section, key = r.choice(["a.test", "b.test"]), r.choice(["news", "win"]), r.choice(["id", "aff"])
        bad = (host == "b.test" and section == "win") or (key == "aff" and r.random() < 0.3)
        rows.append((i, f"http://{host}/{section}/{i}?{key}=1", int(not bad), 0))
    frame = spark.createDataFrame(rows, "page_id bigint, url string, quality int, toxic int")
    labels = frame.filter("page_id % 2 = 0").selectExpr("page_id as doc_id", "quality", "toxic")
    found = {x.page_id: x for x in urls.verdicts(frame, labels).collect()}
    for i, url, *_ in rows:
        assert (found[i].verdict == "block") == ("b.test/win" in url)
    assert all(x.mined is None or len(x.mined) <= 3 for x in found.values())
    pages = frame.selectExpr("array('a', url) as tokens", "quality = 0 as bad")
    assert urls.mine(pages).count() == 0 and urls.mine(pages.limit(0)).count() == 0


@pytest.mark.parametrize("good, bad", [
    ("http://a.test/x/y/fine", "http://a.test/x/y/spam"), ("http://a.test/x/{}-fine-{}", "http://a.test/x/{}-spam-{}"), ("http://a.test/x/{}/y/2", "http://a.test/x/{}/y/3"),
    ("http://a.test/?a={}&b=1&c=1&fine=1", "http://a.test/?a={}&b=1&c=1&spam=1"), ("http://a.test/?a=fine-{}", "http://a.test/?a=spam-{}"),
    ("http://w{}.x.fine.b.c.test/", "http://w{}.x.spam.b.c.test/"), ("http://a.test/#fine", "http://a.test/#spam")])
def test_url_rules_see_every_part(spark, good, bad):
    rows = [(i, (bad if i % 3 == 0 else good).format(i, i), int(i % 3 > 0), 0) for i in range(120)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, quality int, toxic int")
    found = urls.verdicts(frame, frame.filter("page_id < 90").selectExpr("page_id as doc_id", "quality", "toxic")).collect()
    assert all((x.verdict == "block") == (x.page_id % 3 == 0) for x in found)


def test_url_rules_of_many_tokens(spark):
    """Every frequent set is tried: rules without a part that is one are those of brute force; equal long urls stay cheap."""
    r = random.Random(8)
    rows = []
    for _ in range(400):
        items = [t for t in "abcde" if r.random() < 0.7]
        rows.append((items + ["every", *(["x", "y"] if "a" in items else [])], "abcd" == "".join(items)[:4] or r.random() < 0.05))
    rows += [([f"long{i}" for i in range(40)], i % 2 == 0) for i in range(60)]
    mined = urls.mine(spark.createDataFrame(rows, "tokens array<string>, bad boolean"), 10, 0.7).collect()
    found = {tuple(x["items"]): (x["support"], round(x["support"] / x["confidence"])) for x in mined}
    sets = {}
    for n in range(1, 9):
        for items in itertools.combinations(["a", "b", "c", "d", "e", "every", "x", "y"], n):
            on = [bad for t, bad in rows if set(items) <= set(t)]
            if sum(on) >= 10 and sum(on) >= 0.7 * len(on) and not any(set(s) <= set(items) for s in sets):
                sets[items] = sum(on), len(on)
    assert len(max(sets, key=len)) > 3 and found == sets


def test_base_spans():
    r = random.Random(2)
    parts = ["a", "Z", ".", "@", "1", "25", "0", "-", "+", " ", "(", ")", "%", "é", "٣", "4111111111111111", "1.2.3.4", "a@b.c", "+1 (319) 555-5132"]
    for _ in range(20_000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(1, 14)))
        assert personal.base_spans(text) == brute.personal(text), text
    for hard in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "a@" * 100_000, "+1" * 100_000, "1-" * 100_000):  # in linear time
        personal.base_spans(hard)


def test_tagger_gradients():
    m = personal.Tagger(embed=3, hidden=4)
    m.p = {k: v.astype(np.float64) for k, v in m.p.items()}
    r = np.random.default_rng(0)
    symbols, tags = r.integers(0, personal.ALPHABET, (3, 7)), r.integers(0, personal.TAGS, (3, 7))
    _, grad = m.gradients(symbols, tags)
    for k, v in m.p.items():
        at = (int(symbols[1, 2]), 1) if k == "embed" else tuple(int(r.integers(0, d)) for d in v.shape)
        v[at] += 1e-4
        up = m.gradients(symbols, tags)[0]
        v[at] -= 2e-4
        down = m.gradients(symbols, tags)[0]
        v[at] += 1e-4
        assert abs((up - down) / 2e-4 - float(np.asarray(grad[k])[at])) < 1e-4, k


def test_windows_own_each_character_once():
    spans = [(3, 0, 40), (44, 2, 60), (60, 2, 120), (200, 1, 215)]
    text = "".join("1" if any(a <= i < b for a, _, b in spans) else "x" for i in range(260))
    numbers, _ = personal.windows(personal.codes(text))
    line = np.pad(personal.tagged(len(text), spans), (personal.MARGIN, personal.WINDOW))
    tags = line[numbers[:, None] * personal.STEP + np.arange(personal.WINDOW)]
    assert personal.reconciled(tags, len(text), numbers) == spans


def test_personal_data(spark, docs, corpus, empty):
    made = [(9000 + i, f"{corpus[i % 20][1]} mail bob.{i}@mail{i % 9}.example.com or +1 ({200 + i}) 555-{1000 + i} from 10.{i % 99}.3.4 end {i}", *["z"] * 2, 1, *["z"] * 3, 1, "z")
            for i in range(40)]
    table = docs.unionByName(spark.createDataFrame(made, docs.schema))
    found = personal.find_personal_data(table, keep=("doc_id", "text")).collect()
    assert len(found) == len(corpus) + 40
    for r in found:
        base = [(s.start, personal.KINDS.index(s.kind), s.end) for s in r.spans if s.base]
        assert base == brute.personal(r.text or "")
        assert [(s.start, personal.KINDS.index(s.kind)) for s in r.spans] == sorted((s.start, personal.KINDS.index(s.kind)) for s in r.spans)
    clean = personal.masked(personal.find_personal_data(table, keep=("doc_id", "text"))).filter("doc_id >= 9000").collect()
    assert all("[EMAIL] or [PHONE] from [IP] end" in r.text and "@" not in r.text for r in clean)
    assert personal.find_personal_data(empty).count() == 0


def labelled(spark, n=400):
    r = random.Random(8)
    words = ["".join(r.choice("abcdefg") for _ in range(4)) for _ in range(80)]
    docs, labels = [], []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randrange(20, 90))]
        bad, junk = i % 5 == 0, i % 4 == 0
        if bad:
            for _ in range(r.randrange(1, 8)):
                text[r.randrange(len(text))] = r.choice(["vilest", f"grub{r.choice(words)}"])
        text = " ".join(f"{w}!!" if junk else w for w in text)
        docs.append((i, text, 0.5))
        labels.append((i, int(not junk), int(bad)))
    docs += [(n, None, 0.5), (n + 1, "", 0.5), (None, "a b", 0.5), (1, docs[1][1], 0.5)]
    labels += [(None, 1, 1), (3, None, None)]
    return spark.createDataFrame(docs, "doc_id bigint, text string, toxic double"), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"), dict((a, (b, c)) for a, b, c in labels[:n])


def test_quality(spark):
    docs, labels, truth = labelled(spark)
    found = quality.quality_scores(docs, labels.filter("doc_id % 2 = 0 or doc_id is null")).collect()
    assert len(found) == 404 and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.doc_id in truth and r.doc_id % 2]
    held_even = [r for r in found if r.doc_id in truth and r.doc_id % 2 == 0]
    right = sum((r.score >= 0.5) == bool(truth[r.doc_id][0]) for r in held + held_even)
    assert right >= 0.97 * len(held + held_even)
    one = quality.quality_scores(docs, labels.filter("quality = 1")).collect()
    assert all(r.score > 0.5 for r in one)
    none = quality.quality_scores(docs.limit(5), labels.limit(0)).collect()
    assert [r.score for r in none] == [0.5] * 5
    assert quality.quality_scores(docs.limit(0), labels).count() == 0


def test_toxicity(spark):
    docs, labels, truth = labelled(spark, 800)
    found = toxicity.toxicity(docs, labels.filter("doc_id % 3 <> 1 or doc_id is null")).collect()
    assert len(found) == 804
    held = [r for r in found if r.doc_id in truth and r.doc_id % 3 == 1]
    assert sum((r.toxic >= 0.5) == bool(truth[r.doc_id][1]) for r in held) >= 0.97 * len(held)
    empty = [r for r in found if r.doc_id in (800, 801)]
    assert all(r.toxic < 0.5 for r in empty)
    assert all(r.toxic < 0.5 for r in toxicity.toxicity(docs, labels.filter("toxic = 0")).collect())
    assert all(r.toxic < 0.5 for r in toxicity.toxicity(docs, labels.limit(0)).collect())
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


def test_chain_reads_out_of_fold_predictions():
    """A later model is fitted on probabilities of models that have not seen the row."""
    r = np.random.default_rng(0)
    n = 200
    toxic = r.random(n) < 0.5
    row, at = np.arange(n), np.arange(n) % toxicity.KEPT  # each row has a feature of its own: pure memory
    models = toxicity.fit_chain(np.arange(n) % toxicity.FOLDS, row, at, np.ones(n), np.full(n, 9.0), toxic)
    # In-fold predictions would be perfect and their weight large; out of fold they say nothing.
    assert abs(models[-1].d[0]) < 0.5 * np.abs(models[0].w[:n]).mean() + 1.0
    assert [len(m.d) for m in models] == [0, 1, 2]


def test_sample_is_bounded_on_repeated_ids(spark):
    docs = spark.range(600).selectExpr("if(id < 500, 0, id) as doc_id", "if(id % 7 = 3, null, concat('text ', id)) as text")
    labels = spark.range(600).selectExpr("if(id < 3, 0, id + 480) as doc_id", "cast(id % 2 as int) as quality")
    found = labelled_sample(docs, labels, ["quality"], 600).collect()
    chosen = Counter(x.doc_id for x in labels.collect() if x.doc_id == 0 or 500 <= x.doc_id < 600)
    assert Counter(x.doc_id for x in found) == chosen and len({x.text for x in found if x.doc_id == 0}) == 1
