"""Whitening, packing by complements and token alignment against plain versions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F

from rasterloom.llm import alignment, complement, whitening
from rasterloom.llm import words as W
from rasterloom.llm.packing import TokenCache
from rasterloom.llm.tokens import SpacedTokens, load

WORD, BYTE, PIECE = (P.path(n) for n in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
STRANGE = "ab 12.\t\n'sΣσς éßﬁ漢字 ́İ \u0085 ▁<s>|endoftext|>😀x" + "\U0001d7d8"


def texts(n, seed=3):
    r = random.Random(seed)
    out = ["".join(r.choice(STRANGE) for _ in range(r.randrange(60))) for _ in range(n)]
    return [*out, "x" * 3000, "<|endoftext|> </s> <0x41>", "a  b   c    d ", " lead", "It's ΣΑΣ ok'LL", "a" + " " * 40 + "b"]


# Tokens ---------------------------------------------------------------------------------------

@pytest.mark.parametrize("kind, path", [(SpacedTokens, WORD), (TokenCache, BYTE)])
def test_ids_by_pieces_are_the_tokenizers(kind, path):
    import pyarrow as pa

    rows = texts(600)
    ids, at = kind(path, 50).encode(pa.array([*rows, None]))
    whole = [x.ids for x in load(path).encode_batch(rows, add_special_tokens=False)]
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [*whole, []]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        SpacedTokens(BYTE)
    with pytest.raises(ValueError):
        TokenCache(WORD)


# Whitening ------------------------------------------------------------------------------------

def plain_whitening(rows, k):
    """Exact fractions for the moments, eigh for the axes."""
    sane = [(i, [int(np.floor(64 * float(c))) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in sane})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    y = [[n * x[j] - s[j] for j in range(d)] for x in fit]
    v = np.array([[float(Fraction(sum(r[i] * r[j] for r in y), n**3)) for j in range(d)] for i in range(d)])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    out = []
    for i, x in sane:
        own = [n * a - b for a, b in zip(x, s)]
        w = np.array([float(Fraction(c, n)) for c in own]) @ u / np.sqrt(e)
        out += [(i, c + 1, n, sum(a * a for a in own), w[c], e[c] / np.trace(v)) for c in range(len(e))]
    return out


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", 0.5, 1) for i, v in rows], "vec_id bigint, embedding array<float>, x string, whitened double, component int").repartition(4)


@pytest.mark.parametrize("spread", [1.0, 3e4, 1e13])
def test_whitening(spark, spread):
    r = np.random.default_rng(1)
    base = (r.normal(size=(150, 5)) @ r.normal(size=(5, 5)) * spread).astype(np.float32).tolist()
    rows = [(i, v) for i, v in enumerate(base)] + [(1000 + i, base[0]) for i in range(60)] + [(0, base[1]), (None, base[2])]
    rows += [(7, None), (8, [1.0, None, 0.0, 0.0, 0.0]), (9, [float("nan")] + [0.0] * 4), (10, [float("inf")] + [0.0] * 4), (11, [])]
    found = whitening.whiten(vectors(spark, rows), components=4).collect()
    want = plain_whitening(rows, 4)
    key = lambda x: (x[0] is None, x[0] or 0, x[1], x[3])
    found = sorted(((x.vec_id, x.component, x.n, int(x.deviation), x.whitened, x.explained, x.identity_error) for x in found), key=key)
    want.sort(key=key)
    assert [x[:4] for x in found] == [x[:4] for x in want]
    assert np.allclose([x[5] for x in found], [x[5] for x in want], rtol=1e-9)
    assert {x[6] for x in found}.pop() < 1e-9 and len({x[6] for x in found}) == 1
    for c in range(1, 5):  # either sign, the same for all rows
        a, b = (np.array([x[4] for x in t if x[1] == c]) for t in (found, want))
        assert np.allclose(a, b, atol=1e-8) or np.allclose(a, -b, atol=1e-8)


def test_whitening_without_scale(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, None)])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0])] * 3)).collect() == []
    line = whitening.whiten(vectors(spark, [(i, [float(i), 2.0 * i, 5.0]) for i in range(9)])).collect()
    assert len(line) == 9 and {x.component for x in line} == {1} and line[0].explained == pytest.approx(1)
    with pytest.raises(Exception, match="differ in length"):
        whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0])])).collect()


def test_squares_are_exact():
    r = random.Random(5)
    for top in (10, 1 << 40, 1 << 54, 1 << 80):
        z = [[r.randrange(-top, top) for _ in range(3)] for _ in range(20)]
        hh, hl, ll = whitening.squares(np.array(z, np.int64 if top < 1 << 62 else object))
        got = [(int(a) << 52) + (int(b) << 27) + int(c) for a, b, c in zip(hh, hl, ll)]
        assert got == [sum(row[j] ** 2 for row in z) for j in range(3)]


# Packing --------------------------------------------------------------------------------------

def test_sums_find_every_filling():
    r = random.Random(9)
    for _ in range(300):
        size = r.randrange(4, 30)
        left = np.array([0] + [r.choice([0, 0, 1, 2]) for _ in range(size)])
        room = r.randrange(1, size)
        pieces = [i for i, n in enumerate(left) for _ in range(n)]
        one = {(p,) for p in pieces}
        two = {tuple(sorted((pieces[i], pieces[j]))) for i in range(len(pieces)) for j in range(i)}
        three = {tuple(sorted((pieces[i], pieces[j], pieces[k]))) for i in range(len(pieces)) for j in range(i) for k in range(j)}
        can = [c for c in one | two | three if sum(c) == room]
        got = complement.Sums(left).filling(room)
        assert bool(got) == bool(can) and (not got or tuple(sorted(got)) in can)


def test_plan_uses_all_pieces():
    r = random.Random(2)
    for _ in range(60):
        counts = {r.randrange(1, 64): r.choice([1, 3, 1000, 10**9]) for _ in range(r.randrange(1, 40))}
        patterns, used = complement.plan(counts, 64), Counter()
        for pattern, times in patterns:
            assert sum(s * n for s, n in pattern.items()) <= 64
            for s, n in pattern.items():
                used[s] += n * times
        assert used == Counter(counts) and len(patterns) < 20 * len(counts) + 64


def least_sequences(pieces, room):
    """Fewest sequences, by trying everything."""
    best = [len(pieces)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(pieces):
            best[0] = len(bins)
            return
        for b in {x: k for k, x in enumerate(bins) if x >= pieces[i]}.values():
            put(i + 1, bins[:b] + [bins[b] - pieces[i]] + bins[b + 1:])
        put(i + 1, bins + [room - pieces[i]])

    put(0, [])
    return best[0]


def best_fit(pieces, room):
    """Sequences that best fit alone takes, longest first."""
    bins = []
    for p in sorted(pieces, reverse=True):
        fits = [x for x in bins if x >= p]
        if fits:
            bins.remove(min(fits))
        bins.append((min(fits) if fits else room) - p)
    return len(bins)


def test_plan_is_near_the_least():
    r, extra = random.Random(4), 0
    for _ in range(80):
        pieces = sorted((r.randrange(1, 20) for _ in range(9)), reverse=True)
        made = sum(t for _, t in complement.plan(Counter(pieces), 20))
        least = least_sequences(pieces, 20)
        assert least <= made <= least + 1
        extra += made - least
    assert extra <= 8


def test_complements(spark, docs, corpus, empty):
    found = complement.pack_complements(docs, WORD, length=128, keep_ids=True).collect()
    tokenizer = load(WORD)
    want = Counter()
    for i, text in corpus:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        for k in range(0, len(ids), 128):
            blob = np.array(ids[k:k + 128], "<u4").tobytes()
            want[i, k // 128, k, len(blob) // 4, zlib.crc32(blob), blob] += 1
    assert Counter((x.doc_id, x.piece, x.start, x.length, x.ids_crc32, bytes(x.ids)) for x in found) == want
    bins = defaultdict(list)
    for x in found:
        bins[x.sequence_id].append((x.offset, x.length))
    for parts in bins.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at <= 128
    assert len(bins) <= best_fit([x.length for x in found], 128)
    assert complement.pack_complements(empty, WORD).collect() == []


# Alignment ------------------------------------------------------------------------------------

def plain_alignment(rows):
    import sentencepiece

    a, b = load(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    token_a, token_b = alignment.ByteTokens(BYTE).bytes, alignment.PieceTokens(PIECE).bytes
    done, counts = [], Counter()
    for i, text in rows:
        ia, ib = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        whole = (" " + (text or "")).encode()
        if b"".join(token_a[x] for x in ia) != whole or b"".join(token_b[x] for x in ib) != whole:
            done.append((i, [], [], [], []))
            continue
        spans = []
        for ids, token in ((ia, token_a), (ib, token_b)):
            at, out = 0, []
            for x in ids:
                out.append((at, at + len(token[x]), x))
                at += len(token[x])
            spans.append(out)
        links = [(p[2], q[2]) for p in spans[0] for q in spans[1] if p[0] < q[1] and q[0] < p[1]]
        common = sorted({p[1] for p in spans[0]} & {q[1] for q in spans[1]})
        groups, low = [], 0
        for high in common:
            groups.append("|".join(",".join(str(x[2]) for x in s if low < x[1] <= high) for s in spans))
            low = high
        counts.update(set(links))
        done.append((i, ia, ib, groups, links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return Counter((i, len(ia), len(ib), len(g), len(k), sum(counts[p] == best[p[0]] for p in k), sum(counts[p] for p in k),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for i, ia, ib, g, k in done)


def aligned(df):
    return Counter((x.doc_id, x.n_a, x.n_b, x.n_groups, x.n_links, x.n_best, x.count_sum, x.groups_sha256) for x in df.collect())


def test_alignment(spark, docs, corpus, empty, monkeypatch):
    short = [(i, t if t is None else t[:900]) for i, t in corpus] + list(enumerate(texts(150), 5000))
    df = spark.createDataFrame([(*r, 1, "s", 2) for r in short], "doc_id bigint, text string, n_a bigint, slice string, pairs int").repartition(3)
    want = plain_alignment(short)
    assert aligned(alignment.align(df, BYTE, PIECE)) == want
    assert aligned(alignment.align(docs.filter(F.length("text") < 2000).unionAll(docs.filter("text is null")), BYTE, PIECE)) == plain_alignment(
        [(i, t) for i, t in corpus if t is None or len(t) < 2000])
    assert alignment.align(empty, BYTE, PIECE).collect() == []
    assert sum(n for row, n in want.items() if row[1]) > 100  # most rows do have tokens


def test_shared_cuts():
    r = np.random.default_rng(8)
    for _ in range(200):
        a, b = (np.unique(r.integers(1, 200, r.integers(1, 80))) for _ in range(2))
        cut = alignment.shared_cuts(a, b, np.array([0]), np.array([len(a)]))
        assert (cut == np.isin(a, b)).all()


def test_slices_join_up(spark, monkeypatch):
    rows = list(enumerate(texts(80, 6)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    whole = aligned(alignment.align(df, BYTE, PIECE))
    # More rows than a slice: texts of a megabyte each.
    long = [(1, "so it goes, on and on. " * 60_000), (2, "so it goes, on and on. " * 60_000), (3, "so it goes")]
    found = {x.doc_id: x for x in alignment.align(spark.createDataFrame(long, "doc_id bigint, text string").coalesce(1), BYTE, PIECE).collect()}
    assert found[1].groups_sha256 == found[2].groups_sha256 and found[1].count_sum > 2 * found[1].n_links
    assert whole == plain_alignment(rows)
    assert W.SLICE_BYTES < len(long[0][1])
