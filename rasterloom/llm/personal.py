"""Personal data: fixed patterns, and a character BiLSTM with CRF transitions trained on what they find."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from rasterloom.llm import words as W
from rasterloom.llm.tables import schema

KINDS = ("email", "ip", "card", "phone")
#: Windows of WINDOW characters start every STEP; each character is owned by the window it lies in the middle of.
WINDOW, STEP = 96, 48
MARGIN = (WINDOW - STEP) // 2
#: Code points below 128 are themselves; then other letters and digits, anything else, and padding.
ALPHABET = 131
#: Labelled windows used for fitting, and documents looked through for them.
TRAIN_WINDOWS, TRAIN_DOCUMENTS = 2000, 8000
OUTSIDE = 0
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind

# No span of any kind is without one of these.
TRIGGER = np.zeros(256, bool)
TRIGGER[[*b"0123456789@"]] = True

_EMAIL_TAIL = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A digit run that fails from its first digit fails from any other, so only first digits are tried.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _emails(text):
    """An address is found at its @: the word characters before it, the domain behind it."""
    last = 0
    for tail in _EMAIL_TAIL.finditer(text):
        at = low = tail.start()
        while low > last and (text[low - 1] in "._%+-" or text[low - 1].isascii() and text[low - 1].isalnum()):
            low -= 1
        if low < at:
            yield low, tail.end()
            last = tail.end()


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text):
    """(start, kind, end) of the fixed patterns, in code points, by start and then kind."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def codes(text):
    """Symbols of a text."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
    wide = np.flatnonzero(points >= 128)
    points[wide] = [128 if text[i].isalnum() else 129 for i in wide.tolist()]
    return points


def windows(symbols):
    """Numbers and symbols of the windows that hold a trigger; window k owns characters k STEP up to (k + 1) STEP."""
    spots = np.flatnonzero(TRIGGER[np.minimum(symbols, 128)])
    k = np.unique(np.concatenate([(spots + MARGIN) // STEP, (spots - MARGIN) // STEP, spots // STEP])) if len(spots) else spots
    k = k[(k >= 0) & (k * STEP < len(symbols))]
    padded = np.pad(symbols, (MARGIN, WINDOW), constant_values=130)
    return k, padded[k[:, None] * STEP + np.arange(WINDOW)]


def tagged(n, spans):
    """Tags of n characters. Where kinds overlap the earlier-listed wins."""
    tags = np.zeros(n, np.int64)
    for start, kind, end in sorted(spans, key=lambda s: -s[1]):
        tags[start] = 1 + 2 * kind
        tags[start + 1:end] = 2 + 2 * kind
    return tags


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


class Tagger:
    """A bidirectional LSTM over characters whose outputs are the emissions of a linear-chain CRF.

    Both directions run side by side: direction 1 reads the window backwards. Gates are stacked as
    input, forget, output, candidate.
    """

    def __init__(self, embed=12, hidden=16, seed=5):
        r = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {
            "embed": r.normal(0, 0.3, (ALPHABET, embed)), "wx": r.normal(0, embed ** -0.5, (2, embed, 4 * hidden)), "wh": r.normal(0, hidden ** -0.5, (2, hidden, 4 * hidden)),
            "b": np.zeros((2, 1, 4 * hidden)), "out": r.normal(0, hidden ** -0.5, (2 * hidden, TAGS)), "bias": np.zeros(TAGS), "move": np.zeros((TAGS, TAGS)), "first": np.zeros(TAGS)}
        self.p["b"][:, :, hidden:2 * hidden] = 1.0
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def emissions(self, symbols, keep=False):
        """(time, batch, tag) scores of windows (batch, time)."""
        p, h, (n, time) = self.p, self.hidden, symbols.shape
        both = np.stack([symbols.T, symbols.T[::-1]])  # direction, time, batch
        x = p["embed"][both]
        z = (x.reshape(2, time * n, -1) @ p["wx"] + p["b"]).reshape(2, time, n, 4 * h)
        state, cell = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        states, gates, cells = np.zeros((2, time, n, h), np.float32), [], []
        for t in range(time):
            g = z[:, t] + state @ p["wh"]
            s, c = _sigmoid(g[:, :, :3 * h]), np.tanh(g[:, :, 3 * h:])
            old = cell
            cell = s[:, :, h:2 * h] * cell + s[:, :, :h] * c
            bent = np.tanh(cell)
            if keep:
                gates.append((s, c, bent))
                cells.append((old, state))
            state = s[:, :, 2 * h:] * bent
            states[:, t] = state
        joined = np.concatenate([states[0], states[1][::-1]], axis=2)
        scores = joined @ p["out"] + p["bias"]
        return (scores, (both, x, joined, gates, cells)) if keep else scores

    def decode(self, symbols):
        """Best tags of windows, by Viterbi."""
        scores = self.emissions(symbols)
        best, back = self.p["first"] + scores[0], []
        for s in scores[1:]:
            step = best[:, :, None] + self.p["move"]
            back.append(step.argmax(axis=1))
            best = step.max(axis=1) + s
        tags = [best.argmax(axis=1)]
        rows = np.arange(len(symbols))
        for b in reversed(back):
            tags.append(b[rows, tags[-1]])
        return np.stack(tags[::-1], axis=1)

    def gradients(self, symbols, tags):
        """Negative log-likelihood of the tags, and its gradients."""
        p, h, (n, time) = self.p, self.hidden, symbols.shape
        scores, (both, x, joined, gates, cells) = self.emissions(symbols, keep=True)
        scores, move = scores.astype(np.float64), p["move"].astype(np.float64)
        tags = tags.T

        def total(v, axis):
            top = v.max(axis=axis, keepdims=True)
            return np.log(np.exp(v - top).sum(axis=axis)) + top.squeeze(axis)

        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[0] = p["first"] + scores[0]
        for t in range(1, time):
            ahead[t] = total(ahead[t - 1][:, :, None] + move, 1) + scores[t]
        for t in range(time - 2, -1, -1):
            behind[t] = total(move + (scores[t + 1] + behind[t + 1])[:, None, :], 2)
        whole = total(ahead[-1], 1)
        rows = np.arange(n)
        gold = p["first"][tags[0]] + scores[np.arange(time)[:, None], rows, tags].sum(axis=0) + move[tags[:-1], tags[1:]].sum(axis=0)
        d = np.exp(ahead + behind - whole[:, None])
        pairs = np.exp(ahead[:-1][:, :, :, None] + move + (scores[1:] + behind[1:])[:, :, None, :] - whole[:, None, None]).sum(axis=(0, 1))
        np.add.at(pairs, (tags[:-1], tags[1:]), -1)
        d[np.arange(time)[:, None], rows, tags] -= 1
        d = (d / n).astype(np.float32)
        grad = {"move": pairs / n, "first": d[0].sum(axis=0), "bias": d.sum(axis=(0, 1)), "out": np.tensordot(joined, d, ((0, 1), (0, 1)))}
        up = d @ p["out"].T
        up = np.stack([up[:, :, :h], up[::-1, :, h:]])
        dz = np.zeros((2, time, n, 4 * h), np.float32)
        ds, dc = np.zeros((2, n, h), np.float32), np.zeros((2, n, h), np.float32)
        grad["wh"] = np.zeros_like(p["wh"])
        back = p["wh"].transpose(0, 2, 1)
        for t in range(time - 1, -1, -1):
            (s, c, bent), (old, state) = gates[t], cells[t]
            i, f, o = s[:, :, :h], s[:, :, h:2 * h], s[:, :, 2 * h:]
            ds = ds + up[:, t]
            dc = dc + ds * o * (1 - bent * bent)
            g = dz[:, t]
            g[:, :, :h] = dc * c * i * (1 - i)
            g[:, :, h:2 * h] = dc * old * f * (1 - f)
            g[:, :, 2 * h:3 * h] = ds * bent * o * (1 - o)
            g[:, :, 3 * h:] = dc * i * (1 - c * c)
            grad["wh"] += state.transpose(0, 2, 1) @ g
            ds, dc = g @ back, dc * f
        flat = dz.reshape(2, time * n, -1)
        grad["b"] = flat.sum(axis=1, keepdims=True)
        grad["wx"] = x.reshape(2, time * n, -1).transpose(0, 2, 1) @ flat
        dx = flat @ p["wx"].transpose(0, 2, 1)
        grad["embed"] = np.zeros_like(p["embed"])
        np.add.at(grad["embed"], both.reshape(-1), dx.reshape(-1, dx.shape[2]))
        return float((whole - gold).mean()), grad

    def fit(self, symbols, tags, passes=6, size=64, rate=0.01):
        """Adam over shuffled batches."""
        r = np.random.default_rng(9)
        m, v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        step = 0
        for _ in range(passes):
            order = r.permutation(len(symbols))
            for low in range(0, len(order), size):
                at = order[low:low + size]
                _, grad = self.gradients(symbols[at], tags[at])
                norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                step += 1
                for k, g in grad.items():
                    g = (g * min(1.0, 5.0 / (norm + 1e-9))).astype(np.float32)
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] -= rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        return self


def reconciled(tags, n, numbers):
    """Spans of one text from the tags of its windows.

    Each character takes its tag from the window that owns it, where both sides of it were seen. Runs of
    one kind are spans, across windows too; a begin tag inside a run of its kind starts a new span.
    """
    line = np.zeros(n, np.int64)
    for k, t in zip(numbers.tolist(), tags):
        own = t[MARGIN:MARGIN + STEP][:n - k * STEP]
        line[k * STEP:k * STEP + len(own)] = own
    kind = (line + 1) // 2
    begins = (kind > 0) & ((np.append(0, kind[:-1]) != kind) | (line % 2 == 1))
    ends = (kind > 0) & ((np.append(kind[1:], 0) != kind) | np.append(begins[1:], True))
    return [(int(a), int(kind[a]) - 1, int(b) + 1) for a, b in zip(np.flatnonzero(begins), np.flatnonzero(ends))]


def plausible(text, span):
    """A model's span must be whole (not cut from a longer word) and hold enough digits, or an @ for an address."""
    start, kind, end = span
    own = text[start:end]
    whole = not (start and text[start - 1].isalnum()) and not (end < len(text) and text[end].isalnum())
    least = (0, 4, 12, 7)[kind]
    return whole and sum(c in "0123456789" for c in own) >= least and (kind != 0 or "@" in own[1:-1])


def _texts(part):
    """Row and text of rows that hold a trigger."""
    data, at = W.buffers(part.column("text"))
    sums = np.append(0, np.cumsum(TRIGGER[data]))[at]
    for row in np.flatnonzero(np.diff(sums)).tolist():
        yield row, data[at[row]:at[row + 1]].tobytes().decode()


def _labelled(batches):
    for batch in batches:
        for part in W.slices(batch, "text"):
            marks, symbols, tags = [], [], []
            for row, text in _texts(part):
                k, s = windows(codes(text))
                line = np.pad(tagged(len(text), base_spans(text)), (MARGIN, WINDOW))
                symbols += [x.astype(np.uint8).tobytes() for x in s]
                tags += [x.astype(np.uint8).tobytes() for x in line[k[:, None] * STEP + np.arange(WINDOW)]]
                marks += [int.from_bytes(hashlib.sha256(x).digest()[:7], "big") for x in symbols[len(marks):]]
            yield pa.RecordBatch.from_arrays([pa.array(marks, pa.int64()), pa.array(symbols, pa.binary()), pa.array(tags, pa.binary())], ["mark", "symbols", "tags"])


SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def mask(text, spans):
    """A text with each span (start, kind, end, base) replaced by its kind in brackets; spans are sorted.

    Overlapping spans are masked as one, by the first one's kind. In time linear in the text and its spans.
    """
    parts, at = [], 0
    for start, kind, end, _ in spans:
        if start >= at:
            parts += [text[at:start], "[", KINDS[kind].upper(), "]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _find(model, keep):
    keeps_text = "text" in keep

    def run(batches):
        tagger = model.value
        for batch in batches:
            for part in W.slices(batch, "text"):
                spans, texts, numbers, parts = [[] for _ in range(part.num_rows)], [], [], []
                for row, text in _texts(part):
                    spans[row] = [(*s, True) for s in base_spans(text)]
                    if tagger:
                        k, s = windows(codes(text))
                        texts.append((row, text))
                        numbers.append(k)
                        parts.append(s)
                if texts:
                    symbols = np.concatenate(parts)
                    tags = np.concatenate([tagger.decode(symbols[i:i + 2048]) for i in range(0, len(symbols), 2048)])
                    at = 0
                    for (row, text), k in zip(texts, numbers):
                        base = sorted(spans[row])
                        starts, reach = [a for a, *_ in base], list(accumulate((b for _, _, b, _ in base), max))
                        for span in reconciled(tags[at:at + len(k)], len(text), k):
                            before = bisect_left(starts, span[2])  # base spans that begin before this one ends
                            if plausible(text, span) and not (before and reach[before - 1] > span[0]):
                                spans[row].append((*span, False))
                        spans[row].sort()
                        at += len(k)
                rows = [[{"kind": KINDS[k], "start": a, "end": b, "base": c} for a, k, b, c in s] for s in spans]
                more = []
                if keeps_text:  # masked here, as a second pass in Python would hold a second worker's memory
                    clean = [None] * part.num_rows
                    for row in (i for i, s in enumerate(spans) if s):
                        clean[row] = mask(part.column("text")[row].as_py(), spans[row])
                    more = [pa.array(clean, pa.string())]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in keep), pa.array(rows, SPAN), *more], [*keep, "spans", *(["_masked"] if more else [])])
    return run


def find_personal_data(docs, keep=("doc_id",)):
    """Personal data in each whole text: spans of struct(kind, start, end, base), in code points.

    ``docs``: doc_id, text and the columns to ``keep``; others are ignored. Base spans are those of the fixed patterns, with
    their checks. A tagger is trained on windows of about TRAIN_DOCUMENTS documents (chosen by a hash
    of doc_id), at most TRAIN_WINDOWS of them, labelled with the base spans. It reads every window of
    every text that holds a digit or an @, as spans of all kinds do; what it finds beside the base
    spans is added where it is whole and plausible. Overlapping windows are decoded and each character
    takes the tag of the window it is in the middle of; runs are then read over the whole text.

    Null and empty texts have no spans; repeated rows get equal spans; without training windows there
    are base spans only. Returns the kept columns and spans and, where text is kept, ``_masked``: the text
    without them, null where it has none.
    """
    share = min(1.0, TRAIN_DOCUMENTS / max(1, docs.count()))
    chosen = docs.select("doc_id", "text").filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < int(share * 1_000_003) + 1)
    made = chosen.mapInArrow(_labelled, "mark bigint, symbols binary, tags binary").distinct().orderBy("mark", "tags").limit(TRAIN_WINDOWS).collect()
    tagger = None
    if made:
        read = lambda i: np.stack([np.frombuffer(r[i], np.uint8) for r in made]).astype(np.int64)
        tagger = Tagger().fit(read(1), read(2))
    model = docs.sparkSession.sparkContext.broadcast(tagger)
    return docs.select(*dict.fromkeys([*keep, "text"])).mapInArrow(
        _find(model, keep), schema(docs, keep, "spans array<struct<kind:string,start:int,end:int,base:boolean>>" + (", _masked string" if "text" in keep else "")))


def masked(found):
    """The text of a ``find_personal_data`` result that keeps it, with each span replaced by its kind in brackets (see ``mask``)."""
    return found.withColumn("text", F.coalesce("_masked", "text")).drop("_masked")
