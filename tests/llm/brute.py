"""Plain Python versions of the operators."""

import hashlib
import re
from collections import Counter, defaultdict

PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def contamination(docs, items, size=10):
    """(n_words, n_hit, item ids) of each text."""
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall(lower(text))
        n = min(size, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            windows[tuple(words[i:i + n])].add("" if item is None else str(item))
    out = []
    for text in docs:
        words, hit, found = ALNUM.findall(lower(text)), set(), set()
        for n in {len(w) for w in windows}:
            for i in range(len(words) - n + 1):
                if tuple(words[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(words[i:i + n])]
        out.append((len(words), len(hit), sorted(found)))
    return out


def repeated(docs, size=35):
    """(n_words, n_removed, hash of what is kept) of each text."""
    words = [PLAIN.findall(t or "") for t in docs]
    seen = Counter(tuple(w[i:i + size]) for w in words for i in range(len(w) - size + 1))
    out = []
    for w in words:
        gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i:i + size])] > 1 for j in range(i, i + size)}
        out.append((len(w), len(gone), sha(" ".join(x for i, x in enumerate(w) if i not in gone))))
    return out


def groups(docs, shingle, num, den):
    """(n_shingles, first position of the group) of each text."""
    sets = []
    for t in docs:
        w = PLAIN.findall(lower(t))
        sets.append({tuple(w[i:i + shingle]) for i in range(len(w) - shingle + 1)} if len(w) >= shingle else {tuple(w)} if w else set())
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and den * both >= num * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return [(len(s), find(i)) for i, s in enumerate(sets)]


def luhn(digits):
    values = [int(d) for d in digits]
    for i in range(len(values) - 2, -1, -2):
        values[i] = sum(divmod(2 * values[i], 10))
    return sum(values) % 10 == 0


def personal(text):
    """(start, kind, end) of the fixed patterns."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)
