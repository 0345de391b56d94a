"""Words of Arrow text columns as NumPy arrays: spans, hashes, shingles and winnowed anchors.

Texts stay one byte buffer. Hashes come from running sums of (value times power of a base), so
the hash of any run of bytes or words is a difference of two sums, whatever its length.

``Words`` is for features of models: its arithmetic wraps at 64 bits, is quick, and some runs of signs collide.
``NamedWords`` is for identity: a word is its 128-bit BLAKE2 digest, and a run of words has two residues
modulo a prime, in bases of their own, 122 bits in all. A search keyed by one of them is settled by the other.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)

#: Texts of a batch are handled in slices of about this many bytes, so that memory follows the slice.
SLICE_BYTES = 1 << 20

_powers = {BASE: np.ones(1, U64), INVERSE: np.ones(1, U64)}


def powers(base, n):
    """The first n powers of ``base``, kept between calls."""
    known = _powers[base]
    if len(known) < n:
        known = np.full(max(n, 2 * len(known)), base, U64)
        known[0] = 1
        known = np.cumprod(known)
        _powers[base] = known
    return known[:n]


def mix(x, seed=0):
    """Spread the bits of 64-bit integers (a finaliser in the manner of MurmurHash3)."""
    x = x + U64((seed * 0xD1B54A32D192ED03) % (1 << 64))
    x = (x ^ (x >> U64(33))) * U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U64(33))) * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


class Runs:
    """Hashes of runs of a sequence of 64-bit integers, for features."""

    def __init__(self, values):
        self.sums = np.zeros(len(values) + 1, U64)
        np.cumsum(values * powers(BASE, len(values)), out=self.sums[1:])

    def hashes(self, start, end, seed=0):
        """A hash of values[start:end] for each pair of bounds; equal runs have equal hashes."""
        raw = (self.sums[end] - self.sums[start]) * powers(INVERSE, len(self.sums))[start]
        return mix(raw ^ ((end - start).astype(U64) * U64(0xA0761D6478BD642F)), seed)


PRIME = (1 << 61) - 1
LOW31, LOW30 = U64((1 << 31) - 1), U64((1 << 30) - 1)
BASES = 0x1B7A4C9E2D83F56B, 0x0E5D29B7C4816FA3
_residue_powers = {b: np.ones(1, U64) for base in BASES for b in (base, pow(base, -1, PRIME))}


def residue(x):
    """x modulo the prime 2 ** 61 - 1."""
    x = (x & U64(PRIME)) + (x >> U64(61))
    return np.where(x >= PRIME, x - U64(PRIME), x)


def times(a, b):
    """Product of residues: 2 ** 62 counts as 2 and 2 ** 61 as 1."""
    au, ad, bu, bd = a >> U64(31), a & LOW31, b >> U64(31), b & LOW31
    middle = ad * bu + au * bd
    return residue(au * bu * U64(2) + (middle >> U64(30)) + ((middle & LOW30) << U64(31)) + ad * bd)


def residue_powers(base, n):
    """The first n powers of ``base``, kept between calls."""
    known = _residue_powers[base]
    while len(known) < n:
        known = np.append(known, times(known, U64(pow(base, len(known), PRIME))))
        _residue_powers[base] = known
    return known[:n]


class Residues:
    """Hashes of runs of a sequence of integers, by a polynomial modulo a prime; ``lane`` chooses its base."""

    def __init__(self, values, lane):
        self.inverse = pow(BASES[lane], -1, PRIME)
        terms = times(residue(values), residue_powers(BASES[lane], len(values)))
        # Sums of the halves do not overflow; 31 bits to the left is a turn of the 61 bits.
        high, low = residue(np.cumsum(terms >> U64(31), dtype=U64)), residue(np.cumsum(terms & LOW31, dtype=U64))
        self.sums = np.zeros(len(values) + 1, U64)
        self.sums[1:] = residue(((high << U64(31)) & U64(PRIME)) + (high >> U64(30)) + low)

    def hashes(self, start, end, seed=0):
        """A hash of values[start:end] for each pair of bounds."""
        raw = times(residue(self.sums[end] + U64(PRIME) - self.sums[start]), residue_powers(self.inverse, len(self.sums))[start])
        return mix(raw ^ ((end - start).astype(U64) * U64(0xA0761D6478BD642F)), seed)


def byte_table(separators, lower=False):
    """Two tables over byte values: its kind (0: between words; a change of kind ends a word), and its value in hashes."""
    inside = np.ones(256, np.int8)
    inside[list(separators)] = 0
    values = BYTE_VALUES.copy()
    if lower:
        values[65:91] = values[97:123]
    return inside, values


SPACES = [9, 10, 11, 12, 13, 32]
#: Words between white space, as they are or with A-Z lower-cased.
PLAIN = byte_table(SPACES)
LOWER = byte_table(SPACES, lower=True)
#: Words of digits, letters and everything beyond ASCII, A-Z lower-cased.
ALNUM = byte_table([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)], lower=True)
#: Runs of letters and digits, and runs of signs, as words of their own.
SIGNED = ALNUM[0] + 2 * (PLAIN[0] - ALNUM[0]), ALNUM[1]


def buffers(column):
    """Bytes and row offsets of a string column; null rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, at, data = column.buffers()
    at = np.frombuffer(at, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and len(column) else np.zeros(0, np.uint8)
    return data, at - at[0]


def slices(batch, text):
    """Slices of a batch of about SLICE_BYTES of text; a longer text is a slice of its own."""
    if not batch.num_rows:
        return
    _, at = buffers(batch.column(text))
    block = (at[1:] - 1) // SLICE_BYTES
    cuts = np.flatnonzero(np.diff(block)) + 1
    for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(low, high - low)


class Spans:
    """Where the words of a slice of texts lie.

    start, end: byte bounds in ``data``; at: byte bounds of the rows; row: of each word; first: index of
    each row's first word, with the total as last entry.
    """

    def __init__(self, column, table):
        inside = table[0]
        self.data, at = buffers(column)
        self.at, self.rows = at, len(at) - 1
        kind = inside[self.data]
        begins, ends = kind > 0, kind > 0
        begins[1:] &= kind[1:] != kind[:-1]
        heads = at[:-1][at[:-1] < len(kind)]
        begins[heads] = kind[heads] > 0
        ends[:-1] &= kind[1:] != kind[:-1]
        tails = at[1:][at[1:] > 0] - 1
        ends[tails] = kind[tails] > 0
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, at)
        self.row = np.repeat(np.arange(self.rows), np.diff(self.first))

    def __len__(self):
        return len(self.start)

    @property
    def counts(self):
        return np.diff(self.first)


    def windows(self, size):
        """First words of all runs of ``size`` words that lie in one row."""
        if len(self) < size:
            return np.zeros(0, np.int64)
        return np.flatnonzero(self.row[size - 1:] == self.row[:len(self) - size + 1])


class Words(Spans):
    """The words of a slice of texts with hashes for features. hash: of each word; runs: hashes of runs of words."""

    def __init__(self, column, table):
        super().__init__(column, table)
        self.values = table[1]
        self.hash = Runs(self.values[self.data]).hashes(self.start, self.end)
        self.runs = Runs(self.hash)


class NamedWords(Spans):
    """The words of a slice of texts with two independent hashes of their runs, ``lanes``."""

    def __init__(self, column, table):
        super().__init__(column, table)
        data = self.data
        if table[1][65] == table[1][97]:  # A-Z count as small letters
            data = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
        size = self.end - self.start
        to = np.append(0, np.cumsum(size))
        inside = np.arange(to[-1]) + np.repeat(self.start - to[:-1], size)
        names = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(to), pa.py_buffer(data[inside])])
        names = pc.dictionary_encode(names)
        digests = b"".join([hashlib.blake2b(w, digest_size=16).digest() for w in names.dictionary.to_pylist()])
        own = np.frombuffer(digests, U64).reshape(-1, 2)[names.indices.to_numpy()]
        self.lanes = Residues(own[:, 0], 0), Residues(own[:, 1], 1)

    def hashes(self, start, end, lane=0):
        return self.lanes[lane].hashes(start, end)

    def sequences(self, lane=0):
        """A hash of each row's whole sequence of words."""
        return self.hashes(self.first[:-1], self.first[1:], lane)

    def anchors(self, size):
        """Winnowing: of each window of ``size`` words, the leftmost least hash of its k-grams.

        k is about half of the window. Returns the first words of the windows, the first word of
        each one's anchor, and the anchors' hashes. A window's anchor depends on its words alone, so
        equal windows have equal anchors at the same place.
        """
        k = (size + 1) // 2
        width = size - k + 1
        at = self.windows(size)
        if not len(at):
            return at, at, np.zeros(0, U64)
        low = np.arange(len(self) - k + 1)
        grams = self.hashes(low, low + k)
        best = np.lib.stride_tricks.sliding_window_view(grams, width)[at].argmin(axis=1) if len(at) < len(grams) // 8 \
            else np.lib.stride_tricks.sliding_window_view(grams, width).argmin(axis=1)[at]
        anchor = at + best
        return at, anchor, grams[anchor]


def signed(x):
    return x.view(np.int64) if x.dtype == U64 else x.astype(np.int64)


def shingle_sets(words, size):
    """Of each row the sorted distinct shingle hashes of one lane, and the other lane's hashes of the same shingles.

    A shorter row's words are one shingle, no words none.
    """
    at = words.windows(size)
    first, second = words.hashes(at, at + size, 0), words.hashes(at, at + size, 1)
    bounds = np.searchsorted(words.row[at], np.arange(words.rows + 1)) if len(at) else np.zeros(words.rows + 1, int)
    short = words.sequences(0), words.sequences(1)
    counts = words.counts
    for row in range(words.rows):
        if counts[row] >= size:
            own = slice(bounds[row], bounds[row + 1])
            order = np.argsort(first[own], kind="stable")
            values = first[own][order]
            fresh = np.append(True, values[1:] != values[:-1])
            yield values[fresh], second[own][order[fresh]]
        else:
            yield tuple(s[row:row + 1] if counts[row] else s[:0] for s in short)


def set_hash(values, seed):
    """A hash of a set of 64-bit integers, as a signed integer."""
    with np.errstate(over="ignore"):
        total = mix(values, seed).sum(dtype=U64) + U64(len(values))
        return int(mix(np.array([total], U64), seed + 1).view(np.int64)[0])
