"""Token ids of texts by way of their distinct pieces, which are told apart by their bytes."""

from __future__ import annotations

import os
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rasterloom.llm import words as W

#: Pieces that a worker remembers; beyond, it starts afresh, which costs some time and no result. Frequent pieces are soon known again.
LIMIT = 1 << 18


def gather(at, size):
    """Indexes of stretches laid end to end: ``size[i]`` numbers from ``at[i]`` on, for each i; and the stretches' bounds."""
    to = np.append(0, np.cumsum(size))
    return np.arange(to[-1]) + np.repeat(at - to[:-1], size), to


class PieceIds:
    """Ids of pieces of text. Each distinct piece is encoded once and then looked up by its string."""

    def __init__(self, encode, limit=LIMIT):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self):
        self.known, self.used = {}, 0
        self.ids, self.bounds = np.zeros(1 << 16, np.uint32), np.zeros(1 << 16, np.int64)

    @staticmethod
    def _room(array, n):
        return array if n <= len(array) else np.append(array, np.zeros(max(n - len(array), len(array)), array.dtype))

    def of(self, data, start, end):
        """Ids of the pieces data[start:end] end to end, and the bounds of each piece's ids. Pieces are valid UTF-8."""
        size = end - start
        index, to = gather(start, size)
        whole = len(index) == len(data) and (not len(start) or start[0] == 0)
        strings = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(to.astype(np.int64)), pa.py_buffer(data if whole else data[index]))
        strings = pc.dictionary_encode(strings)
        names = strings.dictionary.to_pylist()
        if len(self.known) >= self.limit:
            self.clear()
        number = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(number < 0)
        if len(new):
            fresh = [names[i] for i in new.tolist()]
            ids = self.encode(fresh)
            size = np.fromiter(map(len, ids), np.int64, len(ids))
            number[new] = np.arange(len(self.known), len(self.known) + len(new))
            self.known.update(zip(fresh, number[new].tolist()))
            self.ids = self._room(self.ids, self.used + int(size.sum()))
            self.bounds = self._room(self.bounds, len(self.known) + 1)
            self.bounds[number[new] + 1] = self.used + np.cumsum(size)
            self.ids[self.used:self.used + int(size.sum())] = np.fromiter(chain.from_iterable(ids), np.uint32, int(size.sum()))
            self.used += int(size.sum())
        number = number[strings.indices.to_numpy()]
        index, to = gather(self.bounds[number], self.bounds[number + 1] - self.bounds[number])
        return self.ids[index], to


def load(path):
    """A tokenizer file; strings of special tokens in a text are ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def encoder(tokenizer):
    return lambda strings: [x.ids for x in tokenizer.encode_batch_fast(strings, add_special_tokens=False)]


#: Kinds of bytes in such a text: space, letter, digit, sign; next to an apostrophe or beyond ASCII (4) nothing is cut.
KINDS = np.full(256, 4, np.int8)
KINDS[:128] = [0 if i in W.SPACES else 2 if chr(i).isdigit() else 1 if chr(i).isalpha() else 3 for i in range(128)]
KINDS[ord("'")] = 4


def cuts(data):
    """Bytes at which a run of ASCII letters, digits or signs begins right behind one of another kind."""
    kind = KINDS[data]
    return 1 + np.flatnonzero((kind[1:] != kind[:-1]) & (kind[1:] % 4 > 0) & (kind[:-1] % 4 > 0))


class SpacedTokens:
    """Ids by a tokenizer that drops white space and case and keeps letters, digits and signs apart.

    A text's ids are those of its runs of letters, digits or signs, one after the other, so each distinct run is
    encoded once. Runs that touch an apostrophe or characters beyond ASCII stay together, as what
    they become depends on their neighbours.
    """

    def __init__(self, path, limit=LIMIT):
        encode = encoder(load(path))
        one = ["ab cd", "Ab\t\nCD", "ab,.1cd", "12 3a", "it's, don't!", "!'s", "e \u0301."]
        many = [["ab", "cd"], ["ab", "cd"], ["ab", ",.", "1", "cd"], ["12", "3", "a"], ["it's", ",", "don't", "!"], ["!'s"], ["e", "\u0301."]]
        if any(whole != [i for part in encode(parts) for i in part] for whole, parts in zip(encode(one), many)):
            raise ValueError(f"{path} does not cut texts into runs of letters, digits and signs")
        self.pieces = PieceIds(encode, limit)

    def encode(self, column):
        """Token ids of all rows of a text column, end to end, and the bounds of the rows."""
        words = W.Spans(column, W.PLAIN)
        data, inner = words.data, cuts(words.data)
        begins, ends = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        begins[words.start] = begins[inner] = ends[words.end] = ends[inner] = True
        # A capital before a mark beyond ASCII may combine with it in another way than its small letter.
        capital = (data >= 65) & (data <= 90)
        capital[:-1] &= data[1:] < 128
        start = np.flatnonzero(begins)
        ids, to = self.pieces.of(np.where(capital, data + np.uint8(32), data), start, np.flatnonzero(ends))
        return ids, to[np.searchsorted(start, words.at)]


_made = {}


def cached(kind, *path):
    """One tokenizer of each file in a Python worker."""
    key = (kind, *path)
    if key not in _made:
        _made[key] = kind(*path)
    return _made[key]
