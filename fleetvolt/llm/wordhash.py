"""Words and word shingles of whole texts as 64-bit numbers, computed with numpy over the bytes
of an Arrow batch.

A word is a run of bytes that the caller's table does not call separators. Bytes of UTF-8
sequences are never separators of a text unless the table says so, so the cut is the same as on
code points. The number of a word is a polynomial over random 64-bit values of its bytes (mod
2**64) that is then mixed; the number of a shingle is a polynomial over the numbers of its words.
Two different words or shingles get one number with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
PIECE_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15            # odd, so it has an inverse mod 2**64
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the 64-bit finalizer of MurmurHash3)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def byte_values(fold_case: bool = True) -> np.ndarray:
    """A random 64-bit value per byte; with ``fold_case`` A-Z share the values of a-z."""
    values = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    if fold_case:
        values[65:91] = values[97:123]
    return values


def separators(extra: bytes = b"") -> np.ndarray:
    """Table of the bytes that end a word: ASCII white space and the bytes of ``extra``."""
    table = np.zeros(256, bool)
    table[list(SPACES) + list(extra)] = True
    return table


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a column in a row, and where each text begins and ends.
    A null counts as the empty text."""
    col = pc.fill_null(column.cast(pa.large_binary()), b"")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    ends = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    body = col.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[ends[0]:ends[-1]], ends - ends[0]


def _pieces(data: np.ndarray, ends: np.ndarray, sep: np.ndarray, size: int = PIECE_BYTES):
    """Spans of about ``size`` bytes that end after a separator or a text, so no word is cut."""
    at, n = 0, len(data)
    while at < n:
        to = min(at + size, n)
        while to < n:
            cut = max(int(ends[np.searchsorted(ends, to, "right") - 1]), at)
            back = np.flatnonzero(sep[data[max(cut, at):to]])
            if len(back):
                cut = max(cut, at) + int(back[-1]) + 1
            if cut > at:
                to = cut
                break
            to = min(to + size, n)
        yield at, to
        at = to


class WordHasher:
    """Numbers of the words of texts, in order, and how many words each text has."""

    def __init__(self, sep: np.ndarray | None = None, fold_case: bool = True):
        self.sep = separators() if sep is None else sep
        self.values = byte_values(fold_case)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, PIECE_BYTES + 1)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                p = np.full(size, base, np.uint64)
                p[0] = 1
                setattr(self, name, np.cumprod(p, dtype=np.uint64))

    def words(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(numbers of all words, index of each text's first word with the total at the end)."""
        data, ends = text_bytes(column)
        numbers, begins = [], []
        for a, b in _pieces(data, ends, self.sep):
            part = data[a:b]
            n = len(part)
            self._powers(n + 1)
            inside = ~self.sep[part]
            first = np.zeros(n + 1, bool)       # a text begins here
            cuts = ends[(ends >= a) & (ends <= b)] - a
            first[cuts] = True
            first[0] = first[n] = True
            before = np.empty(n, bool)
            before[0] = False
            before[1:] = inside[:-1]
            start = np.flatnonzero(inside & (~before | first[:-1]))
            after = np.empty(n, bool)
            after[-1] = False
            after[:-1] = inside[1:]
            end = np.flatnonzero(inside & (~after | first[1:])) + 1
            if not len(start):
                continue
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(self.values[part] * self.up[:n], out=sums[1:])
            numbers.append(mix((sums[end] - sums[start]) * self.down[start]))
            begins.append(start + a)
        if not numbers:
            return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
        return np.concatenate(numbers), np.searchsorted(np.concatenate(begins), ends)


def shingles(words: np.ndarray, at: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the ``size``-word shingles of each text, in order, repeats included. A text of
    fewer words has its whole sequence as its only shingle; one without words has none."""
    counts = np.diff(at)
    many = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    out_at = np.concatenate([[0], np.cumsum(many)]).astype(np.int64)
    if not out_at[-1]:
        return np.zeros(0, np.uint64), out_at
    text = np.repeat(np.arange(len(counts)), many)
    begin = at[:-1][text] + (np.arange(out_at[-1]) - out_at[:-1][text])
    length = np.minimum(counts[text], size)
    number = np.zeros(len(begin), np.uint64)
    for k in range(size):
        have = length > k
        term = np.where(have, words[np.minimum(begin + k, len(words) - 1)], np.uint64(k + 1))
        number = number * _STEP + term
    return mix(number + length.astype(np.uint64)), out_at
