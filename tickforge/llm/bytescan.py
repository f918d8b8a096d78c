"""Words of UTF-8 text as 64-bit hashes, by array operations over whole batches.

A word is a maximal run of bytes of a class; the class must hold either all or
none of the bytes from 0x80 on, so that words never split a character.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 20
_U = np.uint64


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x ^= x >> _U(33)
    x *= _U(0xC4CEB9FE1A85EC53)
    x ^= x >> _U(33)
    return x


class WordHasher:
    """Hashes the words of each row after lower-casing A-Z.

    The hash is a polynomial over the word's bytes, taken from running sums:
    (sum to the end - sum to the start) * base^-start.
    """

    def __init__(self, word_byte: np.ndarray, seed: int = 7):
        rng = np.random.default_rng(seed)
        fold = np.arange(256)
        fold[65:91] += 32
        self.word_byte = word_byte.astype(bool)
        self.value = rng.integers(1, 1 << 63, 256, dtype=np.uint64)[fold]
        self.base = _U(0x9E3779B97F4A7C15)
        self.inverse = _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        self._power = self._unpower = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._power) < n + 1:
            self._power = np.full(n + 1, self.base, np.uint64)
            self._unpower = np.full(n + 1, self.inverse, np.uint64)
            self._power[0] = self._unpower[0] = 1
            np.multiply.accumulate(self._power, out=self._power)
            np.multiply.accumulate(self._unpower, out=self._unpower)

    def _cuts(self, data: np.ndarray):
        """Ends of pieces of about PIECE bytes, none inside a word."""
        at, n = 0, len(data)
        while at < n:
            end = min(n, at + PIECE)
            while end < n:
                gap = np.flatnonzero(~self.word_byte[data[end : end + 4096]])
                if len(gap):
                    end += int(gap[0])
                    break
                end = min(n, end + 4096)
            yield at, end
            at = end

    def __call__(self, data: np.ndarray, offsets: np.ndarray):
        """(hash of each word, index of each row's first word and one end)."""
        lo, hi = int(offsets[0]), int(offsets[-1])
        data = data[lo:hi]
        rel = offsets - lo
        edges = rel[1:-1]
        hashes, starts_at = [], []
        for a, b in self._cuts(data):
            part = data[a:b]
            inside = self.word_byte[part]
            first = inside.copy()
            first[1:] &= ~inside[:-1]
            last = inside.copy()
            last[:-1] &= ~inside[1:]
            cut = edges[(edges > a) & (edges < b)] - a  # a row's first byte, inside this piece
            first[cut] = inside[cut]
            last[cut - 1] = inside[cut - 1]
            s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
            self._grow(len(part))
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(self.value[part] * self._power[: len(part)], out=total[1:])
            hashes.append(mix64((total[e] - total[s]) * self._unpower[s] + (e - s).astype(np.uint64)))
            starts_at.append(s + a)
        words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        where = np.concatenate(starts_at) if starts_at else np.zeros(0, np.int64)
        return words, np.searchsorted(where, rel, "left")

    def one(self, word: str) -> int:
        raw = np.frombuffer(word.encode(), np.uint8)
        got, _ = self(raw, np.array([0, len(raw)], np.int64))
        if len(got) != 1:
            raise ValueError(f"not one word: {word!r}")
        return int(got[0])


def class_of(inside) -> np.ndarray:
    return np.array([bool(inside(b)) for b in range(256)])


#: Digits, letters and everything beyond ASCII.
ALNUM = class_of(lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128)
#: All but ASCII white space.
NON_SPACE = class_of(lambda b: not (b == 32 or 9 <= b <= 13))
