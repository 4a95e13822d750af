"""Hashed word-shingle sets of whole texts, a batch at a time in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

#: Bytes handled at once (arrays of 8 bytes for each of them are held), and the longest word hashed by numpy.
CHUNK_BYTES = 1 << 18
LONG_WORD = 256
_BASE = 0x9E3779B97F4A7C15 | 1
_M1, _M2 = np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _M1
    x = (x ^ (x >> np.uint64(29))) * _M2
    return x ^ (x >> np.uint64(32))


class Shingler:
    """Sorted distinct 64-bit hashes of the ``width``-word shingles of each text; A-Z lower-cased.

    Words are runs of bytes other than blank and tab to carriage return.  A text
    with fewer words is one shingle, a text without words none.
    """

    def __init__(self, width: int = 4):
        self.width = width
        self._value = np.random.default_rng(77).integers(1, 1 << 63, 256, dtype=np.uint64)
        self._gap = np.zeros(256, bool)
        self._gap[[32, *range(9, 14)]] = True
        self._powers = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def word_hashes(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of every word."""
        raw = np.frombuffer(data, np.uint8)
        n = len(raw)
        edge = np.diff(np.concatenate([[True], self._gap[raw], [True]]).astype(np.int8))
        begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if len(self._powers[0]) < n:
            up, down = np.full(n, _BASE, np.uint64), np.full(n, pow(_BASE, -1, 1 << 64), np.uint64)
            up[0] = down[0] = 1
            self._powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self._value[raw] * self._powers[0][:n], out=total[1:])
        key = (total[end] - total[begin]) * self._powers[1][begin]
        for i in np.flatnonzero(end - begin > LONG_WORD):
            key[i] = xxhash.xxh3_64_intdigest(data[begin[i]:end[i]])
        return begin, _mixed(key + (end - begin).astype(np.uint64))

    def _joined(self, words: np.ndarray, width: int) -> np.ndarray:
        out = words[:len(words) - width + 1]
        for k in range(1, width):
            out = _mixed(out * _M2 + words[k:len(words) - width + 1 + k])
        return out

    def _chunk(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        begin, words = self.word_hashes(b" ".join(texts))
        stops = np.cumsum([len(t) + 1 for t in texts])
        upto = np.searchsorted(begin, stops)
        every = self._joined(words, self.width) if len(words) >= self.width else words[:0]
        a = 0
        for b in upto.tolist():
            if b - a >= self.width:
                yield np.unique(every[a:b - self.width + 1].view(np.int64))
            elif b > a:
                yield self._joined(words[a:b], b - a).view(np.int64)
            else:
                yield np.empty(0, np.int64)
            a = b

    def sets(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """An int64 array for each text, in order."""
        waiting, size = [], 0
        for t in texts:
            raw = (t or "").encode().lower()  # bytes: only A-Z change
            waiting.append(raw)
            size += len(raw)
            if size >= CHUNK_BYTES:
                yield from self._chunk(waiting)
                waiting, size = [], 0
        if waiting:
            yield from self._chunk(waiting)


def signature(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set as two signed longs."""
    digest = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), ">i8")
    return int(digest[0]), int(digest[1])
