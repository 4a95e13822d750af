"""Vectorised pre-tokenisation with a memo of encoded pieces.

A byte-pair tokenizer first cuts a text into pieces and then merges inside each
piece, so equal pieces always give equal ids.  ``PieceEncoder`` cuts whole
batches of texts with numpy, hashes every piece, and hands only pieces that its
memo has not met to the library.  The cut rules need the class of each
character; that table is read off the library's own pre-tokenizer and
normaliser, and a text with any character outside the table (or with the string
of a special token) goes to the library whole, so results always equal the
library's.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import xxhash
from tokenizers import Tokenizer

LETTER, NUMBER, OTHER, SPACE, EDGE, UNKNOWN = range(6)
#: Characters from here on are left to the library.
TABLE_SIZE = 0x3000
#: Blocks whose characters never join a neighbour under canonical composition.
PLAIN_BLOCKS = ((0x0000, 0x0300), (0x0370, 0x0483), (0x048A, 0x0530), (0x2010, 0x2070), (0x20A0, 0x20C0))
#: Characters handled at once, entries kept in the memo, longest piece hashed by numpy.
CHUNK_CHARS = 1 << 19
MEMO_ENTRIES = 500_000
LONG_PIECE = 256
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def grown(values: np.ndarray, size: int) -> np.ndarray:
    """``values`` with room for ``size`` of them, at least doubled if there is none."""
    if size <= len(values):
        return values
    out = np.zeros(max(size, 2 * len(values)), values.dtype)
    out[:len(values)] = values
    return out


def spelled(chars: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[str]:
    """The strings chars[begin[i]:end[i]], which hold no character 0."""
    size = end - begin + 1
    stop = np.cumsum(size)
    at = np.arange(stop[-1]) + np.repeat(begin - (stop - size), size)
    taken = chars[np.minimum(at, len(chars) - 1)]
    taken[stop - 1] = 0
    return taken[:-1].tobytes().decode("utf-32-le").split("\0")


class PieceEncoder:
    """Ids (or any per-piece arrays) of whole texts, equal to ``Tokenizer.encode(..., add_special_tokens=False)``.

    ``encode_pieces(strings)`` may replace the library call for new pieces; it
    returns one list of ints per piece (the token counter returns counts).
    """

    def __init__(self, path: str, encode_pieces: Callable[[list[str]], list[list[int]]] | None = None,
                 encode_text: Callable[[str], list[int]] | None = None):
        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.specials = [t["content"] for t in spec.get("added_tokens") or []]
        kind = (spec.get("pre_tokenizer") or {}).get("type")
        self.spaced = kind == "ByteLevel"  # pieces keep the blank before them
        self.known = kind in ("ByteLevel", "Sequence")
        self.merges = self.library.model  # no cutting, no normalising
        alphabet = byte_alphabet()
        self._to_alphabet = {b: c for b, c in alphabet.items()}
        self._shown = np.array([ord(alphabet[b]) if b else 0 for b in range(256)], np.uint32)  # 0 stands between pieces
        self.encode_pieces = encode_pieces or self.library_pieces
        self.encode_text = encode_text or (lambda t: self.library.encode(t, add_special_tokens=False).ids)
        self._tables()
        rng = np.random.default_rng(20240607)
        self._value = rng.integers(1, 1 << 63, TABLE_SIZE, dtype=np.uint64)
        self._powers = np.ones(1, np.uint64), np.ones(1, np.uint64)
        self._forget()

    # -- tables read off the library ----------------------------------------
    def _tables(self) -> None:
        lower = np.arange(TABLE_SIZE, dtype=np.uint32)
        ok = np.ones(TABLE_SIZE, bool)
        if self.library.normalizer is not None:
            ok[:] = False
            for a, b in PLAIN_BLOCKS:
                for c in range(a, b):
                    n = self.library.normalizer.normalize_str(chr(c))
                    if len(n) == 1 and ord(n) < TABLE_SIZE:
                        lower[c], ok[c] = ord(n), True
        cls = np.full(TABLE_SIZE, SPACE, np.uint8)
        for mark, kind in (("!", OTHER), ("1", NUMBER), ("a", LETTER)):
            for a in range(0, TABLE_SIZE, 2048):
                probes = [f"{mark}{chr(lower[c])}{mark}" for c in range(a, a + 2048)]
                spans, at = set(), 0
                for _, span in self.library.pre_tokenizer.pre_tokenize_str("\n".join(probes)):
                    spans.add(span)
                for c in range(a, a + 2048):
                    single = (at + 1, at + 2)
                    joined = (at, at + 3) in spans
                    if kind == NUMBER and not self.spaced:
                        # digits stand alone: told from blanks by being kept, from the rest by not joining
                        joined = single in spans and cls[c] == SPACE
                    if joined:
                        cls[c] = kind
                    at += 4
        cls[~ok] = UNKNOWN
        cls[0] = EDGE
        self.cls, self.lower = cls, lower
        self.known = self.known and all(cls[ord(c)] == k for c, k in (("a", LETTER), ("é", LETTER), ("7", NUMBER),
                                                                      ("!", OTHER), ("'", OTHER), (" ", SPACE), ("\n", SPACE)))

    # -- memo -----------------------------------------------------------------
    def _forget(self) -> None:
        self._table = np.zeros(1 << 16, np.uint64)  # keys by open addressing; 0 is an empty place
        self._slot = np.zeros(1 << 16, np.int32)
        self._entries = 0
        self._start = np.zeros(1 << 16, np.int64)  # of slot i and one past the last
        self._flat = np.empty(1 << 16, np.uint32)

    def library_pieces(self, pieces: list[str]) -> list[list[int]]:
        codes = self._shown[np.frombuffer("\0".join(pieces).encode(), np.uint8)]
        shown = codes.tobytes().decode("utf-32-le").split("\0")
        if len(shown) != len(pieces):  # a piece holds the character 0
            table = str.maketrans({chr(b): c for b, c in self._to_alphabet.items()})
            shown = [p.encode().decode("latin-1").translate(table) for p in pieces]
        merged = self.merges.tokenize
        return [[t.id for t in merged(p)] for p in shown]

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Memo slot of each key, -1 if it has none."""
        out = np.full(len(keys), -1, np.int32)
        mask = len(self._table) - 1
        left, at = np.arange(len(keys)), (keys & np.uint64(mask)).astype(np.int64)
        while len(left):
            seen = self._table[at]
            hit = seen == keys[left]
            out[left[hit]] = self._slot[at[hit]]
            go = ~hit & (seen != 0)
            left, at = left[go], (at[go] + 1) & mask
        return out

    def _place(self, keys: np.ndarray, slots: np.ndarray) -> None:
        """Puts distinct new keys into the table."""
        mask = len(self._table) - 1
        left, at = np.arange(len(keys)), (keys & np.uint64(mask)).astype(np.int64)
        while len(left):
            free = self._table[at] == 0
            self._table[at[free]] = keys[left[free]]  # of several for one place, the last one gets it
            here = self._table[at] == keys[left]
            self._slot[at[here]] = slots[left[here]]
            left, at = left[~here], (at[~here] + 1) & mask

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        got = self.encode_pieces(pieces)
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        first, used = self._entries, int(self._start[self._entries])
        self._entries += len(keys)
        self._start = grown(self._start, self._entries + 1)
        self._start[first + 1:self._entries + 1] = used + np.cumsum(sizes)
        stop = int(self._start[self._entries])
        self._flat = grown(self._flat, stop)
        self._flat[used:stop] = np.fromiter(chain.from_iterable(got), np.uint32, stop - used)
        if 2 * self._entries > len(self._table):
            full = np.flatnonzero(self._table)
            old, slots = self._table[full], self._slot[full]
            size = 1 << (2 * self._entries).bit_length()
            self._table, self._slot = np.zeros(size, np.uint64), np.zeros(size, np.int32)
            self._place(old, slots)
        self._place(keys, np.arange(first, self._entries, dtype=np.int32))

    def _slots(self, keys: np.ndarray, spell: Callable[[np.ndarray], list[str]]) -> np.ndarray:
        """Memo slots of keys; spell(indices) gives the strings of new ones."""
        out = self._find(keys)
        new = np.flatnonzero(out < 0)
        if len(new):
            distinct, first = np.unique(keys[new], return_index=True)
            if self._entries and self._entries + len(distinct) > MEMO_ENTRIES:
                self._forget()
                return self._slots(keys, spell)
            self._learn(distinct, spell(new[first]))
            out[new] = self._find(keys[new])
        return out

    # -- cutting --------------------------------------------------------------
    def _cut(self, chars: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces; chars holds the texts between EDGE characters."""
        n = len(chars)
        run = np.empty(n, bool)  # first of a run of one class
        run[0] = True
        np.not_equal(cls[1:], cls[:-1], out=run[1:])
        before = np.empty(n, np.uint8)
        before[0], before[1:] = EDGE, cls[:-1]
        start = run & (cls != SPACE) & (cls != EDGE)
        if self.spaced:
            blank = chars == 32
            start[1:] &= ~blank[:-1]  # a blank goes with the run after it
            space = np.flatnonzero(run & (cls == SPACE))
            if len(space):
                ends = np.append(np.flatnonzero(run), n)
                stop = ends[np.searchsorted(ends, space, "right")]
                start[space] = True
                inner = cls[np.minimum(stop, n - 1)] != EDGE  # not at a text's end: the last one stands apart
                start[stop[inner] - 1] = True
                apart = stop[inner]
                start[apart[chars[apart - 1] != 32]] = True
        else:
            start |= cls == NUMBER
        self._contractions(chars, cls, before, start)
        begin = np.flatnonzero(start)
        if not len(begin):
            return begin, begin
        end = np.empty_like(begin)
        end[:-1], end[-1] = begin[1:], n
        # a piece ends at the next start, at an edge, or (when blanks are dropped) at a blank
        wall = (cls == EDGE) if self.spaced else (cls == EDGE) | (cls == SPACE)
        walls = np.append(np.flatnonzero(wall), n)
        return begin, np.minimum(end, walls[np.searchsorted(walls, begin)])

    def _contractions(self, chars, cls, before, start) -> None:
        """'s 't 'm 'd 're 've 'll directly after a piece are pieces of their own."""
        n = len(chars)
        mark = np.flatnonzero((chars == 39) & (before != OTHER) & start)
        mark = mark[mark + 1 < n]
        mark = mark[cls[mark + 1] == LETTER]
        if not len(mark):
            return
        one = chars[mark + 1]
        two = chars[np.minimum(mark + 2, n - 1)]
        size = np.where(np.isin(one, [ord(c) for c in "stmd"]), 1, 0)
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        size = np.where(pair & (mark + 2 < n), 2, size)
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        after = mark + 1 + size
        after = after[after < n]
        start[after[cls[after] == LETTER]] = True

    def _keys_of(self, chars, begin, end) -> np.ndarray:
        n = len(chars)
        if len(self._powers[0]) < n:
            up, down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
            up[0] = down[0] = 1
            self._powers = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        up, down = self._powers
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self._value[chars] * up[:n], out=total[1:])
        key = (total[end] - total[begin]) * down[begin]
        key ^= key >> np.uint64(32)
        key *= np.uint64(0xD6E8FEB86659FD93)
        key ^= key >> np.uint64(29)
        for i in np.flatnonzero(end - begin > LONG_PIECE):
            key[i] = xxhash.xxh3_64_intdigest(chars[begin[i]:end[i]].tobytes())
        key[key == 0] = 1  # 0 is the memo's empty place
        return key

    def _chunk(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat values and their number for each text; every character is in the table."""
        joined = "\0".join(texts) + "\0"
        chars = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        edges = np.flatnonzero(chars == 0)
        cls = self.cls[chars]
        if self.library.normalizer is not None:
            chars = self.lower[chars]
            cls = self.cls[chars]
        begin, end = self._cut(chars, cls)
        if not len(begin):
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        slot = self._slots(self._keys_of(chars, begin, end), lambda some: spelled(chars, begin[some], end[some]))
        size = self._start[slot + 1] - self._start[slot]
        stop = np.cumsum(size)
        at = np.arange(stop[-1]) + np.repeat(self._start[slot] - (stop - size), size)
        upto = np.searchsorted(begin, edges)  # pieces before each text's end
        counts = np.diff(np.concatenate([[0], stop])[upto], prepend=0)
        return self._flat[at], counts

    def _plain(self, text: str) -> bool:
        if "\0" in text or any(s in text for s in self.specials):
            return False
        if text.isascii():
            return True
        seen = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return seen.max() < TABLE_SIZE and not (self.cls[seen] == UNKNOWN).any()

    def _spans(self, text: str) -> Iterator[str]:
        """Cuts a very long text before blanks that follow a non-blank, where pieces end anyway."""
        at = 0
        while len(text) - at > CHUNK_CHARS:
            cut = at + CHUNK_CHARS
            while cut < len(text) and not (text[cut] in " \n" and not text[cut - 1].isspace()):
                cut += 1
            yield text[at:cut]
            at = cut
        yield text[at:]

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """Yields a uint32 array for each text, in order; a null text gives an empty array."""
        waiting: list[tuple[str, bool]] = []  # span, last of its text
        room, held = CHUNK_CHARS, []

        def flush():
            flat, counts = self._chunk([s for s, _ in waiting])
            bounds = np.concatenate([[0], np.cumsum(counts)])
            for k, (_, last) in enumerate(waiting):
                held.append(flat[bounds[k]:bounds[k + 1]])
                if last:
                    yield held[0] if len(held) == 1 else np.concatenate(held)
                    held.clear()
            waiting.clear()

        for text in texts:
            text = text or ""
            if not (self.known and self._plain(text)):
                if waiting:
                    yield from flush()
                yield np.array(self.encode_text(text), np.uint32)
                room = CHUNK_CHARS
                continue
            spans = list(self._spans(text)) if len(text) > CHUNK_CHARS else [text]
            for i, s in enumerate(spans):
                waiting.append((s, i == len(spans) - 1))
                room -= len(s) + 1
                if room <= 0:
                    yield from flush()
                    room = CHUNK_CHARS
        if waiting:
            yield from flush()


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """One encoder for each Python worker, so that its memo lasts across batches and tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]
