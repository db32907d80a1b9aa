"""Texts cut into pieces between which no pre-token reaches, and a table of the pieces' ids, in arrays.

A cut is made before ASCII white space that follows anything else, and before ASCII punctuation that follows a letter. (Letters and
white space beyond ASCII are told by their bytes only where these leave no doubt: C3 80 to C3 BF; elsewhere there is no cut.)

Pieces of up to 16 bytes are kept in an open-addressing table whose key is the piece itself, as two 64-bit numbers and its length,
so a found entry is the piece and not just its hash. The table is bounded; a full one takes no more, and is emptied when most of a
batch is missing from it.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from ._util import mix

KEPT = 400_000
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_GRAPH = np.zeros(256, bool)
_GRAPH[33:127] = True


def cuts(buf: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where pieces start: at each text's start (starts) and at the cuts within."""
    before = buf[:-1]
    latin = np.zeros(len(before), bool)  # the second byte of a character from U+00C0 to U+00FF
    latin[1:] = (buf[:-2] == 0xC3) & (before[1:] >= 0x80)
    at = _SPACE[buf[1:]] & (_GRAPH[before] | latin)
    latin &= (before != 0x97) & (before != 0xB7)  # not the signs of multiplication and division
    at |= _PUNCT[buf[1:]] & (_LETTER[before] | latin)
    first = np.zeros(len(buf) + 1, bool)
    first[1:-1] = at
    first[starts] = True
    return np.flatnonzero(first[:-1])


class PieceTable:
    """Ids of texts, by way of a function that takes pieces and their sizes in bytes and gives ids in a row, with where each piece's begin and how many they are."""

    def __init__(self, ids_of: Callable[[list[str], np.ndarray], tuple[np.ndarray, np.ndarray, np.ndarray]], kept: int = KEPT) -> None:
        self.ids_of, self.kept = ids_of, kept
        self.bits = int(2.5 * kept).bit_length()
        self._clear()

    def _clear(self) -> None:
        n = 1 << self.bits
        self.low, self.high, self.size = np.zeros(n, np.uint64), np.zeros(n, np.uint64), np.zeros(n, np.uint8)
        self.at, self.n = np.zeros(n, np.int64), np.zeros(n, np.int32)
        self.used, self.pool, self.filled = 0, np.zeros(1 << 16, np.uint32), 0

    def _slot(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            h = mix(low * np.uint64(0x9E3779B97F4A7C15) + mix(high + size.astype(np.uint64)))
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The slot of each piece, or -1."""
        slot = self._slot(low, high, size)
        left = np.flatnonzero((self.low[slot] != low) | (self.high[slot] != high) | (self.size[slot] != size))
        while len(left):
            gone = self.size[slot[left]] == 0
            slot[left[gone]] = -1
            left = left[~gone]
            slot[left] = slot[left] + 1 & (1 << self.bits) - 1
            s = slot[left]
            left = left[(self.low[s] != low[left]) | (self.high[s] != high[left]) | (self.size[s] != size[left])]
        return slot

    def _insert(self, low: np.ndarray, high: np.ndarray, size: np.ndarray, at: np.ndarray, n: np.ndarray) -> None:
        """Enter distinct pieces that aren't there."""
        slot, left = self._slot(low, high, size), np.arange(len(low))
        while len(left):
            free = left[self.size[slot[left]] == 0]
            _, first = np.unique(slot[free], return_index=True)
            put = free[first]
            s = slot[put]
            self.low[s], self.high[s], self.size[s], self.at[s], self.n[s] = low[put], high[put], size[put], at[put], n[put]
            rest = np.ones(len(low), bool)
            rest[put] = False
            left = left[rest[left]]
            slot[left] = slot[left] + 1 & (1 << self.bits) - 1
        self.used += len(low)

    def _append(self, ids: np.ndarray) -> int:
        """Put ids at the end of the pool; where they begin."""
        if self.filled + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.filled], np.zeros(max(len(ids), len(self.pool)), np.uint32)])
        at = self.filled
        self.pool[at : at + len(ids)] = ids
        self.filled += len(ids)
        return at

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of each UTF-8 text."""
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths)
        raw = b"".join(texts)
        if not raw:
            return [np.zeros(0, np.uint32) for _ in texts]
        buf = np.frombuffer(raw + bytes(16), np.uint8)
        starts = cuts(buf[: len(raw)], (ends - lengths)[lengths > 0])
        size = np.diff(np.append(starts, len(raw)))
        words = np.ndarray(len(raw) + 8, "<u8", raw + bytes(16), 0, (1,))
        keep = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
        low, high = words[starts] & keep[np.minimum(size, 8)], words[starts + np.minimum(size, 8)] & keep[np.clip(size - 8, 0, 8)]
        short = np.minimum(size, 255).astype(np.uint8)
        slot = self._find(low, high, short)
        slot[size > 16] = -1
        missing = np.flatnonzero(slot < 0)
        if self.used >= self.kept and 3 * len(missing) > len(starts):  # texts of another sort than those before
            self._clear()
            slot[:] = -1
            missing = np.arange(len(starts))
        at, n = self.at[slot], self.n[slot].astype(np.int64)
        base = self.filled
        if len(missing):
            tops = starts[missing] + size[missing]
            strings = [raw[a:b] for a, b in zip(starts[missing].tolist(), tops.tolist(), strict=True)]
            number = {s: i for i, s in enumerate(dict.fromkeys(strings))}
            which = np.fromiter(map(number.__getitem__, strings), np.int64, len(strings))
            made, begin, counts = self.ids_of([s.decode("utf-8", "replace") for s in number], np.fromiter(map(len, number), np.int64, len(number)))
            begin = begin + self._append(made)
            at[missing], n[missing] = begin[which], counts[which]
            first = np.full(len(number), -1, np.int64)
            first[which[::-1]] = missing[::-1]
            first = first[size[first] <= 16]
            if self.used < self.kept:
                self._insert(low[first], high[first], short[first], at[first], n[first])
                base = self.filled
        total = np.cumsum(n)
        ids = self.pool[np.repeat(at - total + n, n) + np.arange(int(total[-1]))]
        self.filled = base if self.used else 0
        tail = np.append(0, total)[np.searchsorted(starts, ends)]
        return np.split(ids, tail[:-1])
