"""Token ids of pieces that a worker has seen, in a hash table over numpy arrays.

The number of pieces kept is bounded: a full table is emptied, which only costs time.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

KEPT_PIECES = 1_000_000


class PieceTable:
    """Ids by the 64-bit key of a piece; a key is never zero."""

    def __init__(self, kept: int = KEPT_PIECES) -> None:
        self.kept = kept
        self._clear(1 << 16)

    def _clear(self, slots: int) -> None:
        self.keys = np.zeros(slots, np.uint64)
        self.entry = np.zeros(slots, np.int32)
        self.begin, self.length, self.n = np.zeros(1024, np.int64), np.zeros(1024, np.int32), 0
        self.ids, self.n_ids = np.zeros(4096, np.uint32), 0

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Entry number of each key, or -1."""
        mask = np.uint64(len(self.keys) - 1)
        out = np.full(len(keys), -1, np.int64)
        rest, slot = np.arange(len(keys)), keys & mask
        while len(rest):
            there = self.keys[slot]
            hit = there == keys[rest]
            out[rest[hit]] = self.entry[slot[hit]]
            go_on = ~hit & (there != 0)
            rest, slot = rest[go_on], (slot[go_on] + np.uint64(1)) & mask
        return out

    def _place(self, keys: np.ndarray, entries: np.ndarray) -> None:
        mask = np.uint64(len(self.keys) - 1)
        rest, slot = np.arange(len(keys)), keys & mask
        while len(rest):
            empty = self.keys[slot] == 0
            self.keys[slot[empty]] = keys[rest[empty]]
            mine = self.keys[slot] == keys[rest]
            self.entry[slot[mine]] = entries[rest[mine]]
            rest, slot = rest[~mine], (slot[~mine] + np.uint64(1)) & mask

    def _add(self, keys: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> None:
        while self.n + len(keys) > len(self.begin):
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.length = np.concatenate([self.length, np.zeros_like(self.length)])
        while self.n_ids + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        new = np.arange(self.n, self.n + len(keys))
        self.begin[new] = self.n_ids + np.cumsum(lengths) - lengths
        self.length[new] = lengths
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.n, self.n_ids = self.n + len(keys), self.n_ids + len(flat)
        if 2 * self.n > len(self.keys):
            old, entries = self.keys[self.keys != 0], self.entry[self.keys != 0]
            slots = len(self.keys)
            while 2 * self.n > slots:
                slots *= 2
            self.keys, self.entry = np.zeros(slots, np.uint64), np.zeros(slots, np.int32)
            self._place(old, entries)
        self._place(keys, new)

    def look_up(self, keys: np.ndarray, learn: Callable[[np.ndarray, np.ndarray], None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in order, and where each piece's ids begin (one more than pieces).

        ``learn(keys, places)`` has to add the ids of distinct unknown keys, each of which
        stands at the place given with it.
        """
        entry = self._find(keys)
        missing = np.flatnonzero(entry < 0)
        if len(missing):
            new, first = np.unique(keys[missing], return_index=True)
            at = missing[first]
            if self.n and self.n + len(new) > self.kept:
                self._clear(1 << 16)
                return self.look_up(keys, learn)
            learn(new, at)
            entry[missing] = self._find(keys[missing])
        lengths = self.length[entry].astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(lengths)])
        return self.ids[np.repeat(self.begin[entry] - upto[:-1], lengths) + np.arange(upto[-1])], upto
