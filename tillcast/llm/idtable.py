"""A bounded table from 64-bit hashes of short texts to their token ids, in flat arrays.

One entry costs some 30 bytes and its ids, a third of what a dictionary of strings takes. When the table is full, the
entries that were asked for again since the last time stay, if they are half of it at most; else it is emptied.
"""

from __future__ import annotations

import numpy as np


def gathered(ids: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs ids[begin:begin + length] end to end."""
    total = np.cumsum(length)
    return ids[np.repeat(begin - total + length, length) + np.arange(total[-1] if len(total) else 0)]


class IdTable:
    def __init__(self, most: int, most_ids: int) -> None:
        self.most, self.most_ids = most, most_ids
        self.empty()

    def empty(self) -> None:
        self.hashes, self.slots = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # hashes ascend
        self.begin, self.length, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint32)
        self.used = np.zeros(0, bool)  # since the last time that the table was full

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(known, begin, length) of distinct ascending hashes; runs of ``ids``."""
        at = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), dtype=bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == hashes[inside]
        begin, length = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        slot = self.slots[at[known]]
        begin[known], length[known] = self.begin[slot], self.length[slot]
        self.used[slot] = True
        return known, begin, length

    def keep(self, hashes: np.ndarray, ids: np.ndarray, begin: np.ndarray, length: np.ndarray) -> None:
        """Add new hashes (ascending) with runs of ``ids``."""
        if len(self.hashes) + len(hashes) > self.most or len(self.ids) > self.most_ids:
            self._thin_out()
        slots = (len(self.begin) + np.arange(len(length))).astype(np.int32)
        self.begin, self.length = np.r_[self.begin, len(self.ids) + np.cumsum(length) - length], np.r_[self.length, length.astype(np.int32)]
        self.ids = np.concatenate([self.ids, gathered(ids, begin, length)])
        self.used = np.r_[self.used, np.zeros(len(length), bool)]
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.slots = np.insert(self.hashes, at, hashes), np.insert(self.slots, at, slots)

    def _thin_out(self) -> None:
        stay = self.used[self.slots]
        slots = self.slots[stay]
        begin, length = self.begin[slots], self.length[slots]
        if 2 * len(slots) > self.most or 2 * int(length.sum()) > self.most_ids:
            return self.empty()
        self.ids = gathered(self.ids, begin, length)
        self.hashes, self.slots = self.hashes[stay], np.arange(len(slots), dtype=np.int32)
        self.begin, self.length, self.used = np.cumsum(length, dtype=np.int64) - length, length, np.zeros(len(slots), bool)
