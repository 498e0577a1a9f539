"""A cuckoo filter over 128-bit keys that counts up to a few equal entries.

Every entry is a 16-bit mark in one of two buckets of four slots; the second bucket follows
from the first and the mark alone, so entries move between the two without their keys. A key
may be entered several times, up to eight marks in its two buckets; what finds no slot goes to
a stash of whole keys, so that an added entry is never lost and ``count`` never falls short.
"""

from __future__ import annotations

import numpy as np

SLOTS = 4
KICKS = 200  # rounds of moving entries before the rest is stashed
_MIX = np.uint64(0x9E3779B97F4A7C15)


class CuckooFilter:
    """Keys are given as (n, 2) arrays of 64-bit words."""

    def __init__(self, buckets: int) -> None:
        if buckets < 1 or buckets & (buckets - 1):
            raise ValueError("the number of buckets must be a power of two")
        self.slots = np.zeros((buckets, SLOTS), np.uint16)
        self.stash = np.empty((0, 2), np.uint64)

    @classmethod
    def sized(cls, entries: int) -> CuckooFilter:
        """Room for ``entries`` with at least a third of the slots left free."""
        return cls(1 << max(3 * entries // (2 * SLOTS), 1).bit_length())

    @classmethod
    def read(cls, slots: bytes, stash: bytes) -> CuckooFilter:
        found = cls(len(slots) // (2 * SLOTS))
        found.slots = np.frombuffer(slots, np.uint16).reshape(-1, SLOTS).copy()
        found.stash = np.frombuffer(stash, np.uint64).reshape(-1, 2)
        return found

    def written(self) -> tuple[bytes, bytes]:
        return self.slots.tobytes(), self.stash.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.slots) - 1)
        marks = (keys[:, 1] % np.uint64(65535)).astype(np.uint16) + np.uint16(1)
        return marks, (keys[:, 0] & mask).astype(np.int64)

    def _other(self, marks: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        mixed = (marks.astype(np.uint64) * _MIX) >> np.uint64(40)
        return bucket ^ (mixed & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _place(self, marks: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Fill free slots of the wanted buckets; which entries found none."""
        order = np.argsort(bucket, kind="stable")
        wanted = bucket[order]
        rank = np.arange(len(wanted)) - np.searchsorted(wanted, wanted)
        free = self.slots[wanted] == 0
        fits = rank < free.sum(axis=1)
        # the slot of the entry's rank among the bucket's free ones
        at = (free.cumsum(axis=1) == (rank + 1)[:, None]).argmax(axis=1)
        self.slots[wanted[fits], at[fits]] = marks[order][fits]
        left = np.ones(len(marks), bool)
        left[order[fits]] = False
        return left

    def add(self, keys: np.ndarray) -> None:
        keys = np.ascontiguousarray(keys, np.uint64)
        marks, bucket = self._places(keys)
        left = self._place(marks, bucket)
        marks, bucket, keys = marks[left], bucket[left], keys[left]
        bucket = self._other(marks, bucket)
        left = self._place(marks, bucket)
        marks, bucket, keys = marks[left], bucket[left], keys[left]
        # an entry that is moved on has lost its key, so a chain of moves is undone if it fails
        for mark, at, key in zip(marks, bucket, keys):
            if not self._move(mark, int(at)):
                self.stash = np.vstack([self.stash, key[None, :]])

    def _move(self, mark: np.uint16, at: int) -> bool:
        """Put a mark into a full bucket by moving others to their second bucket."""
        moved = []
        for turn in range(KICKS):
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = mark
                return True
            slot = (turn + at) % SLOTS
            moved.append((at, slot, self.slots[at, slot]))
            mark, self.slots[at, slot] = self.slots[at, slot], mark
            at = int(self._other(np.array([mark]), np.array([at]))[0])
        for at, slot, mark in reversed(moved):
            self.slots[at, slot] = mark
        return False

    def remove(self, keys: np.ndarray) -> None:
        """Take out one entry per given key; only keys that were added may be given."""
        keys = np.ascontiguousarray(keys, np.uint64)
        marks, one = self._places(keys)
        for key, mark, a, b in zip(keys, marks, one, self._other(marks, one)):
            stashed = np.flatnonzero((self.stash == key).all(axis=1))
            if len(stashed):
                self.stash = np.delete(self.stash, stashed[0], axis=0)
                continue
            for bucket in (a, b):
                at = np.flatnonzero(self.slots[bucket] == mark)
                if len(at):
                    self.slots[bucket, at[0]] = 0
                    break

    def count(self, keys: np.ndarray) -> np.ndarray:
        """How often each key may have been entered: never too low, seldom too high."""
        keys = np.ascontiguousarray(keys, np.uint64)
        marks, one = self._places(keys)
        two = self._other(marks, one)
        found = (self.slots[one] == marks[:, None]).sum(axis=1)
        found += np.where(one != two, (self.slots[two] == marks[:, None]).sum(axis=1), 0)
        for key in self.stash:
            found += (keys == key).all(axis=1)
        return found
