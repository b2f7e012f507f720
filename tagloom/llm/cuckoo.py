"""A cuckoo filter over 16-byte digests: buckets of four 16-bit fingerprints, with deletion."""

import numpy as np

SLOTS = 4
MAX_LOAD = 0.84
MAX_KICKS = 500


class CuckooFull(Exception):
    """No place was found; build a filter with more buckets from the exact table."""


def split_digests(digests) -> tuple[np.ndarray, np.ndarray]:
    """Hash and non-zero fingerprint of each digest."""
    words = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return words[:, 0], (words[:, 1] % np.uint64(65535) + np.uint64(1)).astype(np.uint16)


class CuckooFilter:
    def __init__(self, buckets: int, data: bytes | None = None):
        assert buckets & (buckets - 1) == 0, "the number of buckets is a power of two"
        self.buckets = buckets
        self.slots = (np.frombuffer(data, dtype=np.uint16).copy() if data
                      else np.zeros(buckets * SLOTS, dtype=np.uint16)).reshape(buckets, SLOTS)

    @classmethod
    def sized_for(cls, items: int) -> "CuckooFilter":
        need = max(1, int(items / (SLOTS * MAX_LOAD)) + 1)
        return cls(1 << (need - 1).bit_length())

    @classmethod
    def build(cls, digests) -> "CuckooFilter":
        """A filter of these distinct digests; larger if they do not fit the usual size."""
        made = cls.sized_for(len(digests))
        while True:
            try:
                return made.add(digests)
            except CuckooFull:
                made = cls(made.buckets * 2)

    def _places(self, hashes: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(self.buckets - 1)
        first = hashes & mask
        return first, first ^ self._offset(marks)

    def _offset(self, marks):
        mixed = marks.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(32)) & np.uint64(self.buckets - 1)

    def add(self, digests) -> "CuckooFilter":
        """Insert each digest once more; on ``CuckooFull`` the filter must be thrown away."""
        if not len(digests):
            return self
        hashes, marks = split_digests(digests)
        for a, b, mark in zip(*[x.tolist() for x in (*self._places(hashes, marks), marks)],
                              strict=True):
            self._place(a, b, mark)
        return self

    def _place(self, first: int, second: int, mark: int) -> None:
        for at in (first, second):
            row = self.slots[at]
            for slot in range(SLOTS):
                if row[slot] == 0:
                    row[slot] = mark
                    return
        at = second
        for kick in range(MAX_KICKS):
            slot = (at + kick) % SLOTS
            mark, self.slots[at, slot] = int(self.slots[at, slot]), mark
            at ^= int(self._offset(np.array([mark]))[0])
            free = np.flatnonzero(self.slots[at] == 0)
            if len(free):
                self.slots[at, free[0]] = mark
                return
        raise CuckooFull

    def remove(self, digests) -> "CuckooFilter":
        """Delete digests that were inserted before."""
        if not len(digests):
            return self
        hashes, marks = split_digests(digests)
        for a, b, mark in zip(*[x.tolist() for x in (*self._places(hashes, marks), marks)],
                              strict=True):
            for at in (a, b):
                found = np.flatnonzero(self.slots[at] == mark)
                if len(found):
                    self.slots[at, found[0]] = 0
                    break
            else:
                raise KeyError("a digest was deleted that the filter does not hold")
        return self

    def may_hold(self, digests) -> np.ndarray:
        """True for every digest held, and for about one other in 8,000."""
        hashes, marks = split_digests(digests)
        first, second = self._places(hashes, marks)
        wanted = marks[:, None]
        return ((self.slots[first.astype(np.int64)] == wanted).any(axis=1)
                | (self.slots[second.astype(np.int64)] == wanted).any(axis=1))

    def to_bytes(self) -> bytes:
        return self.slots.tobytes()
