"""A cuckoo filter over NumPy arrays: insert, look up and delete many keys at once."""

from __future__ import annotations

import numpy as np

SLOTS = 4
ROUNDS = 500


def buckets_for(keys: int) -> int:
    """A power of two at which at most about 80 % of the slots are taken."""
    return 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS * 0.8)))))


def _grouped(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that puts equal values together, and each one's place among its equals."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]] if len(ordered) else np.zeros(0, bool)
    first = np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))
    return order, np.arange(len(ordered)) - first


class CuckooFilter:
    """Buckets of four 16-bit fingerprints; 0 is a free slot.

    Keys are pairs of 64-bit hashes: the first picks the bucket, the second the fingerprint.
    A key is inserted once; deleting a key that was never inserted is the caller's mistake.
    """

    def __init__(self, buckets: int, table: bytes | None = None) -> None:
        self.mask = np.uint64(buckets - 1)
        self.table = (np.zeros((buckets, SLOTS), np.uint16) if table is None
                      else np.frombuffer(table, np.uint16).reshape(buckets, SLOTS).copy())

    @classmethod
    def of(cls, k1: np.ndarray, k2: np.ndarray) -> CuckooFilter:
        """A filter of the keys, large enough for them."""
        buckets = buckets_for(len(k1))
        while True:
            made = cls(buckets)
            if made.insert(k1, k2):
                return made
            buckets *= 2

    def _marks(self, k2: np.ndarray) -> np.ndarray:
        return (k2.astype(np.uint64) % np.uint64(65535) + np.uint64(1)).astype(np.uint16)

    def _other(self, bucket: np.ndarray, mark: np.ndarray) -> np.ndarray:
        return (bucket ^ (mark.astype(np.uint64) * np.uint64(0x5BD1E995))) & self.mask

    def _homes(self, k1: np.ndarray, k2: np.ndarray):
        mark = self._marks(k2)
        bucket = k1.astype(np.uint64) & self.mask
        return mark, bucket, self._other(bucket, mark)

    def contains(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        mark, one, two = self._homes(k1, k2)
        return ((self.table[one] == mark[:, None]).any(1)
                | (self.table[two] == mark[:, None]).any(1))

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> bool:
        """Place all keys; False (and an unusable filter) if they do not fit."""
        mark, bucket, other = self._homes(k1, k2)
        for turn in range(ROUNDS):
            if not len(mark):
                return True
            order, place = _grouped(bucket)
            mark, bucket, other = mark[order], bucket[order], other[order]
            taken = self.table[bucket] != 0
            fits = place < SLOTS - taken.sum(1)
            slot = np.argsort(taken, axis=1, kind="stable")[np.arange(len(mark)),
                                                            np.minimum(place, SLOTS - 1)]
            self.table[bucket[fits], slot[fits]] = mark[fits]
            mark, bucket, other = mark[~fits], bucket[~fits], other[~fits]
            if turn == 0:  # those left over first try their second bucket
                bucket, other = other, bucket
                continue
            # One of those left over in each bucket throws a fingerprint out of it.
            first = np.r_[True, bucket[1:] != bucket[:-1]] if len(bucket) else np.zeros(0, bool)
            at = (bucket[first] + np.uint64(turn)) % np.uint64(SLOTS)
            thrown = self.table[bucket[first], at].copy()
            self.table[bucket[first], at] = mark[first]
            home = bucket[first]
            mark[first] = thrown
            bucket[first], other[first] = self._other(home, thrown), home
            empty = mark == 0
            mark, bucket, other = mark[~empty], bucket[~empty], other[~empty]
        return False

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        """Free one slot for each key."""
        mark, one, two = self._homes(k1, k2)
        while len(mark):
            pair = (np.minimum(one, two) << np.uint64(16)) | mark.astype(np.uint64)
            order, place = _grouped(pair)
            now = order[place == 0]
            for bucket in (one, two):
                here = self.table[bucket[now]] == mark[now][:, None]
                found = here.any(1)
                self.table[bucket[now][found], here[found].argmax(1)] = 0
                now = now[~found]
            rest = order[place > 0]
            mark, one, two = mark[rest], one[rest], two[rest]
