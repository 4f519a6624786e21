"""Hashes of all stretches of a sequence of symbols, from sums over its prefixes.

Arithmetic is modulo primes, one for each lane, so that no fixed sequence (such as Thue and
Morse's) defeats it. Two lanes make a 62-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import lru_cache

import numpy as np
import xxhash

#: The four largest primes below 2**31, and a base for each.
PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)
BASES = (911382323, 972663749, 1472838311, 1890561077)
#: Distinct words that a Python worker remembers; beyond, its memory starts anew.
MEMORY_WORDS = 1_000_000


@lru_cache(maxsize=16)
def _powers(base: int, prime: int, bits: int) -> np.ndarray:
    """base**0, base**1, ... modulo the prime, 2**bits of them."""
    out, p = np.ones(1 << bits, np.uint64), np.uint64(prime)
    for bit in range(bits):
        half = 1 << bit
        out[half:2 * half] = out[:half] * np.uint64(pow(base, half, prime)) % p
    return out.astype(np.uint32)


class Prefix:
    """Prefix sums of symbol x base**place, by lane."""

    def __init__(self, symbols: np.ndarray, lanes: int = 2) -> None:
        symbols, bits = symbols.astype(np.uint64), max(1, int(len(symbols)).bit_length())
        self.powers, self.inverse, self.sums = [], [], []
        for prime, base in zip(PRIMES[:lanes], BASES, strict=False):
            p = np.uint64(prime)
            self.powers.append(_powers(base, prime, bits))
            self.inverse.append(_powers(pow(base, -1, prime), prime, bits))
            sums = np.zeros(len(symbols) + 1, np.uint64)
            np.cumsum((symbols % np.uint64(prime - 1) + np.uint64(1))
                      * self.powers[-1][:len(symbols)] % p, out=sums[1:])
            self.sums.append((sums % p).astype(np.uint32))

    def _sum(self, lane: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        p = np.uint64(PRIMES[lane])
        return (self.sums[lane][ends] + p - self.sums[lane][starts]) % p  # 64 bits through p

    def pair(self, lane: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """62-bit hashes of the stretches [start, end) from two lanes; equal stretches agree."""
        halves = [self._sum(at, starts, ends) * self.inverse[at][starts] % np.uint64(PRIMES[at])
                  for at in (lane, lane + 1)]
        return ((halves[0] << np.uint64(31)) | halves[1]).astype(np.int64)

    def repeats(self, starts: np.ndarray, sizes: np.ndarray, shifts: np.ndarray) -> np.ndarray:
        """Whether [start, start + size) and the stretch ``shift`` further on look the same."""
        out = np.ones(len(starts), bool)
        for lane in range(len(self.sums)):
            near = self._sum(lane, starts, starts + sizes)
            far = self._sum(lane, starts + shifts, starts + shifts + sizes)
            out &= near * self.powers[lane][shifts] % np.uint64(PRIMES[lane]) == far
        return out


class WordHashes(dict):
    """64-bit hashes of words (UTF-8), remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: Iterable[bytes], count: int) -> np.ndarray:
        if len(self) > MEMORY_WORDS:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, count)
