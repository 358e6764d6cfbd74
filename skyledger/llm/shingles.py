"""Word shingles of a text and their HyperMinHash registers."""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

WORDS = 5
BANDS, ROWS = 32, 5
REGISTERS = BANDS * ROWS
#: A register has 6 bits for leading zeros and these for the bits after the first one.
MANTISSA_BITS = 10
#: Word hashes a worker remembers.
REMEMBERED = 200_000
_CHUNK = 2048
_PRIME = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_SEEDS = _mixed(np.arange(1, REGISTERS + 1, dtype=np.uint64))
_FACTORS = _mixed(np.arange(1001, REGISTERS + 1001, dtype=np.uint64)) | np.uint64(1)


class Shingler:
    """Shingle sets of texts as sorted 64-bit hashes."""

    def __init__(self):
        self._known: dict[bytes, int] = {}

    def words(self, text: str) -> np.ndarray:
        """Hashes of the words; A-Z in lower case, cut at ASCII white space."""
        words = text.encode().lower().split()
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        for w in set(words).difference(known):
            known[w] = int.from_bytes(blake2b(w, digest_size=8).digest(), "little")
        return np.array([known[w] for w in words], dtype=np.uint64)

    def shingles(self, text: str) -> np.ndarray:
        words = self.words(text)
        size = min(WORDS, len(words))
        if not size:
            return words
        h = np.full(len(words) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            h = h * np.uint64(_PRIME) + words[i : len(words) - size + 1 + i]
        return np.unique(_mixed(h))


def registers(shingles: np.ndarray) -> np.ndarray:
    """One 16-bit register per bucket: the leading zeros of the least hash and its next bits.

    Every bucket has a hash function of its own, so a short text fills them all.
    """
    least = np.full(REGISTERS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), _CHUNK):
        part = shingles[at : at + _CHUNK]
        hashed = (part[None, :] ^ _SEEDS[:, None]) * _FACTORS[:, None]
        least = np.minimum(least, hashed.min(axis=1))
    _, exponent = np.frexp(least.astype(np.float64))
    zeros = np.clip(64 - exponent, 0, 63).astype(np.uint64)
    rest = (least << zeros) << np.uint64(1)
    return ((zeros << np.uint64(MANTISSA_BITS)) | (rest >> np.uint64(64 - MANTISSA_BITS))).astype("<u2")


def bands(found: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of registers."""
    rows = found.reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = key * np.uint64(_PRIME) + rows[:, i]
    return _mixed(key).view(np.int64)


def chance_collision(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How often registers of disjoint sets of these sizes agree.

    The least of n uniform hashes has density n exp(-n x). A register's value stands
    for an interval that is about x ln 2 / 2^MANTISSA_BITS wide at x, so two registers
    agree with the integral of the product of both densities times that width.
    """
    n, m = np.asarray(n, dtype=float), np.asarray(m, dtype=float)
    return np.log(2) / (1 << MANTISSA_BITS) * n * m / np.maximum(n + m, 1) ** 2


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity from rows of registers, corrected for chance collisions."""
    agree = (a == b).mean(axis=1)
    chance = chance_collision(n, m)
    return (agree - chance) / (1 - chance)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union of two sorted sets."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    return len(a) > 0 and 100 * common >= percent * (len(a) + len(b) - common)
