"""Sets of word shingles as sorted 64-bit hashes, and their MinHash signatures."""

from __future__ import annotations

import hashlib

import numpy as np

from ledgerspark.llm.common import mix64

WORDS = 5
BASE = 0x9E3779B97F4A7C15  # odd, so powers can be undone modulo 2**64
_rng = np.random.default_rng(20_011)
_BYTES = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]  # A-Z count as a-z
_PLACE = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = [np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to ``n`` of the base and of its inverse, modulo 2**64."""
    if len(_powers[0]) <= n:
        size = max(1 << 16, 2 * n)
        for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0], _powers[1]


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word, A-Z as a-z; words are what lies between spaces and the controls 9 to 13."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    if not len(data):
        return np.empty(0, dtype=np.uint64)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = (data != 32) & ((data < 9) | (data > 13))
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    powers, inverse = _powers_to(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTES[data] * powers[: len(data)], out=sums[1:])
    return mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def shingle_set(text: str) -> np.ndarray:
    """Sorted distinct hashes of the runs of five words; of fewer words, one of the whole sequence."""
    words = word_hashes(text)
    if not len(words):
        return words
    run = min(WORDS, len(words))
    total = np.full(len(words) - run + 1, run, dtype=np.uint64)
    for i in range(run):
        total += words[i : len(words) - run + 1 + i] * _PLACE[i]
    return np.unique(mix64(total))


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """The least value of the set under each of ``size`` hash functions, as 32-bit numbers."""
    rng = np.random.default_rng(20_012)
    factors = rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    offsets = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    least = np.full(size, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        block = np.multiply.outer(shingles[at : at + 2048], factors)
        block += offsets
        np.minimum(least, block.min(axis=0), out=least)
    return (mix64(least) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
