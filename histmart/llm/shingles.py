"""Word hashes, word shingles and MinHash signatures of single texts (helpers inside tasks)."""

from __future__ import annotations

import numpy as np

_CACHE_WORDS = 100_000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)  # Fixed value: 2^64 / golden ratio, odd.


class _Hashes(dict):
    """The hash of every word asked for."""

    def __init__(self):
        import xxhash
        super().__init__()
        self._hash = xxhash.xxh64_intdigest

    def __missing__(self, word: bytes) -> int:
        h = self[word] = self._hash(word)
        return h


class WordHasher:
    """64-bit hashes of whitespace-separated words, with a bounded cache."""

    def __init__(self):
        self._seen = _Hashes()

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").split()
        if len(self._seen) > _CACHE_WORDS:
            self._seen.clear()
        return np.fromiter(map(self._seen.__getitem__, words), dtype=np.uint64, count=len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words; a shorter text has one, of all its words."""
    n = len(hashes)
    if n == 0:
        return hashes
    k = min(k, n)
    out = hashes[:n - k + 1].copy()
    for i in range(1, k):
        out = out * _MULTIPLIER + hashes[i:n - k + 1 + i]
    return mixed(out + np.uint64(k))


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    return np.unique(windows(hashes, k))


class MinHasher:
    """``count`` MinHash values of 32 bits."""

    def __init__(self, count: int, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, count, dtype=np.uint64)

    def __call__(self, shingles: np.ndarray) -> np.ndarray:
        best = np.full(len(self.a), np.iinfo(np.uint64).max, dtype=np.uint64)
        for at in range(0, len(shingles), 2048):
            best = np.minimum(best, (self.a[:, None] * shingles[None, at:at + 2048] + self.b[:, None]).min(axis=1))
        return (best >> np.uint64(32)).astype("<u4")
