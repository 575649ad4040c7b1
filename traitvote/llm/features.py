"""Hashed n-gram features of texts, for use in tasks."""

from __future__ import annotations

import numpy as np

_A = np.uint32(2_654_435_761)
_B = np.uint32(2_246_822_519)
_C = np.uint32(3_266_489_917)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def gram_buckets(codes: np.ndarray, size: int, buckets: int, seed: int = 0) -> np.ndarray:
    """The bucket of every run of ``size`` symbols; ``buckets`` is a power of two."""
    if len(codes) < size:
        return np.empty(0, np.int64)
    h = codes[: len(codes) - size + 1] * _A + np.uint32(seed)
    for k in range(1, size):
        h = (h ^ (h >> np.uint32(15))) * _B + codes[k : len(codes) - size + 1 + k] * _C
    h ^= h >> np.uint32(16)
    h *= _A
    h ^= h >> np.uint32(13)
    return (h & np.uint32(buckets - 1)).astype(np.int64)
