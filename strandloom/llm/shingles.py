"""Hashed words and shingles of a text, in numpy; used inside Spark tasks."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

#: Words whose hashes a worker remembers.
MEMO = 200_000
_M = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > MEMO:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_list(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of UTF-8 bytes, A-Z lower-cased."""
    return (text or b"").lower().split()


def hash_words(ws: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_HASHES.__getitem__, ws), np.uint64, len(ws))


def windows(h: np.ndarray, k: int) -> np.ndarray:
    """A hash for every window of ``k`` neighbours; fewer than ``k`` make one window; none make none."""
    n = len(h)
    if n == 0:
        return h
    width = min(k, n)
    out = h[: n - width + 1].copy()
    for j in range(1, width):
        out = out * _M + h[j : n - width + 1 + j]
    return mix(out + np.uint64(width))


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes of a text."""
    return np.unique(windows(hash_words(word_list(text)), k))


def set_key(shingles: np.ndarray) -> bytes:
    """128 bits that name a set of shingles."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
