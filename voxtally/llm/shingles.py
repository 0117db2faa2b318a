"""Word shingles of a text as sorted 64-bit hashes, and SuperMinHash signatures over them."""

from __future__ import annotations

import hashlib

import numpy as np
from xxhash import xxh64_intdigest

WIDTH = 5
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_RANK_BITS = np.uint64(40)
_MAX_SIZE = 1024
_STEPS = np.arange(1, _MAX_SIZE + 2, dtype=np.uint64) * _MULTIPLIER
_FLOORS = np.arange(_MAX_SIZE + 2, dtype=np.uint64) << _RANK_BITS


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that close inputs give unrelated outputs (splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space, A-Z in lower case; nothing for null."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_hashes(words: list[bytes], width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of all runs of `width` words.

    A text of fewer words is one shingle of all its words; a text without words has none.
    """
    n = len(words)
    if n == 0:
        return np.empty(0, np.uint64)
    if n < width:
        return np.array([xxh64_intdigest(b" ".join(words), seed=n)], np.uint64)
    hashed = np.fromiter(map(xxh64_intdigest, words), np.uint64, n)
    out = hashed[: n - width + 1].copy()
    for i in range(1, width):
        out *= _MULTIPLIER
        out += hashed[i : n - width + 1 + i]
    return np.unique(mix(out))


def set_digest(hashes: np.ndarray) -> bytes:
    """16 bytes that are equal for equal sets."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def super_minhash(hashes: np.ndarray, size: int) -> np.ndarray:
    """SuperMinHash of a set; `size` is at most 1024.

    Every element walks its own random permutation of the `size` components; at step j it offers
    j plus a random fraction to the component it reaches. A component keeps the least offer. The
    ranks of one element are thus correlated over the components, which lowers the variance
    against independent hashes. Offers of step j are at least j, so the walk ends early as soon as
    every component holds less. All elements take a step together.
    """
    best = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    n = len(hashes)
    if n == 0:
        return best
    places = None
    rows = np.arange(n)
    for j in range(size):
        drawn = mix(hashes + _STEPS[j])
        # The low half chooses the place, the high bits are the fraction.
        pick = j + ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(size - j) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            reached, first = pick, pick
        else:
            if places is None:
                places = np.tile(np.arange(size, dtype=np.int32), (n, 1))
                places[rows, first], places[:, 0] = 0, first
            reached = places[rows, pick]
            places[rows, pick] = places[:, j]
            places[:, j] = reached
        offer = _FLOORS[j] | (drawn >> np.uint64(24))
        np.minimum.at(best, reached, offer)
        if best.max() < _FLOORS[j + 1]:
            break
    return best


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One signed 64-bit key per band of `rows` components; the band's number is part of it."""
    bands = signature.reshape(-1, rows)
    keys = np.arange(1, len(bands) + 1, dtype=np.uint64) * _MULTIPLIER
    for i in range(rows):
        keys = mix(keys * np.uint64(0xD6E8FEB86659FD93) + bands[:, i])
    return keys.view(np.int64)
