"""Array kernels: word hashes, shingle sets and the fast similarity sketch.

The sketch has ``t`` coordinates. In round ``i < t`` every element of a set goes to one
hashed bin and offers the value ``(i, v)``; in round ``t + b`` all elements offer values to
bin ``b``. A bin keeps its least value, so the first round that reaches it decides. The
rounds end when all bins are filled, which the second half guarantees. Two sets agree on a
coordinate with probability equal to their Jaccard similarity, and because each round deals
elements to bins without replacement of rounds, the share of agreeing coordinates is
concentrated as for independent samples or better.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit generator: a bijection that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """Cache of 64-bit word hashes, emptied when it holds ``most`` words."""

    def __init__(self, most: int = 400_000):
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words; order matters."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for i in range(n):
        out = mix64(out + _GOLD ^ words[i:i + count])
    return out


def shingle_set(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct shingles; a text of fewer than ``n`` words is one shingle, without words none."""
    if not len(words):
        return np.empty(0, np.uint64)
    return np.unique(gram_hashes(words, min(n, len(words))))


def sketches(sets: list[np.ndarray], t: int, seed: int = 1) -> np.ndarray:
    """One row of ``t`` coordinates per non-empty set."""
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    assert (sizes > 0).all()
    out = np.full((len(sets), t), EMPTY, np.uint64)
    flat = out.reshape(-1)
    elements = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    with np.errstate(over="ignore"):
        for i in range(2 * t):
            if not len(elements):
                break
            h = mix64(elements + _GOLD * np.uint64(2 * (seed + i * 2654435761) + 1))
            value = (np.uint64(i) << np.uint64(48)) | (h & np.uint64((1 << 48) - 1))
            # The bin comes from the high bits, the value from others: both from one hash.
            place = ((h >> np.uint64(48)) * np.uint64(t)) >> np.uint64(16) if i < t else np.full(len(h), i - t, np.uint64)
            slot = owner * t + place.astype(np.int64)
            np.minimum.at(flat, slot, value)
            open_rows = (out == EMPTY).any(axis=1)
            if not open_rows.any():
                break
            still = open_rows[owner]
            elements, owner = elements[still], owner[still]
    return out


def band_hashes(sketch: np.ndarray, rows: int) -> np.ndarray:
    """One hash per band of ``rows`` coordinates; the band's number is part of it."""
    bands = sketch.shape[1] // rows
    out = np.empty((len(sketch), bands), np.uint64)
    with np.errstate(over="ignore"):
        for b in range(bands):
            h = np.full(len(sketch), b + 1, np.uint64)
            for r in range(rows):
                h = mix64(h + _GOLD ^ sketch[:, b * rows + r])
            out[:, b] = h
    return out
