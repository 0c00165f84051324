"""Word shingles as 64-bit hashes, many texts at a time, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Longest shingle, in words.
LONGEST = 8
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z as a-z
_BYTE[[9, 10, 11, 12, 13, 32]] = 0
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _RNG.integers(1, 1 << 63, LONGEST, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = np.ones(1, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(max(n, 1024), _BASE))])
    return _powers


def sets(texts: list[str | None], words: int = 4, size: int = 1 << 18) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingles of so many words; a text with fewer words has one of all its words.

    Words are runs of bytes other than ASCII blanks, A-Z in lower case. Texts are hashed together, about size bytes at once."""
    at = 0
    while at < len(texts):
        some, total = [], 0
        while at < len(texts) and (not some or total < size):
            some.append((texts[at] or "").encode("utf-8", "surrogatepass"))
            total += len(some[-1]) + 1
            at += 1
        yield from _sets(some, words)


def _sets(some: list[bytes], w: int) -> Iterator[np.ndarray]:
    b = np.frombuffer(b" ".join(some) + b" ", np.uint8)
    value = _BYTE[b]
    inside = value != 0
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begins)
    if len(starts):
        value, from_first = value[starts[0] :], starts - starts[0]
        place = np.arange(len(value)) - np.repeat(from_first, np.diff(np.append(from_first, len(value))))
        words = mixed(np.add.reduceat(value * _power(int(place.max()) + 1)[place], from_first))
    else:
        words = np.zeros(0, np.uint64)
    lengths = np.array([len(x) + 1 for x in some])
    ends = np.searchsorted(starts, np.cumsum(lengths))
    n = len(words) - w + 1
    if n > 0:
        full = words[:n] * _PLACE[0]
        for j in range(1, w):
            full = full + words[j : n + j] * _PLACE[j]
        full = mixed(full + np.uint64(w))
    first = 0
    for end in ends.tolist():
        k = end - first
        if k >= w:
            yield np.unique(full[first : end - w + 1])
        elif k:
            yield mixed((words[first:end] * _PLACE[:k]).sum(keepdims=True) + np.uint64(k))
        else:
            yield np.zeros(0, np.uint64)
        first = end
