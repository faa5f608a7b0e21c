"""Hashes of word shingles for many texts at once.

A word is a run of bytes other than ASCII white space. A shingle is ``size`` neighbouring words; a text with fewer words, but at
least one, has one shingle of all its words, and a text without words has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BYTES = np.random.default_rng(11).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x2545F4914F6CDD1D
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 28, 29, 30, 31, 32]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64 bits."""
    x = x ^ (x >> np.uint64(32))
    x *= _B
    x ^= x >> np.uint64(32)
    x *= _B
    x ^= x >> np.uint64(32)
    return x


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for b in (_BASE, inverse):
        p = np.full(n, b, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


def word_hashes(blob: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of texts laid end to end (from ``offsets``), and the number of words of each."""
    raw = np.frombuffer(blob, np.uint8)
    n = len(raw)
    solid = np.zeros(n + 2, np.int8)
    solid[1:-1] = ~_BLANK[raw]
    edge = np.diff(solid)
    # A text's border ends a word as white space does.
    starts, ends = edge[:-1] == 1, edge[1:] == -1
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < n)]
    both = inner[(solid[inner] == 1) & (solid[inner + 1] == 1)]
    starts[both], ends[both - 1] = True, True
    first, last = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _powers(1 << max(n, 1024).bit_length())
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTES[raw] * up[:n], out=total[1:])
    hashes = mix((total[last] - total[first]) * down[first] + (last - first).astype(np.uint64) * _A)
    return hashes, np.diff(np.searchsorted(first, offsets))


def shingle_hashes(texts: list[bytes], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts in order, repeats included, and the bounds of each text among them."""
    offsets = np.cumsum([0, *map(len, texts)])
    words, counts = word_hashes(b"".join(texts), offsets)
    n = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.concatenate([[0], np.cumsum(n)])
    begin = np.concatenate([[0], np.cumsum(counts)])[:-1]
    first = np.repeat(begin - bounds[:-1], n) + np.arange(bounds[-1])
    held = np.repeat(np.minimum(counts, size), n)  # words of the shingle
    out = np.full(len(first), np.uint64(size))
    limit = max(len(words) - 1, 0)
    for i in range(size if len(words) else 0):
        more = i < held
        out = np.where(more, mix(out * _A + words[np.minimum(first + i, limit)]), out)
    return out, bounds


def grouped_bytes(texts: list[bytes], most: int = 1 << 20) -> Iterator[list[bytes]]:
    """Neighbouring texts in groups of about ``most`` bytes; a longer text is a group of its own."""
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > most:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def encoded(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass") for t in texts]
