"""Word shingles as 64-bit hashes, computed over the bytes of many texts at once."""

from __future__ import annotations

import functools

import numpy as np

SEGMENT = 1 << 20  # bytes hashed at once

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_GAP = np.zeros(256, dtype=bool)
_GAP[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(20).integers(0, 1 << 64, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of every word of lower-cased bytes."""
    word = ~_GAP[raw]
    edge = np.flatnonzero(np.diff(word.view(np.int8), prepend=0, append=0))
    first, end = edge[::2], edge[1::2]
    hashes, at, lo = [], 0, 0
    while at < len(first):
        # words that end within a segment from the first one's start; at least one
        lo = first[at]
        to = max(at + 1, int(np.searchsorted(end, lo + SEGMENT, side="right")))
        part = raw[lo:end[to - 1]]
        size = 1 << max(20, (len(part) + 1).bit_length())
        power, inverse = _powers(size)
        total = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[part] * power[:len(part)], out=total[1:])
        s, e = first[at:to] - lo, end[at:to] - lo
        hashes.append(mix((total[e] - total[s]) * inverse[s] + (e - s).astype(np.uint64)))
        at = to
    return (np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)), first


def shingle_sets(texts: list[str | None], k: int = 2) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text.

    A shingle is ``k`` consecutive words; a text with fewer words has one
    shingle, its whole sequence; a text without words has none.
    """
    parts = [(t or "").encode("utf-8", "replace") for t in texts]
    starts = np.cumsum([0] + [len(p) + 1 for p in parts])
    raw = _LOWER[np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)]
    words, first = _word_hashes(raw)
    bounds = np.searchsorted(first, starts)
    out = []
    joined = words.copy()
    for j in range(1, k):
        joined = mix(joined * _M1 + np.concatenate([words[j:], np.zeros(min(j, len(words)), dtype=np.uint64)]))
    for lo, hi in zip(bounds, bounds[1:]):
        n = hi - lo
        if n >= k:
            out.append(np.unique(joined[lo:hi - k + 1]))
        elif n:
            one = np.array([n], dtype=np.uint64)
            for i in range(lo, hi):
                one = mix(one * _M2 + words[i:i + 1])
            out.append(one)
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
