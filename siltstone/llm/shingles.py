"""Word shingles of many texts at once, as sets of 64-bit hashes."""

from __future__ import annotations

import numpy as np

SHINGLE = 5

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
IS_GAP = np.zeros(256, bool)
IS_GAP[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, out=out)


def mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[bytes]) -> list[np.ndarray]:
    """For each text its sorted, distinct shingles; the text itself as one if it has fewer words."""
    data = LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
    none = np.zeros(0, np.uint64)
    if not len(data):
        return [none for _ in texts]
    gap = IS_GAP[data]
    edge = np.flatnonzero(np.diff(np.r_[True, gap, True]))
    start, end = edge[0::2], edge[1::2]
    lengths = np.array([len(t) + 1 for t in texts])
    bounds = np.searchsorted(start, np.r_[0, np.cumsum(lengths)])
    if not len(start):
        return [none for _ in texts]
    with np.errstate(over="ignore"):
        up, down = powers(BASE, len(data)), powers(INVERSE, len(data))
        upto = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up)]
        word = mixed((upto[end] - upto[start]) * down[start] + (end - start).astype(np.uint64))
        rolled = np.zeros(max(0, len(word) - SHINGLE + 1), np.uint64)
        for j in range(SHINGLE):
            rolled = (rolled + word[j : j + len(rolled)]) * np.uint64(0xD6E8FEB86659FD93)
        rolled = mixed(rolled)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            out.append(np.unique(rolled[a : b - SHINGLE + 1]))
        elif b > a:
            whole = np.uint64(b - a)
            with np.errstate(over="ignore"):
                for w in word[a:b]:
                    whole = (whole + w) * np.uint64(0xA0761D6478BD642F)
            out.append(mixed(np.array([whole])))
        else:
            out.append(none)
    return out
