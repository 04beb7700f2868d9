"""Words of flat byte arrays: hashes of all of them at once, and which are equal."""

from __future__ import annotations

import numpy as np

#: Odd multiplier of the hashes, which wrap at 64 bits, and its inverse there.
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit numbers over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(flat: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each stretch of ``flat`` that depends on its bytes alone."""
    n = len(flat)
    powers = np.full(n, _BASE, np.uint64)
    powers[:1] = 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((flat.astype(np.uint64) + np.uint64(1)) * np.cumprod(powers), out=sums[1:])
    powers[1:] = _UNBASE
    found = (sums[stops] - sums[starts]) * np.cumprod(powers)[starts]
    return mixed(found ^ ((stops - starts).astype(np.uint64) << np.uint64(48)))


def distinct(flat: np.ndarray, starts: np.ndarray, stops: np.ndarray,
             hashed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Number of the distinct word for each word, and which word is the first of each.

    Words of one hash are compared; should two of them differ, words are told apart by their bytes.
    """
    if hashed is None:
        hashed = hashes(flat, starts, stops)
    sizes = stops - starts
    _, first, kind = np.unique(hashed, return_index=True, return_inverse=True)
    if np.array_equal(sizes, sizes[first][kind]):
        gap = np.repeat(starts[first][kind] - starts, sizes)
        at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(len(gap))
        if np.array_equal(flat[at], flat[at + gap]):
            return kind, first
    raw = flat.tobytes()
    seen: dict[bytes, int] = {}
    firsts: list[int] = []
    kind = np.empty(len(starts), np.int64)
    for i, (a, b) in enumerate(zip(starts.tolist(), stops.tolist())):
        kind[i] = k = seen.setdefault(raw[a:b], len(seen))
        if k == len(firsts):
            firsts.append(i)
    return kind, np.array(firsts, np.int64)
