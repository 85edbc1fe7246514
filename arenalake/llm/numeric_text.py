"""Rolling hashes of code points or bytes, for a whole text at once.

The hash of positions i to j is the sum of mixed symbols times powers of an odd number, modulo
2**64, moved back to power zero; equal strings get equal hashes wherever they stand.
"""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, kept for the next text."""
    if len(_powers["up"]) < n:
        size = max(n, 1 << 16, 2 * len(_powers["up"]))
        for name, factor in (("up", BASE), ("down", INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64 bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def prefix_sums(symbols: np.ndarray) -> np.ndarray:
    up, _ = powers(len(symbols) + 1)
    sums = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum((symbols.astype(np.uint64) + np.uint64(0x51ED27)) * np.uint64(0xD6E8FEB86659FD93) * up[:-1], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    _, down = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * down[starts])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
