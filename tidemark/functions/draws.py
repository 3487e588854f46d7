"""Random draws that are a function of (seed, key, iteration), drawn a whole batch at a time.

A draw needs no generator state: any task can repeat any of them, in any order, and SQL can state
them too. ``mix`` is the finisher of splitmix64; sums and products are modulo 2^64.
"""

from __future__ import annotations

import functools
import math

import numpy as np

# fixed values of splitmix64
STEP = 0x9E3779B97F4A7C15
FIRST = 0xBF58476D1CE4E5B9
SECOND = 0x94D049BB133111EB


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(FIRST)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(SECOND)
    return x ^ (x >> np.uint64(31))


def uniforms(keys: np.ndarray, iterations: np.ndarray, seed: int) -> np.ndarray:
    """Numbers in [0, 1) in steps of 2^-53: mix(mix(key + seed * STEP) + (iteration + 1) * STEP)."""
    start = mix(keys.astype(np.uint64) + np.uint64(seed * STEP % 2**64))
    step = (iterations.astype(np.uint64) + np.uint64(1)) * np.uint64(STEP)
    return (mix(start[:, None] + step) >> np.uint64(11)).astype(float) * 2.0**-53


@functools.lru_cache(maxsize=4096)
def poisson_table(lam: float) -> tuple[int, np.ndarray]:
    """(first count, P(count <= first + i)): counts within 12 standard deviations, and 30 more."""
    mode = math.floor(lam)
    reach = 12 * math.sqrt(lam) + 30
    first, last = max(0, math.floor(lam - reach)), math.ceil(lam + reach)
    up = np.cumsum(np.log(lam / np.arange(mode + 1, last + 1)))
    down = np.cumsum(np.log(np.arange(mode, first, -1) / lam))[::-1]
    weight = np.exp(np.concatenate([down, [0.0], up]))
    return first, np.cumsum(weight) / weight.sum()


def poisson(keys: np.ndarray, lams: np.ndarray, iterations: np.ndarray, seed: int) -> np.ndarray:
    """Poisson counts, a row for each key with its mean and a column for each iteration, by inversion."""
    u = uniforms(keys, iterations, seed)
    out = np.zeros(u.shape, np.int64)
    for lam in np.unique(lams):
        if lam > 0:
            same = lams == lam
            first, table = poisson_table(float(lam))
            out[same] = first + np.minimum(np.searchsorted(table, u[same], "right"), len(table) - 1)
    return out
