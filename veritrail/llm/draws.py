"""Hypergeometric draws of any size, exact up to the rounding of doubles.

The mass function comes by the saddle-point expansion of the binomial (deviances and Stirling's remainders), which loses no digits to large
factorials. Draws are by rejection under a flat top with exponential tails, which bounds every log-concave law on the integers, so
that the expected number of trials is the same small one at every size.
"""

from __future__ import annotations

from math import lgamma

import numpy as np

_HALF_LOG_2PI = 0.5 * np.log(2 * np.pi)
_SMALL = np.array([0.0] + [lgamma(n + 1) - ((n + 0.5) * np.log(n) - n + _HALF_LOG_2PI) for n in range(1, 16)])


def remainder(n: np.ndarray) -> np.ndarray:
    """log n! less Stirling's formula."""
    m = np.maximum(n, 16.0)
    q = 1 / (m * m)
    series = (1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - q / 1188) * q) * q) * q) / m
    return np.where(n < 16, _SMALL[np.minimum(n, 15).astype(np.int64)], series)


def deviance(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """x log(x / mean) + mean - x, for positive x."""
    v = (x - mean) / (x + mean)
    near, term = (x - mean) * v, 2 * x * v
    for j in range(1, 12):
        term = term * v * v
        near = near + term / (2 * j + 1)
    return np.where(np.abs(v) < 0.1, near, x * np.log(x / mean) + mean - x)


def log_binomial(x: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """log of the binomial's mass at x of n, for p strictly between 0 and 1."""
    a, b = np.maximum(x, 1.0), np.maximum(n - x, 1.0)
    m = np.maximum(n, 1.0)
    inner = remainder(m) - remainder(a) - remainder(b) - deviance(a, m * p) - deviance(b, m * (1 - p)) + 0.5 * np.log(m / (2 * np.pi * a * b))
    return np.where(n == 0, 0.0, np.where(x == 0, n * np.log1p(-p), np.where(x == n, n * np.log(p), inner)))


def log_mass(x: np.ndarray, good: np.ndarray, bad: np.ndarray, n: np.ndarray) -> np.ndarray:
    """log of the chance of x good ones among n drawn, for 0 < n < good + bad and x in its range."""
    p = n / (good + bad)
    return log_binomial(x, good, p) + log_binomial(n - x, bad, p) - log_binomial(n, good + bad, p)


def hypergeometric(good: np.ndarray, bad: np.ndarray, n: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """For each place a draw of how many good ones are among n of good + bad."""
    good, bad, n = (np.asarray(a, float) for a in (good, bad, n))
    low, high = np.maximum(0, n - bad), np.minimum(n, good)
    out = low.copy()
    open_ = np.nonzero(low < high)[0]
    mode = np.clip(np.floor((n + 1) / (good + bad + 2) * (good + 1)), low, high)
    top = np.zeros(len(out))
    top[open_] = log_mass(mode[open_], good[open_], bad[open_], n[open_])
    while len(open_):
        peak = np.exp(top[open_])
        flat = 1 + peak / 2
        u, v, w, sign = rng.random((4, len(open_)))
        away = np.where(u <= flat / (1 + flat), v * flat, flat - np.log(np.maximum(v, 1e-300))) / peak
        x = mode[open_] + np.where(sign < 0.5, -1, 1) * np.rint(away)
        inside = (x >= low[open_]) & (x <= high[open_])
        try_, x = open_[inside], x[inside]
        bound = np.minimum(0.0, (flat - peak * away)[inside]) + np.log(np.maximum(w[inside], 1e-300))
        good_ones = bound <= log_mass(x, good[try_], bad[try_], n[try_]) - top[try_]
        out[try_[good_ones]] = x[good_ones]
        taken = np.zeros(len(out), bool)
        taken[try_[good_ones]] = True
        open_ = open_[~taken[open_]]
    return out.astype(np.int64)


def multivariate(counts: np.ndarray, n: int, rng: np.random.Generator) -> np.ndarray:
    """How many of n drawn are of each kind: halves of the kinds share what is drawn, then halves of these, all of a level at once."""
    counts = np.asarray(counts, np.int64)
    size = 1 << max(0, (len(counts) - 1).bit_length())
    sums = [np.concatenate((counts, np.zeros(size - len(counts), np.int64)))]
    while len(sums[-1]) > 1:
        sums.append(sums[-1].reshape(-1, 2).sum(1))
    drawn = np.array([n], np.int64)
    for level in sums[-2::-1]:
        left, right = level.reshape(-1, 2).T
        first = hypergeometric(left, right, drawn, rng)
        drawn = np.stack((first, drawn - first), axis=1).ravel()
    return drawn[: len(counts)]
