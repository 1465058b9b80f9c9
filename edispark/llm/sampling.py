"""Improved consistent weighted sampling of shingle vectors.

For a shingle of weight w and a hash function, r and c are drawn from Gamma(2, 1) and b from [0, 1)
by the shingle's hash; t = floor(ln w / r + b), y = exp(r (t - b)), a = c / (y exp(r)). The sample
is (shingle, t) with the least a, and two vectors share it with the probability of their weighted
Jaccard similarity. Draws come from a table of 65,536 quantiles, so a sample costs no logarithm.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64


def _gamma_quantiles(n: int = 65536) -> np.ndarray:
    """Quantiles of Gamma(2, 1), whose distribution function is 1 - (1 + x) exp(-x), by bisection."""
    u = (np.arange(n) + 0.5) / n
    low, high = np.zeros(n), np.full(n, 64.0)
    for _ in range(60):
        mid = (low + high) / 2
        under = 1 - (1 + mid) * np.exp(-mid) < u
        low, high = np.where(under, mid, low), np.where(under, high, mid)
    return (low + high) / 2


_GAMMA = _gamma_quantiles().astype(np.float32)
_LOG_GAMMA = np.log(_gamma_quantiles()).astype(np.float32)
_SEEDS = np.random.default_rng(77).integers(1, 2**63, 4096, dtype=np.int64).astype(_U) | _U(1)


def samples(hashes: np.ndarray, weights: np.ndarray, at: np.ndarray, count: int) -> np.ndarray:
    """``count`` samples of each row as 32-bit integers; rows without shingles get zeros."""
    rows = len(at) - 1
    out = np.zeros((rows, count), np.uint32)
    full = np.flatnonzero(np.diff(at) > 0)
    if not len(full):
        return out
    log_w = np.log(weights).astype(np.float32)
    first = at[:-1][full]
    for f in range(count):
        x = (hashes ^ _SEEDS[f]) * _SEEDS[f + count]
        x ^= x >> _U(29)
        x *= _U(0xBF58476D1CE4E5B9)
        x ^= x >> _U(32)
        r = _GAMMA[(x & _U(0xFFFF)).astype(np.int32)]
        log_c = _LOG_GAMMA[((x >> _U(16)) & _U(0xFFFF)).astype(np.int32)]
        high = (x >> _U(32)).astype(np.uint32)
        b = (high >> np.uint32(8)).astype(np.float32) * np.float32(2.0**-24)
        t = np.floor(log_w / r + b)
        log_a = log_c - r * (t - b + np.float32(1))
        # positive floats order like their bits; equal ones go by the sample's own bits
        rank = (log_a + np.float32(256)).view(np.uint32).astype(_U) << _U(32)
        own = high ^ (t.astype(np.int32).view(np.uint32) * np.uint32(2654435761))
        out[full, f] = (np.minimum.reduceat(rank | own, first) & _U(0xFFFFFFFF)).astype(np.uint32)
    return out
