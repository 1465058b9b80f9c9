"""Hashes of five-word shingles for whole Arrow batches, with numpy only.

Words are runs of anything but ASCII white space, with A-Z lower-cased. A word's hash is a
polynomial over its bytes modulo 2**64, taken for all words at once from one running sum; a
shingle's hash chains five of them. A text of one to four words is one shingle of all its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
_U = np.uint64
_P = 0x5851F42D4C957F2D
_INV = pow(_P, -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_WORD = ~_SPACE
#: Bytes of text taken in one step, more only for a single longer text.
STEP = 1 << 19
_CACHED = 1 << 14

_table = np.random.default_rng(20240607).integers(0, 2**63, 256, dtype=np.int64).astype(_U) * _U(2) + _U(1)
_table[65:91] = _table[97:123]
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, _U), np.ones(1, _U))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _raised(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        both = []
        for base in (_P, _INV):
            a = np.full(n, base, _U)
            a[0] = 1
            both.append(np.multiply.accumulate(a))
        _powers = (both[0], both[1])
    return _powers


def parts(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a text column as (first row, last row + 1, bytes, offsets of the rows in them)."""
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return
    wide = pa.types.is_large_string(texts.type)
    at = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(at, at[a] + STEP, side="right")) - 1)
        yield a, b, data[at[a] : at[b]], at[a : b + 1] - at[a]
        a = b


def word_bounds(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first and the last byte of all words."""
    n = len(data)
    word = _WORD[data]
    edge = np.zeros(n + 1, bool)
    edge[at] = True
    new = ~word[:-1] | edge[1:n]
    first = word.copy()
    first[1:] &= new
    np.logical_or(~word[1:], edge[1:n], out=new)
    word[:-1] &= new
    return np.flatnonzero(first), np.flatnonzero(word)


def bounded_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Hashes of the words between the bounds; the products are taken a cached piece at a time."""
    up, down = _raised(len(data))
    total = np.empty(len(data) + 1, _U)
    total[0] = 0
    for a in range(0, len(data), _CACHED):
        own = total[a + 1 : a + 1 + _CACHED]
        np.take(_table, data[a : a + _CACHED], out=own[: len(data) - a], mode="clip")
        own *= up[a : a + len(own)]
    np.cumsum(total, out=total)
    return mix((total[stops + 1] - total[starts]) * down[starts])


def word_hashes(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the number of words before each row (one entry more than rows)."""
    if len(data) == 0:
        return np.zeros(0, _U), np.zeros(len(at), np.int64)
    starts, stops = word_bounds(data, at)
    return bounded_hashes(data, starts, stops), np.searchsorted(starts, at)


def shingles(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row in ascending order, how often each occurs, and the rows' offsets in both."""
    words, w_at = word_hashes(data, at)
    per_row = np.diff(w_at)
    n = np.where(per_row >= WIDTH, per_row - WIDTH + 1, (per_row > 0).astype(np.int64))
    s_at = np.concatenate([[0], np.cumsum(n)])
    out = np.empty(s_at[-1], _U)
    long_rows = per_row >= WIDTH
    if long_rows.any():
        h = np.zeros(max(len(words) - WIDTH + 1, 0), _U)
        for k in range(WIDTH):
            h = h * _U(0x9E3779B97F4A7C15) + words[k : k + len(h)]
        h = mix(h)
        # a window that begins in the last words of a row runs into the next row
        left = np.repeat(w_at[1:], per_row)[: len(h)] - np.arange(len(h))
        rows_long = np.repeat(long_rows, per_row)[: len(h)]
        keep = (left >= WIDTH) & rows_long
        out[np.repeat(long_rows, n)] = h[keep]
    for r in np.flatnonzero((per_row > 0) & ~long_rows):
        x = _U(per_row[r])
        for w in words[w_at[r] : w_at[r + 1]]:
            x = _U((int(x) * 0x9E3779B97F4A7C15 + int(w)) % 2**64)
        out[s_at[r]] = mix(np.array([x], _U))[0]
    for a, b in zip(s_at[:-1], s_at[1:], strict=True):
        out[a:b].sort()
    if not len(out):
        return out, np.zeros(0, np.int64), s_at
    new = np.ones(len(out), bool)
    new[1:] = out[1:] != out[:-1]
    new[s_at[:-1][n > 0]] = True
    spots = np.flatnonzero(new)
    return out[spots], np.diff(np.append(spots, len(out))), np.searchsorted(spots, s_at)
