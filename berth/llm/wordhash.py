"""Vectorised word and shingle fingerprints over batches of texts.

A batch of UTF-8 texts is one byte array; words are the runs of bytes outside
``0x20, 0x09-0x0D`` with A-Z folded to a-z. A word's fingerprint is a sum of
random per-byte values weighted by powers of an odd constant, finished with a
bijective mixer, so equal words have equal 64-bit fingerprints and others
differ but for chance (2^-64 a pair).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_WS = np.zeros(256, bool)
_WS[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256)
_FOLD[0x41:0x5B] += 0x20
_BYTE = np.random.default_rng(20240501).integers(1, 2**63, 256, dtype=np.uint64)[_FOLD]
_RADIX = 0x9E3779B97F4A7C15
_INVERSE = pow(_RADIX, -1, 2**64)
_POWERS = {_RADIX: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64, kept between calls."""
    known = _POWERS[base]
    while len(known) < n:
        known = np.concatenate([known, known * np.uint64(pow(base, len(known), 2**64))])
    _POWERS[base] = known
    return known[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finisher of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def batch_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def batches(column: pa.Array, limit: int = 400_000):
    """(first row, bytes, offsets) for runs of rows of about ``limit`` bytes, so that
    the arrays of a run stay in a core's cache; one longer text makes a run of its own."""
    raw, offsets = batch_bytes(column)
    n, at = len(offsets) - 1, 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        yield at, raw[offsets[at]:offsets[end]], offsets[at:end + 1] - offsets[at]
        at = end


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """sums[i]: values[:i], each weighted by the power of its place, modulo 2^64."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(_RADIX, len(values)), out=sums[1:])
    return sums


def spans(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Fingerprints of the spans [start, end), equal wherever the span stands."""
    return mix((sums[end] - sums[start]) * powers(_INVERSE, len(sums))[start] + (end - start).astype(np.uint64) * np.uint64(_RADIX))


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint of each word, index of the first word of each text and the end)."""
    n = len(raw)
    inside = ~_WS[raw]
    edge = np.zeros(n + 1, bool)
    edge[0], edge[n] = n > 0 and inside[0], n > 0 and inside[-1]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:-1])
    # a word also ends where its text ends
    seams = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
    seams = np.unique(seams[inside[seams] & inside[seams - 1]])
    border = np.flatnonzero(edge)
    if len(seams):
        border = np.sort(np.concatenate([border, seams, seams]), kind="stable")
    start, end = border[::2], border[1::2]
    return spans(prefix_sums(_BYTE[raw]), start, end), np.searchsorted(start, offsets)


def shingles(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint of each k-word shingle in text order, bounds by text).

    A text of one to k-1 words has one shingle, its whole sequence; a text
    without words has none.
    """
    word, at = words(raw, offsets)
    count = np.diff(at)
    number = np.where(count >= k, count - k + 1, np.minimum(count, 1))
    bounds = np.concatenate([[0], np.cumsum(number)])
    if not bounds[-1]:
        return np.zeros(0, np.uint64), bounds
    first = np.repeat(at[:-1] - bounds[:-1], number) + np.arange(bounds[-1])
    padded = np.concatenate([word, np.zeros(k, np.uint64)])
    out = np.zeros(len(first), np.uint64)
    short = np.flatnonzero(np.repeat(count < k, number))
    length = np.repeat(count, number)[short]
    for j in range(k):
        here = padded[first + j]
        here[short[length <= j]] = 0
        out += here * np.uint64(pow(_RADIX, j + 1, 2**64))
    return mix(out), bounds
