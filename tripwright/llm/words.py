"""Words of many texts at once, as spans and 64-bit hashes over their UTF-8 bytes."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa

#: Bytes hashed at a time, so that the arrays on the way stay a few megabytes.
CHUNK = 1 << 19
_BASE = 0x9E3779B97F4A7C15
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: A byte of a word if words are runs of anything but ASCII white space.
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0, 1, ... n - 1 modulo 2 ** 64 for n up to CHUNK; kept while the Python worker lives."""
    kept = sys.modules.setdefault("_tripwright_powers", {})
    if base not in kept:
        steps = np.full(CHUNK, base, np.uint64)
        steps[0] = 1
        kept[base] = np.multiply.accumulate(steps)
    return kept[base][:n]


def _long_sum(raw: np.ndarray) -> int:
    """The polynomial of one span of any length, a chunk at a time."""
    total = 0
    for at in range(0, len(raw), CHUNK):
        own = raw[at : at + CHUNK]
        total += int((_BYTE_VALUES[own] * _power(_BASE, len(own))).sum(dtype=np.uint64)) * pow(_BASE, at, 1 << 64)
    return total % (1 << 64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n + 1 offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def spans(raw: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in all rows; no word reaches over the end of its row."""
    inside = is_word[raw]
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.empty_like(inside), np.empty_like(inside)
    before[0], before[1:] = False, inside[:-1]
    after[-1], after[:-1] = False, inside[1:]
    cuts = offsets[(offsets > 0) & (offsets < len(raw))]
    before[cuts] = False
    after[cuts - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: a polynomial in the values of its bytes, then mixed."""
    out = np.empty(len(starts), np.uint64)
    values, inverse = _BYTE_VALUES, pow(_BASE, -1, 1 << 64)
    i = 0
    while i < len(starts):
        first = starts[i]
        if ends[i] - first > CHUNK:
            out[i] = _long_sum(raw[first : ends[i]])
            i += 1
            continue
        j = int(np.searchsorted(ends, first + CHUNK, "right"))
        n = int(ends[j - 1] - first)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values[raw[first : first + n]] * _power(_BASE, n), out=sums[1:])
        a, b = starts[i:j] - first, ends[i:j] - first
        out[i:j] = (sums[b] - sums[a]) * _power(inverse, n)[a]
        i = j
    return mix(out)


def shingles(hashed: np.ndarray, per_row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words per row, ascending, and how many each row has.

    A row with fewer words, but any, has one shingle: its whole sequence.
    """
    total = len(hashed)
    joined = np.zeros(total, np.uint64)
    for k in range(size):
        step = np.uint64((2 * k + 3) * _BASE % (1 << 64) | 1)
        joined[: max(0, total - k)] += hashed[k:] * step
    joined = mix(joined)
    out, counts, at = [], np.zeros(len(per_row), np.int64), 0
    for row, n in enumerate(per_row.tolist()):
        if n >= size:
            own = np.sort(joined[at : at + n - size + 1])
            keep = np.empty(len(own), bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        elif n:
            own = np.full(1, n, np.uint64)
            for k in range(n):
                own = mix((own + hashed[at + k : at + k + 1]) * np.uint64(_BASE))
        else:
            own = np.zeros(0, np.uint64)
        out.append(own)
        counts[row] = len(own)
        at += n
    return np.concatenate(out) if out else np.zeros(0, np.uint64), counts


def per_row(starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of spans that start in each row."""
    return np.diff(np.searchsorted(starts, offsets, "left"))
