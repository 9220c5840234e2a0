"""NumPy helpers of the text operators: words, rolling fingerprints and content-defined anchors.

Texts stay in Arrow buffers; nothing here makes a Python string per word.  Fingerprints are
64-bit polynomials modulo 2^64 over random table values, finished by a bijective mixer.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa

PIECE = 1 << 19  # units worked on at once; keeps the temporaries of any text length bounded
_BASE = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD1342543DE82EF95)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mix((np.arange(256, dtype=np.uint64) + np.uint64(1)) * _BASE)


def _powers_of(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64, at least n of each."""
    have = _powers.get(int(base))
    if have is None or len(have[0]) < n:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        made = []
        for b in (base, inverse):
            p = np.full(max(n, 1024), b, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        have = _powers[int(base)] = tuple(made)
    return have


def prefix_sums(values: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers_of(base, len(values) + 1)[0][: len(values)], out=sums[1:])
    return sums


def ranges_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: np.uint64 = _BASE) -> np.ndarray:
    """Fingerprints of the unit ranges [start, end) from their prefix sums."""
    return mix((sums[end] - sums[start]) * _powers_of(base, len(sums))[1][start])


def grams(values: np.ndarray, k: int, other: bool = False) -> np.ndarray:
    """Fingerprint of the k units from every position on; ``other`` takes an independent one."""
    base = _OTHER if other else _BASE
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = prefix_sums(values, base)
    out = (sums[k:] - sums[:-k]) * _powers_of(base, len(sums))[1][:n]
    return mix(out)


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every w consecutive values."""
    span, out = 1, x
    while 2 * span <= w:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    if w > span:
        out = np.minimum(out[: len(out) - (w - span)], out[w - span :])
    return out


def text_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text or binary column and the n + 1 row offsets; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_binary())
    kind = pa.large_string() if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pa.large_binary()
    if column.null_count:
        column = column.fill_null("" if kind == pa.large_string() else b"")
    column = column.cast(kind)
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Memory that this worker holds but no longer uses goes back to the system.

    Workers outlive their tasks, and a pipeline's stages would each leave their own behind.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def tidy(run):
    """The function of an Arrow map or (co)group, which gives memory back when it is done."""

    def batches(rows):
        yield from run(rows)
        give_back()

    def group(key, table):
        out = run(key, table)
        give_back()
        return out

    def cogroup(key, table, other):
        out = run(key, table, other)
        give_back()
        return out

    return (batches, group, cogroup)[run.__code__.co_argcount - 1]


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A 256-entry mask of the bytes in the given closed ranges."""
    mask = np.zeros(256, bool)
    for low, high in ranges:
        mask[low : high + 1] = True
    return mask


NOT_SPACE = ~byte_class((0x09, 0x0D), (0x20, 0x20))
LETTERS_DIGITS = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def _cut(data: np.ndarray, row_starts: np.ndarray, at: int, kind: np.ndarray) -> int:
    """The first place from ``at`` on that no word spans."""
    row = row_starts[np.searchsorted(row_starts, at) :][:1]
    end = int(row[0]) if len(row) else len(data)
    for a in range(at, end, PIECE):
        gap = np.flatnonzero(~kind[data[a : min(a + PIECE, end)]])
        if len(gap):
            return a + int(gap[0])
    return end


def words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, lower: bool = False):
    """Words of all rows: first and past-the-end byte, fingerprint, and per row the word offsets.

    ``kind`` marks the bytes of words; with ``lower``, A-Z count as a-z.
    """
    kind = kind[LOWER] if lower else kind
    starts, ends, hashes = [], [], []
    row_starts = offsets[:-1]
    at = 0
    while at < len(data):
        stop = _cut(data, row_starts, min(at + PIECE, len(data)), kind)
        part = data[at:stop]
        inside = kind[part]
        fresh = np.zeros(len(part) + 1, bool)  # rows begin here
        fresh[row_starts[np.searchsorted(row_starts, at) : np.searchsorted(row_starts, stop)] - at] = True
        first = np.flatnonzero(inside & (np.concatenate(([True], ~inside[:-1])) | fresh[:-1]))
        last = np.flatnonzero(inside & (np.concatenate((~inside[1:], [True])) | fresh[1:])) + 1
        if len(first):
            sums = prefix_sums(BYTE_VALUES[LOWER[part] if lower else part])
            hashes.append(ranges_hash(sums, first, last))
            starts.append(first + at)
            ends.append(last + at)
        at = stop
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    start = np.concatenate(starts)
    return start, np.concatenate(ends), np.concatenate(hashes), np.searchsorted(start, offsets)


def anchored_runs(values: np.ndarray, offsets: np.ndarray, k: int, window: int):
    """Every window of ``window`` units inside a row, by its anchor.

    A window's anchor is its k-gram of least fingerprint, the first of equals: equal windows
    have equal anchors at equal places.  Yields, piece by piece, (anchor position, anchor
    fingerprint, first window start, past-the-end window start).
    """
    w = window - k + 1
    n = len(values)
    low = np.uint64((1 << 20) - 1)
    row_end = offsets[1:]
    for at in range(0, max(n - window + 1, 0), PIECE):
        part = values[at : min(n, at + PIECE + window - 1)]
        h = grams(part, k)
        if len(h) < w:
            continue
        keys = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        place = (sliding_min(keys, w) & low).astype(np.int64)
        starts = np.arange(at, at + len(place))
        # a window that runs over the end of its row is none
        row = np.searchsorted(row_end, [at, at + len(place) - 1], side="right")
        ok = np.ones(len(place), bool)
        for end in row_end[row[0] : row[1] + 1]:
            ok[max(0, end - window + 1 - at) : max(0, end - at)] = False
        good = np.flatnonzero(ok)
        if not len(good):
            continue
        p, s = place[good], starts[good]
        cut = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (s[1:] != s[:-1] + 1))))
        stop = np.append(cut[1:], len(p)) - 1
        yield p[cut] + at, h[p[cut]], s[cut], s[stop] + 1


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n units lie in any of the ranges [start, end)."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, ends, -1)
    return np.cumsum(change[:-1]) > 0


def runs_of(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-end positions of the runs of True."""
    edge = np.diff(np.concatenate(([False], mask, [False])).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
