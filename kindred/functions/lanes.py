"""Vectorised string comparison inside a task: one NumPy lane per pair of names.

Two kernels for the longest common subsequence (LCS):

* bit vectors (Hyyro, "Bit-parallel LCS-length computation revisited", 2004) for the LCS of
  two strings, the shorter of at most 64 characters: one step per character of the longer;
* "seaweed braid" combing (Tiskin, "Semi-local string comparison", 2008) otherwise, and
  wherever windows count: one sweep over the m x n grid gives the LCS of the whole of ``a``
  with *every* substring of ``b``.  Cells of an anti-diagonal are independent, hence a
  sweep is m+n-1 array operations over all lanes.
"""

from __future__ import annotations

import numpy as np

# Padding never equals a name character nor the other side's padding.
PAD_A, PAD_B = 0, 1
_LANE_BYTES = 1 << 19
_BITS = 64
_BIT_LANES = 1 << 14

# Characters of normalised names; code 0 stands for anything else and matches nothing.
ALPHABET = b" abcdefghijklmnopqrstuvwxyz0123456789"
CODE = np.zeros(256, np.uint8)
CODE[np.frombuffer(ALPHABET, np.uint8)] = np.arange(1, len(ALPHABET) + 1)
_CODES = len(ALPHABET) + 1


class Strands:
    """Strings stored end to end, gathered into (position, lane) matrices on demand."""

    def __init__(self, texts):
        coded = [t.encode("latin-1") for t in texts]
        self.size = np.fromiter(map(len, coded), np.int32, len(coded))
        self.start = np.zeros(len(coded), np.int64)
        np.cumsum(self.size[:-1], out=self.start[1:])
        self.flat = np.frombuffer(b"".join(coded) + b"\0", np.uint8)
        self._masks = None

    def masks(self):
        """Per string and character code: bits of the positions holding it (first 64 only)."""
        if self._masks is None:
            owner = np.repeat(np.arange(self.size.size), self.size)
            place = np.arange(owner.size) - self.start[owner]
            code = CODE[self.flat[:-1]]
            some = (place < _BITS) & (code > 0)
            masks = np.zeros(self.size.size * _CODES, np.uint64)
            at = owner[some] * _CODES + code[some]
            np.add.at(masks, at, np.uint64(1) << place[some].astype(np.uint64))
            self._masks = masks
        return self._masks

    def codes(self, i):
        """Character codes of one string."""
        return CODE[self.flat[self.start[i] : self.start[i] + self.size[i]]]

    def gather(self, ids, width, pad, front=False):
        """Character matrix of the given strings, padded at the end or at the front."""
        row = np.arange(width, dtype=np.int64)[:, None]
        size = self.size[ids].astype(np.int64)
        if front:
            row = row - (width - size)
            inside = row >= 0
        else:
            inside = row < size
        at = np.where(inside, self.start[ids] + row, self.flat.size - 1)
        return np.where(inside, self.flat[at], np.uint8(pad))


def comb(a, b):
    """Strand number leaving the grid below each column of ``b``; shape of ``b``.

    Numbers below m entered from the left edge, number m+j entered above column j.
    """
    (m, lanes), n = a.shape, b.shape[0]
    kind = np.int8 if m + n <= 127 else np.int16 if m + n <= 32767 else np.int32
    side = np.empty((m, lanes), kind)
    side[:] = np.arange(m - 1, -1, -1, dtype=kind)[:, None]
    top = np.empty((n, lanes), kind)
    top[:] = np.arange(m + n - 1, m - 1, -1, dtype=kind)[:, None]
    back = np.ascontiguousarray(b[::-1])
    depth = min(m, n)
    low, high = np.empty((depth, lanes), kind), np.empty((depth, lanes), kind)
    same = np.empty((depth, lanes), bool)
    turn = same.view(np.int8) if kind is np.int8 else np.empty((depth, lanes), kind)
    for diagonal in range(m + n - 1):
        i, stop = max(0, diagonal - n + 1), min(m, diagonal + 1)
        k, j = stop - i, n - 1 - diagonal + i
        s, t = side[i:stop], top[j : j + k]
        np.equal(a[i:stop], back[j : j + k], out=same[:k])
        # Unequal characters: the strands cross unless they already have (min / max).
        # Equal characters: they bounce, which the masked xor restores.
        np.negative(same[:k].view(np.int8), out=turn[:k])
        np.minimum(s, t, out=low[:k])
        np.maximum(s, t, out=high[:k])
        bounce = np.bitwise_and(np.bitwise_xor(low[:k], t, out=s), turn[:k], out=s)
        np.bitwise_xor(high[:k], bounce, out=t)
        np.bitwise_xor(low[:k], bounce, out=s)
    return top[::-1]


def _chunks(long_size, short_size, exact_short):
    """Index runs of pairs alike in size, small enough to stay in cache."""
    order = np.lexsort((long_size, short_size))
    start, total = 0, order.size
    while start < total:
        m, n = int(short_size[order[start]]), int(long_size[order[start]])
        stop = min(total, start + max(64, _LANE_BYTES // (4 * (m + n + 1))))
        run = order[start:stop]
        if exact_short:
            stop = start + int(np.searchsorted(short_size[run], m, "right"))
        else:
            # A run may widen, but not to more than about twice the work per lane.
            grown = (short_size[run] > 2 * m + 8) | (long_size[run] > 2 * n + 8)
            if grown.any():
                stop = start + int(grown.argmax())
        yield order[start:stop]
        start = stop


def _low_bits(sizes):
    sizes = sizes.astype(np.uint64)
    return np.where(sizes >= _BITS, ~np.uint64(0), (np.uint64(1) << (sizes % np.uint64(_BITS))) - np.uint64(1))


def _lcs_bits(pattern, pi, text, ti, kept=None):
    """LCS of each pair by bit vectors; patterns of at most 64 characters.

    ``kept`` restricts both strings to the characters whose bits are set in its two arrays.
    """
    out = np.zeros(len(pi), np.int64)
    masks = pattern.masks()
    order = np.argsort(text.size[ti], kind="stable")
    for start in range(0, order.size, _BIT_LANES):
        at = order[start : start + _BIT_LANES]
        codes = CODE[text.gather(ti[at], int(text.size[ti[at[-1]]]), PAD_B)]
        base = pi[at].astype(np.int64) * _CODES
        full = _low_bits(pattern.size[pi[at]])
        state = full.copy()
        for j, code in enumerate(codes):
            hit = masks[base + code]
            if kept is not None:
                hit &= kept[0][at]
                hit &= -((kept[1][at] >> np.uint64(j)) & np.uint64(1))
            hit &= state
            state = (state + hit) | (state - hit)
        out[at] = np.bitwise_count(full & ~state)
    return out


def lcs(a, ai, b, bi):
    """LCS length of each pair (a[ai], b[bi])."""
    out = np.zeros(len(ai), np.int64)
    la, lb = a.size[ai], b.size[bi]
    some = (la > 0) & (lb > 0)
    bits_a = some & (la <= lb) & (la <= _BITS)
    bits_b = some & (lb < la) & (lb <= _BITS)
    for who, p, pi, t, ti in ((bits_a, a, ai, b, bi), (bits_b, b, bi, a, ai)):
        at = np.flatnonzero(who)
        if at.size:
            out[at] = _lcs_bits(p, pi[at], t, ti[at])
    work = np.flatnonzero(some & ~bits_a & ~bits_b)
    for run in _chunks(lb[work], la[work], False):
        at = work[run]
        m, n = int(la[at].max()), int(lb[at].max())
        ends = comb(a.gather(ai[at], m, PAD_A), b.gather(bi[at], n, PAD_B))
        out[at] = np.count_nonzero(ends < m, axis=0)
    return out


def lcs_kept(a, ai, b, bi, kept_a, kept_b):
    """LCS of each pair counting only the characters marked by bits; at most 64 a side."""
    return _lcs_bits(a, ai, b, bi, (kept_a, kept_b))


def _best_ratio(common, total):
    """Column maximum of 200 * common / total."""
    quotient = common * 200.0
    quotient /= total
    return quotient.max(axis=0)


def _windows(needle: Strands, ni, hay: Strands, hi):
    """LCS and best window ratio of each pair; no needle is longer than its hay."""
    whole, best = np.zeros(len(ni), np.int64), np.zeros(len(ni))
    short, long = needle.size[ni], hay.size[hi]
    for at in _chunks(long, short, True):
        m, n = int(short[at[0]]), int(long[at].max())
        skip = n - long[at]
        # Hays are padded in front, so every lane ends on the last column.
        ends = comb(needle.gather(ni[at], m, PAD_A), hay.gather(hi[at], n, PAD_B, front=True))
        from_top = ends >= m
        whole[at] = n - np.count_nonzero(from_top, axis=0)
        tiny = m + n <= 32767
        count = np.int16 if tiny else np.int32
        col = np.arange(n, dtype=count)[:, None]
        # Column where the strand entering above each column leaves; n if it does not.
        leave = np.full((m + n) * at.size, n, count)
        slot = ends.astype(np.int32 if leave.size < 2**31 else np.int64)
        slot *= at.size
        slot += np.arange(at.size, dtype=slot.dtype)
        leave[slot] = col
        leave = leave.reshape(m + n, at.size)[m:]
        # Windows ending after column j: at most m wide, so first growing, then sliding.
        lost = np.empty((n, at.size), count)
        np.cumsum(from_top[:m], axis=0, dtype=count, out=lost[:m])
        if n > m:
            step = (ends[m:] >= col[m:]).view(np.int8) - (leave[: n - m] <= col[m:]).view(np.int8)
            np.cumsum(step, axis=0, dtype=count, out=lost[m:])
            lost[m:] += lost[m - 1]
        common = np.minimum(col + 1, m) - lost
        real = np.clip(col + 1 - skip.astype(count), 0, m)
        best[at] = _best_ratio(common, m + real)
        if m > 1:
            # Windows shorter than the needle that end on the last column.
            stays = (leave[n - m + 1 :] < n)[::-1]
            tail = np.arange(1, m, dtype=count)[:, None]
            common = tail - np.cumsum(stays, axis=0, dtype=count)
            best[at] = np.maximum(best[at], _best_ratio(common, m + tail))
    return whole, best


def windows(a: Strands, ai, b: Strands, bi):
    """LCS and best partial ratio (0-100) of each pair, either side being the shorter."""
    whole, best = np.zeros(len(ai), np.int64), np.zeros(len(ai))
    la, lb = a.size[ai], b.size[bi]
    some = (la > 0) & (lb > 0)
    for side in (0, 1):
        # Pairs of equal length take part in both roles.
        at = np.flatnonzero(some & ((la <= lb) if side == 0 else (lb <= la)))
        if at.size:
            one = _windows(a, ai[at], b, bi[at]) if side == 0 else _windows(b, bi[at], a, ai[at])
            whole[at] = one[0]
            best[at] = np.maximum(best[at], one[1])
    return whole, best
