"""Counts that bound the scores of one right name against all left names of a tile at once.

The left names' bit vectors lie side by side, so a character of the right name is one row of
masks for all of them: the longest common subsequence (LCS) of a pair costs four array
operations per character and no gathering.  Everything is a small count (uint8) compared with
the least count that could still reach a left name's cutoff.  Left names have at most 64
characters; right names may have any length.
"""

from __future__ import annotations

import numpy as np

from .lanes import _BITS, _CODES, CODE, PAD_B

_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)
# A token held by one in this many left names is kept as a row for all of them.
_DENSE = 32
# Pairs whose windows are bounded together.
_REFINE_LANES = 1 << 12


def least(x, strict):
    """Smallest count of at least ``x``, or above it where ``strict``, within uint8."""
    whole = np.where(strict, np.floor(x + 1e-9) + 1, np.ceil(x - 1e-9))
    return np.clip(whole, 0, 255).astype(np.uint8)


class Masks:
    """Bit vectors of all left names, one row per character code."""

    def __init__(self, strands):
        n = strands.size.size
        self.rows = np.ascontiguousarray(strands.masks().reshape(n, _CODES).T)
        self.s, self.u, self.v = (np.empty(n, np.uint64) for _ in range(3))
        self.ones = np.empty(n, np.uint8)

    def begin(self):
        self.s.fill(_ONES)

    def step(self, codes, kept):
        """Go on with these characters; only the left names' ``kept`` bits may match."""
        s, u, v, rows = self.s, self.u, self.v, self.rows
        for code in codes:
            np.bitwise_and(s, rows[code], u)
            np.bitwise_and(u, kept, u)
            np.add(s, u, v)
            np.subtract(s, u, s)
            np.bitwise_or(s, v, s)

    def some(self, codes, lanes):
        """LCS of these left names alone with the text."""
        kinds, at = np.unique(codes, return_inverse=True)
        rows = self.rows[np.ix_(kinds, lanes)]
        s, u, v = (x[: lanes.size] for x in (self.s, self.u, self.v))
        s.fill(_ONES)
        for k in at.tolist():
            np.bitwise_and(s, rows[k], u)
            np.add(s, u, v)
            np.subtract(s, u, s)
            np.bitwise_or(s, v, s)
        return np.uint8(_BITS) - np.bitwise_count(s)

    def matched(self):
        """LCS with all characters so far."""
        np.bitwise_count(self.s, self.ones)
        return np.uint8(_BITS) - self.ones

    def run(self, codes, each=None):
        """LCS of every left name with the text; zeros left in ``s`` mark its matches.

        ``each(j, s)`` sees the bits after ``j`` characters.
        """
        s, u, v, rows = self.s, self.u, self.v, self.rows
        self.begin()
        for j, code in enumerate(codes.tolist(), 1):
            np.bitwise_and(s, rows[code], u)
            np.add(s, u, v)
            np.subtract(s, u, s)
            np.bitwise_or(s, v, s)
            if each is not None:
                each(j, s)
        return self.matched()


class Bags:
    """Characters that every left name shares with a text, in any order."""

    def __init__(self, strands):
        n = strands.size.size
        owner = np.repeat(np.arange(n), strands.size)
        flat = np.bincount(owner * _CODES + CODE[strands.flat[:-1]], minlength=n * _CODES)
        self.counts = np.ascontiguousarray(flat.reshape(n, _CODES).T.astype(np.uint8))
        self.known = {}

    def run(self, codes):
        out = np.zeros(self.counts.shape[1], np.uint8)
        for code, k in zip(*(x.tolist() for x in np.unique(codes, return_counts=True))):
            k = min(k, _BITS)
            row = self.known.get((code, k))
            if row is None:
                row = self.known[code, k] = np.minimum(self.counts[code], np.uint8(k))
            out += row
        return out


def _by_token(side):
    """Each token's number, the names that hold it, and where among their tokens."""
    owners, at = np.nonzero(side.token >= 0)
    token = side.token[owners, at]
    order = np.argsort(token, kind="stable")
    token, owners, at = token[order], owners[order], at[order]
    first = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if token.size else np.empty(0, int)
    for start, stop in zip(first, np.r_[first[1:], token.size]):
        yield int(token[start]), owners[start:stop], at[start:stop]


class Shared:
    """Length of the tokens every left name shares with a set, each with one space."""

    def __init__(self, side):
        self.n = side.size.size
        self.lists, self.rows = {}, {}
        for key, owners, at in _by_token(side):
            weight = np.uint8(side.token_size[owners[0], at[0]] + 1)
            if owners.size * _DENSE >= self.n:
                row = self.rows[key] = np.zeros(self.n, np.uint8)
                row[owners] = weight
            else:
                self.lists[key] = owners, weight

    def run(self, tokens):
        out = np.zeros(self.n, np.uint8)
        for key in tokens:
            if (row := self.rows.get(key)) is not None:
                out += row
            elif (entry := self.lists.get(key)) is not None:
                out[entry[0]] += entry[1]
        return out


# ------------------------------------------------------------------- windows of given pairs


def _prefixes(pattern, pi, text, ti, width):
    """LCS of each pattern with every prefix of its text: (prefix length, lane)."""
    out = np.zeros((width + 1, len(pi)), np.int16)
    masks, base = pattern.masks(), pi.astype(np.int64) * _CODES
    state = np.full(len(pi), _ONES)
    for j, code in enumerate(CODE[text.gather(ti, width, PAD_B)], 1):
        hit = masks[base + code] & state
        state = (state + hit) | (state - hit)
        out[j] = _BITS - np.bitwise_count(state).astype(np.int16)
    return out


def _bound_run(needle, ni, hay, hi):
    m, n = needle[0].size[ni].astype(np.int64), hay[0].size[hi].astype(np.int64)
    width = int(n.max())
    head = _prefixes(needle[0], ni, hay[0], hi, width)
    tail = _prefixes(needle[1], ni, hay[1], hi, width)
    step = np.arange(width + 1)[:, None]
    # Windows at either end, narrower than the needle.
    ends = np.maximum(head, tail) * np.float32(200) / (m + np.maximum(step, 1)).astype(np.float32)
    best = np.where(step <= m, ends, np.float32(0)).max(axis=0)
    # Full windows [i, i + m): paths of the whole text and of the window cross, so that
    # LCS(window) + LCS(whole) <= LCS(text up to its end) + LCS(text from its start).
    stop = np.minimum(m + step, n)
    inner = np.take_along_axis(head, stop, 0) + np.take_along_axis(tail, np.maximum(n - step, 0), 0)
    inner = np.where(step <= n - m, inner, 0).max(axis=0) - head[n, np.arange(n.size)]
    return np.maximum(best, np.float32(100) * np.minimum(inner, m) / m.astype(np.float32))


def window_bounds(a, ai, b, bi):
    """Upper bound of the partial ratio of each pair; the shorter has at most 64 characters.

    ``a`` and ``b`` are (strands, the same reversed).
    """
    best = np.zeros(len(ai), np.float32)
    la, lb = a[0].size[ai], b[0].size[bi]
    some = (la > 0) & (lb > 0)
    for needle, ni, hay, hi, who in ((a, ai, b, bi, la <= lb), (b, bi, a, ai, lb <= la)):
        at = np.flatnonzero(some & who)
        at = at[np.argsort(hay[0].size[hi[at]], kind="stable")]
        for start in range(0, at.size, _REFINE_LANES):
            run = at[start : start + _REFINE_LANES]
            best[run] = np.maximum(best[run], _bound_run(needle, ni[run], hay, hi[run]))
    return best


class Windows:
    """Which left names may hold a window alike to a right name, or have one in it.

    Every window at an end is counted exactly, windows inside by the whole.  Left names are
    in the order of their size.
    """

    def __init__(self, side, back):
        self.size = side.size.astype(np.int64)
        self.plain, self.back = Masks(side.plain), Masks(back)

    def aim(self, cutoff, strict):
        self.cutoff, self.strict = cutoff, strict
        # No window narrower than this part of the needle reaches the lowest cutoff.
        low = float(cutoff.min(initial=100.0))
        self.part = low / (200 - low)
        self.known = {}

    def _most(self, j):
        """Most ones left after ``j`` characters if a window of them may reach the cutoff."""
        row = self.known.get(j)
        if row is None:
            need = least(self.cutoff * (self.size + np.minimum(j, self.size)) / 200, self.strict)
            row = self.known[j] = (_BITS - np.minimum(need, _BITS + 1).astype(np.int16)).astype(np.int8)
        return row

    def _need(self, n, j):
        """Least count shared by a right name of ``n`` characters and a window of ``j``."""
        row = self.known.get((n, j))
        if row is None:
            row = self.known[n, j] = least(self.cutoff * (n + j) / 200, self.strict)
        return row

    def run(self, codes):
        n = len(codes)
        alive = np.zeros(self.size.size, bool)
        self.whole = np.zeros(self.size.size, np.uint8)
        if not n:
            return (self.cutoff <= 0) & ~self.strict
        needles = int(np.searchsorted(self.size, n, "right"))
        hosts = int(np.searchsorted(self.size, n, "left"))
        widest = np.arange(n + 1) / max(self.part, 1e-9) + 1
        stops = np.minimum(np.searchsorted(self.size, widest, "right"), needles).tolist()
        ones = np.empty(self.size.size, np.uint8)

        def each(j, state):
            if stop := stops[j]:
                np.bitwise_count(state[:stop], ones[:stop])
                alive[:stop] |= ones[:stop].view(np.int8) <= self._most(j)[:stop]

        for masks, text in ((self.plain, codes), (self.back, codes[::-1])):
            self.whole = whole = masks.run(text, each)
            if hosts < self.size.size and n <= _BITS:
                alive[hosts:] |= whole[hosts:] >= self._need(n, n)[hosts:]
                matched = ~masks.s[hosts:]
                # Two widths at a time: what the wider shares, over the narrower's size.
                for j in range(max(1, int(self.part * n)), n, 2):
                    shared = np.bitwise_count(matched & np.uint64((1 << min(j + 1, _BITS)) - 1))
                    alive[hosts:] |= shared >= self._need(n, j)[hosts:]
        return alive


# ----------------------------------------------------------------------- screens by scorer


class SortScreen:
    """Token-sorted ratio, or the plain one: its LCS decides."""

    def __init__(self, a, b, text):
        self.a, self.b, self.text = a, b, text
        self.masks = Masks(getattr(a, text))
        self.codes = getattr(b, text).codes

    def aim(self, cutoff, strict):
        self.cutoff, self.strict, self.known = cutoff, strict, {}

    def alive(self, r):
        n = int(self.b.size[r])
        if (need := self.known.get(n)) is None:
            need = self.known[n] = least(self.cutoff * (self.a.size + n) / 200, self.strict)
        return np.flatnonzero(self.masks.run(self.codes(r)) >= need)


class Rests:
    """LCS of what two token sets leave without their shared tokens, for all left names.

    A space that only separated shared tokens may count, so the result is at most one too
    high.
    """

    def __init__(self, side):
        self.masks, self.n = Masks(side.unique), side.size.size
        self.gone, self.kept = np.empty(self.n, np.uint64), np.empty(self.n, np.uint64)
        self.lists, self.rows = {}, {}
        for key, owners, at in _by_token(side):
            bits = side.token_bits_spaced[owners, at]
            if owners.size * _DENSE >= self.n:
                row, without = np.zeros(self.n, np.uint64), np.full(self.n, _ONES)
                row[owners], without[owners] = bits, 0
                self.rows[key] = row, without
            else:
                self.lists[key] = owners, bits

    def run(self, words, tokens):
        """``words``: the right name's distinct words in order; ``tokens``: their numbers."""
        masks, gone, kept = self.masks, self.gone, self.kept
        gone.fill(0)
        for key in tokens:
            if (row := self.rows.get(key)) is not None:
                gone |= row[0]
            elif (entry := self.lists.get(key)) is not None:
                gone[entry[0]] |= entry[1]
        np.invert(gone, gone)
        masks.begin()
        for k, (word, key) in enumerate(zip(words, tokens)):
            codes = CODE[np.frombuffer(((" " if k else "") + word).encode("latin-1"), np.uint8)].tolist()
            if (row := self.rows.get(key)) is not None:
                masks.step(codes, np.bitwise_and(gone, row[1], kept))
            elif (entry := self.lists.get(key)) is not None:
                saved = gone[entry[0]]
                gone[entry[0]] = 0
                masks.step(codes, gone)
                gone[entry[0]] = saved
            else:
                masks.step(codes, gone)
        return masks.matched()


class SetScreen:
    """Token-set ratio: shared tokens, then what the rest can share."""

    def __init__(self, a, b):
        self.a, self.b = a, b
        self.rests, self.shared = Rests(a), Shared(a)
        self.unique = a.unique.size.astype(np.int64)

    def aim(self, cutoff, strict):
        self.cutoff, self.strict, self.known = cutoff, strict, {}

    def alive(self, r):
        u = int(self.b.unique.size[r])
        if (needs := self.known.get(u)) is None:
            short = np.minimum(self.unique, u)
            alone = self.cutoff * short / (200 - self.cutoff)
            needs = self.known[u] = (
                short.astype(np.uint8),
                least(self.cutoff * (self.unique + u) / 200, self.strict),
                np.maximum(least(alone + 1, self.strict), 1),
            )
        short, need, need_shared = needs
        tokens = self.b.tokens(r)
        shared = self.shared.run(tokens)
        most = np.minimum(self.rests.run(self.b.words[r], tokens) + shared, short)
        return np.flatnonzero((most >= need) | (shared >= need_shared))


def sure_counts(a, b, top_n, far):
    """For each left name, right names of unlike length, but not far so, that share a token.

    They are counted up to about ``top_n``; a shared token settles their scores.  The right names of the most unlike
    lengths are looked at, until the left names they can settle have enough.
    """
    size, shared = a.size.astype(np.int64), Shared(a)
    count = np.zeros(size.size, np.int64)
    order = np.argsort(b.size, kind="stable")
    for shorter, ids in ((True, order), (False, order[::-1])):
        for r in ids.tolist():
            n = int(b.size[r])
            if not n:
                continue
            if shorter:
                who = (2 * size >= 3 * n) & (size <= far * n)
                open_ = who.any() and (count[2 * size >= 3 * n] < top_n).any()
            else:
                who = (2 * n >= 3 * size) & (n <= far * size)
                open_ = who.any() and (count[who] < top_n).any()
            if not open_:
                if not shorter or 2 * int(size[-1]) < 3 * n:
                    break
                continue
            count += who & (shared.run(b.tokens(r)) > 0)
    return count


class WeightedScreen:
    """Weighted scorer, or the larger of it and the partial ratio.

    Where cutoffs are high, shared characters rule out nearly all token terms and most of the
    rest: an LCS, never longer than they are many, is taken of the names they leave.  ``close``
    is for low cutoffs: sorted names, rests of token sets and windows are looked at instead.
    """

    def __init__(self, a, b, back, close, ensemble, token, partial, far_partial, far):
        self.a, self.b, self.close, self.ensemble = a, b, close, ensemble
        self.token, self.partial, self.far_partial, self.far = token, partial, far_partial, far
        self.shared = Shared(a)
        self.windows = Windows(a, back) if close and ensemble else None
        self.plain = self.windows.plain if self.windows else Masks(a.plain)
        self.sorted = Masks(a.sorted)
        if close:
            self.rests = Rests(a)
        else:
            self.bags = Bags(a.plain)
        self.size, self.unique = a.size.astype(np.int64), a.unique.size.astype(np.int64)

    def aim(self, cutoff, strict):
        self.cutoff, self.strict, self.known = cutoff, strict, {}
        if self.windows:
            self.windows.aim(cutoff, np.zeros(cutoff.size, bool))

    def _needs(self, n, u):
        cutoff, any_tie = self.cutoff, np.bool_(False)
        short, long = np.minimum(self.size, n), np.maximum(self.size, n)
        alike = (short > 0) & (2 * long < 3 * short)
        weight = np.where(long <= self.far * short, self.partial, self.far_partial)
        plain = cutoff * (self.size + n) / 200
        own = cutoff if self.ensemble else cutoff / weight
        window = own * short / (200 - own)
        if not self.ensemble:
            window = np.where(alike, 255, window)
        if not self.windows:
            plain = np.minimum(plain, window)
        few = np.minimum(self.unique, u)
        token = cutoff / self.token
        far_token = token / weight
        token_set = token * (self.unique + u) / 200
        # Sorted names, then their windows; without a close look token sets as well.
        whole = token * (self.size + n) / 200 if self.close else token_set
        # One shared token settles names of unlike length, and no other token term scores
        # more; a later tie changes nothing.
        settled = 100.0 * self.token * weight
        settled = np.where(self.strict, settled > cutoff, settled >= cutoff)
        mixed = np.where(alike, whole, np.where(settled, far_token * few / (200 - far_token), 255))
        share = np.where(alike, least(token * few / (200 - token) + 1, any_tie), np.where(settled, 1, 255))
        return (
            least(plain, any_tie),
            least(mixed, any_tie),
            np.maximum(share, 1).astype(np.uint8),
            least(np.where(alike, token_set, 255), any_tie),
            few.astype(np.uint8),
        )

    def alive(self, r):
        """Left names whose pair is open."""
        key = int(self.b.size[r]), int(self.b.unique.size[r])
        if (needs := self.known.get(key)) is None:
            needs = self.known[key] = self._needs(*key)
        plain, mixed, share, token_set, few = needs
        codes, tokens = self.b.plain.codes(r), self.b.tokens(r)
        shared = self.shared.run(tokens)
        out = shared >= share
        if not self.close:
            return self._left_by_characters(r, codes, shared, out, plain, mixed)
        if self.windows:
            out |= self.windows.run(codes)
            out |= self.windows.whole >= plain
        else:
            out |= self.plain.run(codes) >= plain
        out |= self.sorted.run(self.b.sorted.codes(r)) >= mixed
        out |= np.minimum(self.rests.run(self.b.words[r], tokens) + shared, few) >= token_set
        return np.flatnonzero(out)

    def _left_by_characters(self, r, codes, shared, out, plain, mixed):
        """Left names that shared characters leave open, and then the LCS as it is or of sorted names.

        The rests of token sets share no more than sorted names.
        """
        common = self.bags.run(codes)
        at = np.flatnonzero(~out & (common >= plain))
        if at.size:
            out[at] = self.plain.some(codes, at) >= plain[at]
        at = np.flatnonzero(~out & (common >= mixed))
        if at.size:
            n, u = int(self.b.size[r]), int(self.b.unique.size[r])
            size, unique = self.size[at], self.unique[at]
            same = self.sorted.some(self.b.sorted.codes(r), at).astype(np.int64)
            most = np.minimum(same + shared[at], np.minimum(unique, u))
            token = np.maximum(200 * same / np.maximum(size + n, 1), 200 * most / np.maximum(unique + u, 1))
            apart = 2 * np.maximum(size, n) >= 3 * np.minimum(size, n)
            out[at] = apart | (self.token * token + 1e-6 >= self.cutoff[at])
        return np.flatnonzero(out)


class PartialScreen:
    """Partial ratio: windows."""

    def __init__(self, a, b, back):
        self.b, self.windows = b, Windows(a, back)

    def aim(self, cutoff, strict):
        self.windows.aim(cutoff, strict)

    def alive(self, r):
        return np.flatnonzero(self.windows.run(self.b.plain.codes(r)))
