"""Scores of name pairs (0-100) and cheap upper bounds for them, used inside tasks.

Names must already be normalised: lower-case ASCII words separated by single spaces.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

from .lanes import ALPHABET, CODE, Strands, lcs, lcs_kept, windows
from .screen import PartialScreen, SetScreen, SortScreen, WeightedScreen, sure_counts, window_bounds

# Fixed values of the weighted scorer.
TOKEN_WEIGHT = 0.95
PARTIAL_WEIGHT = 0.9
FAR_PARTIAL_WEIGHT = 0.6
FAR_LENGTH_RATIO = 8

_KINDS = len(ALPHABET) + 1
_SPACE = int(CODE[ord(" ")])
# Token matrices are padded to the longest name: their most cells, and the most token
# comparisons of a pair that are made one by one.
_TOKEN_CELLS = 1 << 20
_FEW_TOKENS = 1 << 12
# Pairs scored before the first look at which others still matter.
_FIRST_PAIRS = 1 << 15
# Left names of at most so many characters, so many of them at least, are screened together.
SCREEN_SIZE = 64
_SCREEN_NAMES = 64
# Pairs that pass a screen are scored together.
_SCREEN_PAIRS = 1 << 16
# Scorers that compare windows.
_WINDOWED = "partial_ratio", "WRatio", "ensemble"
# From this cutoff on, shared characters rule out most pairs of the weighted scorer.
_HIGH_CUTOFF = 76.0
# Sides of the matrices in which all other pairs are bounded.
_BLOCK = 1024, 4096
# Bounds are kept in single precision; pairs this close to a cutoff are still scored.
SLACK = 1e-3


def _bit_range(start, stop):
    """Bits start..stop-1; positions from 64 on have none."""
    start, stop = (np.clip(x, 0, 64).astype(np.uint64) for x in (start, stop))
    below = lambda n: np.where(n >= 64, ~np.uint64(0), (np.uint64(1) << (n % np.uint64(64))) - np.uint64(1))
    return below(stop) & ~below(start)


class NameSide:
    """One side of a comparison: the names as given, token-sorted, and as token sets."""

    def __init__(self, names, vocabulary):
        words = [n.split(" ") if n else [] for n in names]
        unique = [sorted(set(w)) for w in words]
        self.plain = Strands(names)
        self.sorted = Strands([" ".join(sorted(w)) for w in words])
        self.words = unique
        self.unique = Strands([" ".join(u) for u in unique])
        self.size = self.plain.size
        self.letters = np.array([sum(map(len, w)) for w in words], np.int32)
        self.repeats = self.sorted.size != self.unique.size
        self.n_tokens = np.fromiter(map(len, unique), np.int32, len(unique))
        width = max(1, int(self.n_tokens.max(initial=0)))
        self.token = np.full((len(names), width), -1, np.int32)
        self.token_size = np.zeros((len(names), width), np.int32)
        for row, tokens in enumerate(unique):
            for k, word in enumerate(tokens):
                self.token[row, k] = vocabulary.setdefault(word, len(vocabulary))
                self.token_size[row, k] = len(word)
        # Bits of each unique token in the joined string, without and with the space before.
        stop = np.cumsum(np.where(self.token >= 0, self.token_size + 1, 0), axis=1) - 1
        self.token_bits = _bit_range(stop - self.token_size, stop)
        self.token_bits_spaced = _bit_range(np.maximum(stop - self.token_size - 1, 0), stop)

    def tokens(self, i):
        """Numbers of one name's distinct tokens."""
        return self.token[i, : self.n_tokens[i]].tolist()

    def char_counts(self):
        """Occurrences of each character code per name."""
        owner = np.repeat(np.arange(self.size.size), self.size)
        return self._count(owner, CODE[self.plain.flat[:-1]], _KINDS)

    def pair_counts(self):
        """Occurrences of each pair of neighbouring characters inside a word, per name."""
        code = CODE[self.plain.flat[:-1]].astype(np.int64)
        owner = np.repeat(np.arange(self.size.size), self.size)
        letter = code != _SPACE
        inside = letter[:-1] & letter[1:] & (owner[:-1] == owner[1:])
        pairs = (code[:-1] * _KINDS + code[1:])[inside]
        return self._count(owner[:-1][inside], pairs, _KINDS**2)

    def _count(self, owner, code, kinds):
        flat = np.bincount(owner * kinds + code, minlength=self.size.size * kinds)
        return flat.reshape(self.size.size, kinds).astype(np.float32)


def two_sides(left, right):
    vocabulary: dict[str, int] = {}
    return NameSide(left, vocabulary), NameSide(right, vocabulary)


# ---------------------------------------------------------------- scores of given pairs


def _ratio(common, la, lb):
    total = la + lb
    return np.where(total > 0, 200.0 * common / np.maximum(total, 1), 0.0)


def _shared_tokens(a, ai, b, bi):
    """Per pair: which tokens of either side the other has too (two boolean matrices)."""
    ta, tb = a.token[ai], b.token[bi]
    hit_a = np.zeros(ta.shape, bool)
    hit_b = np.zeros(tb.shape, bool)
    if ta.shape[1] * tb.shape[1] > _FEW_TOKENS:  # texts rather than names
        for row in range(len(ai)):
            hit_a[row] = np.isin(ta[row], tb[row]) & (ta[row] >= 0)
            hit_b[row] = np.isin(tb[row], ta[row]) & (tb[row] >= 0)
        return hit_a, hit_b
    for k in range(tb.shape[1]):
        same = (ta == tb[:, k, None]) & (ta >= 0)
        hit_a |= same
        hit_b[:, k] = same.any(axis=1)
    return hit_a, hit_b


def _joined_size(sizes, kept):
    """Characters of the kept tokens joined by single spaces."""
    count = kept.sum(axis=1)
    return np.where(kept, sizes, 0).sum(axis=1) + np.maximum(count - 1, 0), count


def _rest(side, ids, shared):
    """Bits of the unique tokens that are not shared, joined by single spaces."""
    kept = ~shared & (side.token[ids] >= 0)
    bits = np.where(kept, side.token_bits_spaced[ids], np.uint64(0))
    first = np.argmax(kept, axis=1)[:, None]
    lead = np.take_along_axis(side.token_bits[ids], first, axis=1)
    np.put_along_axis(bits, first, np.where(kept.any(axis=1)[:, None], lead, np.uint64(0)), axis=1)
    return np.bitwise_or.reduce(bits, axis=1)


def _rest_text(side, ids, shared):
    """The same as strings, for names too long for bits."""
    kept = ~shared & (side.token[ids] >= 0)
    return Strands([" ".join(side.words[i][k] for k in np.flatnonzero(row)) for i, row in zip(ids, kept)])


def _rest_lcs(a, ai, b, bi, shared_a, shared_b):
    """LCS of what remains of each pair's token sets without the shared tokens."""
    out = np.zeros(len(ai), np.int64)
    fits = (a.unique.size[ai] <= 64) & (b.unique.size[bi] <= 64)
    at = np.flatnonzero(fits)
    if at.size:
        rest_a, rest_b = _rest(a, ai[at], shared_a[at]), _rest(b, bi[at], shared_b[at])
        out[at] = lcs_kept(a.unique, ai[at], b.unique, bi[at], rest_a, rest_b)
    at = np.flatnonzero(~fits)
    if at.size:
        every = np.arange(at.size)
        left, right = _rest_text(a, ai[at], shared_a[at]), _rest_text(b, bi[at], shared_b[at])
        out[at] = lcs(left, every, right, every)
    return out


def _token_set(a, ai, b, bi, shared_a, shared_b, goal=None, bag=None):
    """Token-set score of pairs; the sides' shared-token matrices are given.

    With a ``goal`` per pair, scores that cannot exceed it may come back too low.
    """
    na, nb = a.n_tokens[ai].astype(np.int64), b.n_tokens[bi].astype(np.int64)
    s, n_common = _joined_size(a.token_size[ai], shared_a)
    alive = (na > 0) & (nb > 0)
    subset = alive & (n_common > 0) & ((n_common == na) | (n_common == nb))
    size_a, size_b = a.unique.size[ai].astype(np.int64), b.unique.size[bi].astype(np.int64)
    gap = (s > 0).astype(np.int64)
    la, lb = size_a - s - gap, size_b - s - gap
    total = np.maximum(2 * (s + gap) + la + lb, 1)
    out = np.where(alive & (s > 0), 200.0 * s / np.maximum(s + np.minimum(s + gap + la, s + gap + lb), 1), 0.0)
    out[subset] = 100.0
    alive &= ~subset
    if goal is not None:
        most = np.minimum(la, lb)
        if bag is not None:
            # Shared tokens use up their characters; spaces between the others may match.
            plain = ~(a.repeats[ai] | b.repeats[bi])
            letters = bag - np.minimum(na, nb) + 1 - (s - np.maximum(n_common - 1, 0))
            rest = letters + np.minimum(na, nb) - n_common - 1
            most = np.where(plain, np.minimum(most, rest), most)
        alive &= 200.0 * (s + gap + most) / total + SLACK >= np.maximum(goal, out)
    at = np.flatnonzero(alive)
    if at.size:
        common = _rest_lcs(a, ai[at], b, bi[at], shared_a[at], shared_b[at])
        out[at] = np.maximum(out[at], 200.0 * (s[at] + gap[at] + common) / total[at])
    return out


def _token_sort(a, ai, b, bi):
    return _ratio(lcs(a.sorted, ai, b.sorted, bi), a.size[ai], b.size[bi])


def _far_weight(short, long):
    return np.where(long <= FAR_LENGTH_RATIO * short, PARTIAL_WEIGHT, FAR_PARTIAL_WEIGHT)


def _raise(score, at, values):
    score[at] = np.maximum(score[at], values)


def _weighted(ensemble, a, ai, b, bi, floor, overlap, lift):
    """Weighted scorer, or the larger of it and the partial ratio.

    Terms whose bound lies below ``floor`` or below the pair's other terms are skipped.
    """
    la, lb = a.size[ai].astype(np.int64), b.size[bi].astype(np.int64)
    short, long = np.minimum(la, lb), np.maximum(la, lb)
    some = short > 0
    alike = some & (2 * long < 3 * short)
    apart = some & ~alike
    weight = _far_weight(short, long)
    shared_a, shared_b = _shared_tokens(a, ai, b, bi)
    share = shared_a.any(axis=1)
    repeats = a.repeats[ai] | b.repeats[bi]
    score = np.where(apart & share, 100.0 * TOKEN_WEIGHT * weight, 0.0)

    def worth(who, bound):
        return np.flatnonzero(who & (bound + SLACK >= np.maximum(score, floor)))

    # Sorting the tokens keeps both bounds.
    ratio_bound = 200.0 * overlap.whole / np.maximum(la + lb, 1)
    window_bound = 200.0 * overlap.window / np.maximum(short + overlap.window, 1)

    at = worth(alike & share, TOKEN_WEIGHT * 100.0)
    if at.size:
        goal = np.maximum(score, floor)[at] / TOKEN_WEIGHT
        token = _token_set(a, ai[at], b, bi[at], shared_a[at], shared_b[at], goal, overlap.chars[at])
        _raise(score, at, TOKEN_WEIGHT * token)
    at = np.flatnonzero(alike & ~share & repeats)
    if at.size:
        token = _token_set(a, ai[at], b, bi[at], shared_a[at], shared_b[at])
        _raise(score, at, TOKEN_WEIGHT * token)

    at = worth(some, ratio_bound) if not ensemble else worth(some, np.maximum(ratio_bound, window_bound))
    if at.size:
        common = lcs(a.plain, ai[at], b.plain, bi[at])
        _raise(score, at, _ratio(common, la[at], lb[at]))
        # No window shares more than the whole.
        within = np.minimum(overlap.window[at], common)
        window_bound[at] = 200.0 * within / np.maximum(short[at] + within, 1)
    # Alike names have all their cheap terms by now; windows are the costly part.
    at = worth(alike, ratio_bound * TOKEN_WEIGHT)
    if at.size:
        _raise(score, at, TOKEN_WEIGHT * _token_sort(a, ai[at], b, bi[at]))
    if lift is not None:
        floor = lift(score)
    own = np.ones(len(ai)) if ensemble else weight
    at = worth(some if ensemble else apart, window_bound * own)
    if at.size:
        _, partial = windows(a.plain, ai[at], b.plain, bi[at])
        _raise(score, at, partial * own[at])
    mixed = overlap.window if overlap.mixed is None else overlap.mixed
    sorted_bound = 200.0 * mixed / np.maximum(short + mixed, 1)
    at = worth(apart & ~share, sorted_bound * TOKEN_WEIGHT * weight)
    if at.size:
        _, best = windows(a.sorted, ai[at], b.sorted, bi[at])
        _raise(score, at, best * TOKEN_WEIGHT * weight[at])
    at = np.flatnonzero(apart & ~share & repeats)
    if at.size:
        _, best = windows(a.unique, ai[at], b.unique, bi[at])
        _raise(score, at, best * TOKEN_WEIGHT * weight[at])
    return score


def score_pairs(scorer, a, ai, b, bi, floor=0.0, overlap=None, lift=None):
    """Score pairs (a[ai], b[bi]).

    Pairs scoring below ``floor`` may come back with any value below it.  ``overlap`` holds
    the pairs' bounds when known; they let hopeless terms be skipped.  ``lift`` may turn
    the scores known so far, never above the final ones, into a higher floor.
    """
    la, lb = a.size[ai].astype(np.int64), b.size[bi].astype(np.int64)
    if scorer == "ratio":
        return _ratio(lcs(a.plain, ai, b.plain, bi), la, lb)
    if scorer == "token_sort_ratio":
        return _token_sort(a, ai, b, bi)
    if scorer == "token_set_ratio":
        shared = _shared_tokens(a, ai, b, bi)
        if overlap is None:
            return _token_set(a, ai, b, bi, *shared)
        return _token_set(a, ai, b, bi, *shared, np.broadcast_to(floor, la.shape), overlap.chars)
    if scorer == "partial_ratio":
        return windows(a.plain, ai, b.plain, bi)[1]
    if scorer in ("WRatio", "ensemble"):
        if overlap is None:
            overlap = Overlap(*[np.minimum(la, lb)] * 3)
        return _weighted(scorer == "ensemble", a, ai, b, bi, floor, overlap, lift)
    raise ValueError(f"unknown scorer {scorer!r}")


# ------------------------------------------------------- bounds for all pairs of a tile


def _shared_counts(ca, cb, levels):
    """Sum of the smaller counts of every pair of rows, or a little more.

    Counts up to ``levels`` are written as ones, so a matrix product sums their minima.
    """
    used = np.flatnonzero(ca.any(axis=0) & cb.any(axis=0))
    ca, cb = ca[:, used], cb[:, used]
    step = np.arange(1, levels + 1, dtype=np.float32)
    ones = [(c[:, :, None] >= step).reshape(len(c), -1) for c in (ca, cb)]
    busy = np.flatnonzero(ones[0].any(axis=0) & ones[1].any(axis=0))
    shared = ones[0][:, busy].astype(np.float32) @ ones[1][:, busy].astype(np.float32).T
    rest_a, rest_b = (np.maximum(c - levels, 0).sum(axis=1) for c in (ca, cb))
    if rest_a.any() and rest_b.any():
        shared += np.minimum(rest_a[:, None], rest_b[None, :])
    return shared


class Overlap(NamedTuple):
    """Upper bounds for every pair of a tile, or for chosen pairs.

    ``chars``: shared characters.  ``whole``: LCS of the names, in any token order.
    ``window``: LCS of the shorter name with a window no wider than itself, if the score
    of that window is to be the best.  ``mixed``: the same in any token order, where
    ``window`` holds for the names' own order only.
    """

    chars: np.ndarray
    whole: np.ndarray
    window: np.ndarray
    mixed: np.ndarray | None = None

    def at(self, li, ri):
        return Overlap(*(x[li, ri] for x in self if x is not None))


def overlaps(a, b):
    """Bounds from shared characters and shared neighbouring pairs of characters.

    A common subsequence of L characters of two strings of m and w leaves m + w - 2L out,
    so it breaks into at most that many runs plus one, and all neighbours within a run are
    shared pairs: L <= (pairs + m + w + 1) / 3.  The best window leaves no hay character
    out when w = L, which gives L <= (pairs + m + 1) / 2.  Pairs with a space depend on the
    token order; there are at most two per space.
    """
    chars = _shared_counts(a.char_counts(), b.char_counts(), 8)
    pairs = _shared_counts(a.pair_counts(), b.pair_counts(), 2)
    la, lb = a.size[:, None].astype(np.float32), b.size[None, :].astype(np.float32)
    spaces = [x.sorted.size - x.letters for x in (a, b)]
    pairs += 2 * np.minimum(spaces[0][:, None], spaces[1][None, :]).astype(np.float32)
    whole = np.minimum(chars, (pairs + la + lb + 1) / 3)
    window = np.minimum(chars, (pairs + np.minimum(la, lb) + 1) / 2)
    return Overlap(chars, whole, window)


def _share_matrix(a, b):
    """Which pairs of a tile have a token in common."""
    share = np.zeros((a.size.size, b.size.size), bool)
    owners = {}
    for row, k in zip(*np.nonzero(a.token >= 0)):
        owners.setdefault(int(a.token[row, k]), ([], []))[0].append(row)
    for row, k in zip(*np.nonzero(b.token >= 0)):
        if (entry := owners.get(int(b.token[row, k]))) is not None:
            entry[1].append(row)
    for rows, columns in owners.values():
        if columns:
            share[np.ix_(rows, columns)] = True
    return share


def score_bounds(scorer, a, b, overlap):
    """Upper bound of the score of every pair of a tile, from lengths, characters, tokens.

    Also returns which pairs are settled: a shared token fixes the score of names of
    unlike length unless their windows could score more, so it equals the bound.
    """
    la, lb = a.size[:, None].astype(np.float32), b.size[None, :].astype(np.float32)
    settled = np.zeros(overlap.chars.shape, bool)
    ratio = 200 * overlap.whole / np.maximum(la + lb, 1)
    if scorer in ("ratio", "token_sort_ratio"):
        return ratio, settled
    short = np.minimum(la, lb)
    partial = 200 * overlap.window / np.maximum(short + overlap.window, 1)
    if scorer == "partial_ratio":
        return partial, settled
    share = _share_matrix(a, b)
    # Repeated tokens are dropped in token sets, which may raise the score.
    open_set = share | a.repeats[:, None] | b.repeats[None, :]
    token_set = np.where(open_set, 100, ratio).astype(np.float32)
    if scorer == "token_set_ratio":
        return token_set, settled
    long = np.maximum(la, lb)
    apart = 2 * long >= 3 * short
    weight = _far_weight(short, long).astype(np.float32)
    windows_bound = partial if scorer == "ensemble" else weight * partial
    other = np.maximum(ratio, windows_bound)
    token = np.where(open_set, np.float32(100 * TOKEN_WEIGHT), TOKEN_WEIGHT * partial) * weight
    near = TOKEN_WEIGHT * token_set
    bound = np.maximum(other, np.where(apart, token, near))
    settled = apart & share & (short > 0) & (other + np.float32(SLACK) < token)
    return bound, settled


def _first_per_row(rows, count, n_rows):
    """Marks the first ``count`` entries of every value in the ascending array ``rows``."""
    first = np.searchsorted(rows, np.arange(n_rows))
    return np.arange(rows.size) - first[rows] < count


def _runs(names, chosen, most=None):
    """Runs of the chosen names, split where padding to the longest would cost too much.

    No run holds more than ``most`` names.
    """
    if not chosen.size:
        return []
    tokens = np.array([names[i].count(" ") + 1 for i in chosen])
    most = most or tokens.size
    if tokens.size <= most and tokens.size * tokens.max() <= _TOKEN_CELLS:
        return [chosen]
    runs, start = [], 0
    order = np.argsort(tokens, kind="stable")
    for stop in range(1, order.size + 1):
        if stop == order.size or stop - start == most or (stop - start + 1) * tokens[order[stop]] > _TOKEN_CELLS:
            runs.append(chosen[np.sort(order[start:stop])])
            start = stop
    return runs


def best_pairs(scorer, left, right, threshold, top_n, apart_only=False, sure=None):
    """Each left name's ``top_n`` best right names scoring at least ``threshold``.

    Ties go to the right name listed first.  Returns (left index, right index, score).
    With ``apart_only``, pairs of alike length (the longer below 1.5 times the shorter, both
    not empty) are left out: they are scored elsewhere.  ``sure`` marks left names that have
    ``top_n`` right names, here or elsewhere, whose weighted scores a shared token settles
    (``sure_counts``); of those, lower scores may be left out.
    """
    found = []
    size = np.fromiter(map(len, left), np.int64, len(left))
    easy = (size > 0) & (size <= SCREEN_SIZE)
    if apart_only or easy.sum() < _SCREEN_NAMES:
        easy[:] = False
    runs = [(li, _screened_pairs) for li in _runs(left, np.flatnonzero(easy))]
    runs += [(li, _best_pairs) for li in _runs(left, np.flatnonzero(~easy), _BLOCK[0])]
    for li, best in runs:
        for ri in _runs(right, np.arange(len(right)), None if best is _screened_pairs else _BLOCK[1]):
            names = [left[i] for i in li], [right[i] for i in ri]
            extra = apart_only if best is _best_pairs else None if sure is None else sure[li]
            l, r, s = best(scorer, *names, threshold, top_n, extra)
            found.append((li[l], ri[r], s))
    if len(found) == 1:
        return found[0]
    l, r, s = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((r, -s, l))
    l, r, s = l[order], r[order], s[order]
    stay = _first_per_row(l, top_n, len(left))
    return l[stay], r[stay], s[stay]


def _merged(kept, more, top_n, n_left, cutoff):
    """Best pairs so far with more of them; raises the cutoffs of names that have ``top_n``."""
    l, r, v = (np.concatenate(x) for x in zip(kept, more))
    order = np.lexsort((r, -v, l))
    l, r, v = l[order], r[order], v[order]
    stay = _first_per_row(l, top_n, n_left)
    l, r, v = l[stay], r[stay], v[stay]
    last = np.flatnonzero(~_first_per_row(l, top_n - 1, n_left))
    cutoff[l[last]] = np.maximum(cutoff[l[last]], v[last])
    return (l, r, v), l[last]


def _lift(li, cutoff, top_n):
    """Turns scores of pairs known so far into a floor: a name's last kept one can only be higher."""

    def lift(s):
        order = np.lexsort((-s, li))
        last = np.searchsorted(li, np.arange(cutoff.size)) + top_n - 1
        full = last < np.searchsorted(li, np.arange(cutoff.size), "right")
        floor = cutoff.copy()
        floor[full] = np.maximum(floor[full], s[order[last[full]]])
        return floor[li]

    return lift


def _screen(scorer, a, b, back, close):
    if scorer in ("ratio", "token_sort_ratio"):
        return SortScreen(a, b, "plain" if scorer == "ratio" else "sorted")
    if scorer == "token_set_ratio":
        return SetScreen(a, b)
    if scorer == "partial_ratio":
        return PartialScreen(a, b, back)
    weights = TOKEN_WEIGHT, PARTIAL_WEIGHT, FAR_PARTIAL_WEIGHT, FAR_LENGTH_RATIO
    return WeightedScreen(a, b, back, close, scorer == "ensemble", *weights)


def _screened_pairs(scorer, left, right, threshold, top_n, sure=None):
    """``best_pairs`` of left names of at most 64 characters.

    Right names are met in their order, each by all left names at once; only pairs whose
    counts may reach the left name's cutoff are scored.  A right name that ties with a left
    name's last kept one comes after it, so it is passed over where ties are exact.
    """
    by_size = np.argsort(np.fromiter(map(len, left), np.int64, len(left)), kind="stable")
    left = [left[i] for i in by_size]
    if scorer not in ("WRatio", "ensemble"):
        groups = [(np.arange(len(left)), float(threshold), False)]
    else:
        if sure is None:
            sure = sure_counts(*two_sides(left, right), top_n, FAR_LENGTH_RATIO) >= top_n
        else:
            sure = sure[by_size]
        value = max(float(threshold), 100.0 * TOKEN_WEIGHT * PARTIAL_WEIGHT)
        close = threshold < _HIGH_CUTOFF
        groups = [(np.flatnonzero(sure), value, False), (np.flatnonzero(~sure), float(threshold), close)]
    found = []
    for who, floor, close in groups:
        if who.size:
            l, r, s = _screened(scorer, [left[i] for i in who], right, floor, top_n, close)
            found.append((by_size[who[l]], r, s))
    l, r, s = (np.concatenate(x) for x in zip(*found))
    order = np.argsort(l, kind="stable")
    return l[order], r[order], s[order]


def _screened(scorer, left, right, threshold, top_n, close):
    """``_screened_pairs`` of left names in the order of their size and alike in cutoff."""
    a, b = two_sides(left, right)
    back = [Strands([n[::-1] for n in side]) for side in (left, right) if scorer in _WINDOWED] or [None]
    screen = _screen(scorer, a, b, back[0], close)
    n_left = len(left)
    cutoff, full = np.full(n_left, threshold, np.float64), np.zeros(n_left, bool)
    kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    waiting, n_waiting = [], 0

    def score_waiting():
        nonlocal kept, waiting, n_waiting
        li = np.concatenate([x for x, _ in waiting])
        ri = np.repeat(np.array([r for _, r in waiting], np.int64), [x.size for x, _ in waiting])
        order = np.argsort(li, kind="stable")
        li, ri = li[order], ri[order]
        stay = slice(None)
        if scorer == "partial_ratio" and full.any():
            bound = window_bounds((a.plain, back[0]), li, (b.plain, back[1]), ri)
            stay = bound + SLACK >= cutoff[li]
        li, ri = li[stay], ri[stay]
        waiting, n_waiting = [], 0
        short = np.minimum(a.size[li], b.size[ri]).astype(np.float32)
        window = short.copy()
        if scorer in ("WRatio", "ensemble"):
            apart = 2 * np.maximum(a.size[li], b.size[ri]) >= 3 * short
            at = np.flatnonzero(apart | (scorer == "ensemble"))
            bound = window_bounds((a.plain, back[0]), li[at], (b.plain, back[1]), ri[at])
            window[at] = bound * short[at] / (200 - bound)
        overlap = Overlap(short, short, window, short)
        s = score_pairs(scorer, a, li, b, ri, cutoff[li], overlap, _lift(li, cutoff, top_n))
        good = s >= cutoff[li]
        kept, done = _merged(kept, (li[good], ri[good], s[good]), top_n, n_left, cutoff)
        full[done] = True
        screen.aim(cutoff, full)

    screen.aim(cutoff, full)
    for r in range(len(right)):
        li = screen.alive(r)
        if li.size:
            waiting.append((li, r))
            n_waiting += li.size
            if n_waiting >= _SCREEN_PAIRS:
                score_waiting()
    if waiting:
        score_waiting()
    return kept


def _best_pairs(scorer, left, right, threshold, top_n, apart_only=False):
    """``best_pairs`` of one run of names per side.

    Pairs are scored in the order of their bounds; once a left name has ``top_n`` scores,
    pairs whose bound lies below the last of them are never scored.
    """
    a, b = two_sides(left, right)
    overlap = overlaps(a, b)
    bound, settled = score_bounds(scorer, a, b, overlap)
    if apart_only:
        la, lb = a.size[:, None].astype(np.int64), b.size[None, :].astype(np.int64)
        alike = (np.minimum(la, lb) > 0) & (2 * np.maximum(la, lb) < 3 * np.minimum(la, lb))
        settled &= ~alike
        bound = np.where(alike, np.float32(-1), bound)
    n_left, n_right = bound.shape
    cutoff = np.full(n_left, threshold, np.float64)
    kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))

    def keep(li, ri, s):
        nonlocal kept
        kept, _ = _merged(kept, (li, ri, s), top_n, n_left, cutoff)

    if settled.any():
        for near in (True, False):
            within = b.size[None, :] <= FAR_LENGTH_RATIO * a.size[:, None]
            within &= a.size[:, None] <= FAR_LENGTH_RATIO * b.size[None, :]
            value = 100.0 * TOKEN_WEIGHT * (PARTIAL_WEIGHT if near else FAR_PARTIAL_WEIGHT)
            if value >= threshold:
                li, ri = np.nonzero(settled & (within if near else ~within))
                some = _first_per_row(li, top_n, n_left)
                keep(li[some], ri[some], np.full(int(some.sum()), value))
    bound += np.float32(SLACK)
    todo = ~settled & (bound >= cutoff[:, None])
    batch = max(2 * top_n, _FIRST_PAIRS // n_left)
    while True:
        if n_right > batch:
            ranked = np.where(todo, bound, np.float32(-1))
            pick = np.argpartition(-ranked, batch - 1, axis=1)[:, :batch]
            li = np.repeat(np.arange(n_left), batch)
            ri = pick.ravel()
            live = todo[li, ri]
            li, ri = li[live], ri[live]
        else:
            li, ri = np.nonzero(todo)
        if not li.size:
            return kept
        todo[li, ri] = False

        s = score_pairs(scorer, a, li, b, ri, cutoff[li], overlap.at(li, ri), _lift(li, cutoff, top_n))
        good = s >= cutoff[li]
        keep(li[good], ri[good], s[good])
        todo &= bound >= cutoff[:, None]
        batch *= 8
