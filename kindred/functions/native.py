"""Scorers as Spark Columns: no Python runs when they are evaluated.

``ratio``, ``token_sort_ratio`` and ``token_set_ratio`` of normalised names (single
spaces between words).  The longest common subsequence is found bit-parallel: the
shorter string is written as bit masks per character, in words of 62 bits so that a
bigint sum never overflows, and the longer string is run through them with
``aggregate``.  A carry passes the sum from word to word, so names of any length work.

Per-name features (masks, sorted words, word sets) are Columns of their own, so a table
of distinct names can hold them once and every pair reuses them.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 62
FULL = (1 << BITS) - 1


def chars(s: Column) -> Column:
    """The characters of ``s`` as an array; empty for ""."""
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, ""))


def words(s: Column) -> Column:
    """Words between single spaces; none for ""."""
    return F.when(s == "", F.array().cast("array<string>")).otherwise(F.split(s, " "))


def let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value``, which is evaluated once.

    Expressions captured by a lambda are evaluated anew at every call; a lambda variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def _bit(i: Column) -> Column:
    """2 to the power ``i``, a bigint."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)


def _word_mask(n: Column, w: Column) -> Column:
    """Ones for the positions of word ``w`` that lie within ``n`` characters."""
    width = F.least(n - w * BITS, F.lit(BITS))
    return _bit(width) - 1


def masks(s: Column) -> Column:
    """Map: each character of ``s`` to its positions as bits, in words of 62 bits."""
    return let(chars(s), _masks)


def _masks(cs: Column) -> Column:
    n = F.size(cs)
    n_words = F.greatest(F.ceil(n / BITS), F.lit(1)).cast("int")
    seen = F.array_distinct(cs)

    def of(c):
        def word(w):
            first = w * BITS
            places = F.sequence(first, F.least(n, first + BITS) - 1)
            places = F.when(first < n, places).otherwise(F.array().cast("array<int>"))
            return F.aggregate(
                places,
                F.lit(0).cast("bigint"),
                lambda acc, i: acc.bitwiseOR(F.when(F.element_at(cs, i + 1) == c, _bit(i - first)).otherwise(0)),
            )

        return F.transform(F.sequence(F.lit(0), n_words - 1), word)

    return F.map_from_arrays(seen, F.transform(seen, of))


def lcs_with(mask: Column, n: Column, other: Column) -> Column:
    """Length of the longest common subsequence of a string of length ``n`` whose
    ``masks`` are given and the characters ``other`` (an array)."""
    return let(mask, lambda m: let(n, lambda k: _lcs_with(m, k, other)))


def _lcs_with(mask: Column, n: Column, other: Column) -> Column:
    n_words = F.greatest(F.ceil(n / BITS), F.lit(1)).cast("int")
    start = F.transform(F.sequence(F.lit(0), n_words - 1), lambda w: _word_mask(n, w))
    keys = F.map_keys(mask)
    met = let(keys, lambda ks: F.filter(other, lambda c: F.array_contains(ks, c)))

    def step(state, c):
        def word(acc, w):
            s, b = F.element_at(state, w + 1), F.element_at(F.element_at(mask, c), w + 1)
            u = s.bitwiseAND(b)
            total = s + u + acc["carry"]
            value = total.bitwiseAND(F.lit(FULL)).bitwiseOR(s - u).bitwiseAND(_word_mask(n, w))
            return F.struct(
                F.concat(acc["words"], F.array(value)).alias("words"),
                F.call_function("shiftright", total, F.lit(BITS)).alias("carry"),
            )

        begin = F.struct(F.array().cast("array<bigint>").alias("words"), F.lit(0).cast("bigint").alias("carry"))
        return F.aggregate(F.sequence(F.lit(0), n_words - 1), begin, word, lambda acc: acc["words"])

    left = F.aggregate(met, start, step)
    ones = F.aggregate(left, F.lit(0).cast("bigint"), lambda acc, x: acc + F.bit_count(x))
    return (n - ones).cast("bigint")


def lcs(a: Column, b: Column) -> Column:
    """Longest common subsequence of two strings; masks go on the shorter one."""

    def pair(x, y):
        lx, ly = F.length(x), F.length(y)
        return F.when(lx <= ly, lcs_with(masks(x), lx, chars(y))).otherwise(lcs_with(masks(y), ly, chars(x)))

    return let(a, lambda x: let(b, lambda y: pair(x, y)))


def _ratio(common: Column, total: Column) -> Column:
    return F.when(total > 0, F.lit(200.0) * common / total).otherwise(F.lit(0.0))


def ratio(a: Column, b: Column) -> Column:
    """200 x LCS / (|a| + |b|); 0 for two empty strings."""
    return _ratio(lcs(a, b), F.length(a) + F.length(b))


def sorted_words(s: Column) -> Column:
    """The words of ``s`` sorted (by code point) and joined by single spaces."""
    return F.array_join(F.array_sort(words(s)), " ")


def word_set(s: Column) -> Column:
    """The distinct words of ``s``, sorted."""
    return F.array_sort(F.array_distinct(words(s)))


def token_sort_ratio(a: Column, b: Column) -> Column:
    return ratio(sorted_words(a), sorted_words(b))


def token_set_from(sa: Column, sb: Column) -> Column:
    """Token-set ratio of two names given as sorted word sets.

    0 if either has no word; 100 if one set holds the other; else the best of comparing
    the shared words with each side's words and the two sides' words with each other.
    """
    return let(sa, lambda x: let(sb, lambda y: _token_set(x, y)))


def _token_set(sa: Column, sb: Column) -> Column:
    parts = F.struct(
        F.length(F.array_join(F.array_sort(F.array_intersect(sa, sb)), " ")).alias("s"),
        F.size(F.array_intersect(sa, sb)).alias("n_shared"),
        F.array_join(F.array_except(sa, sb), " ").alias("rest_a"),
        F.array_join(F.array_except(sb, sa), " ").alias("rest_b"),
    )

    def score(t):
        s, rest_a, rest_b = t["s"], t["rest_a"], t["rest_b"]
        gap = F.when(s > 0, 1).otherwise(0)
        la, lb = F.length(rest_a), F.length(rest_b)
        total = 2 * (s + gap) + la + lb
        # Shared words against either whole side, and both sides against each other.
        part = F.when(s > 0, F.lit(200.0) * s / (s + F.least(s + gap + la, s + gap + lb))).otherwise(F.lit(0.0))
        whole = F.lit(200.0) * (s + gap + lcs(rest_a, rest_b)) / total
        subset = (t["n_shared"] > 0) & ((la == 0) | (lb == 0))
        return (
            F.when((F.size(sa) == 0) | (F.size(sb) == 0), F.lit(0.0))
            .when(subset, F.lit(100.0))
            .otherwise(F.greatest(part, whole))
        )

    return let(parts, score)


def token_set_ratio(a: Column, b: Column) -> Column:
    return token_set_from(word_set(a), word_set(b))


NATIVE = {"ratio": ratio, "token_sort_ratio": token_sort_ratio, "token_set_ratio": token_set_ratio}


def native_score(scorer: str, a: Column, b: Column) -> Column:
    """Score of two normalised names, null if either is null."""
    value = NATIVE[scorer](a, b)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).otherwise(value)
