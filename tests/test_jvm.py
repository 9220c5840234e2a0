"""The kernel in the JVM: best names of tiles, against brute force and the NumPy kernel."""

import random

import pytest

import kindred as kd
from kindred.operators.compare import _kernel_best, best_names
from kindred.operators.rows import BLOCK, NAME, POSITION
from reference_scores import best_matches

WORDS = "the of and red bank credit union trust general north bnk a b zq".split()


def made(rng, count, low, high):
    out = set()
    while len(out) < count:
        name = " ".join(rng.choice(WORDS) for _ in range(rng.randint(low, high)))
        at = rng.randrange(len(name))
        out.add(" ".join((name[:at] + rng.choice("abz 9") + name[at + 1 :]).split()) or "x")
    return sorted(out, key=lambda _: rng.random())


def tables(spark, left, right, kind="bigint"):
    l = spark.createDataFrame([("x", n) for n in left], [BLOCK, NAME])
    r = spark.createDataFrame([("x", n, i) for i, n in enumerate(right)], [BLOCK, NAME, POSITION])
    return l, r.withColumn(POSITION, r[POSITION].cast(kind))


def found(df):
    return sorted((r["_left_name"], r["_right_name"], r["_score"], r[POSITION]) for r in df.collect())


@pytest.mark.parametrize("scorer", ["partial_ratio", "WRatio", "ensemble"])
@pytest.mark.parametrize("threshold, top_n", [(0.0, 3), (62.0, 2), (88.0, 9)])
def test_best_names_equal_brute_force(spark, scorer, threshold, top_n):
    rng = random.Random(5)
    long = ["the red bank " * 5 + "zq"]
    left = made(rng, 8, 1, 3) + [n for n in made(rng, 14, 6, 9) if len(n) <= 64] + long + ["", "a", "z" * 64]
    right = made(rng, 9, 1, 3) + made(rng, 9, 6, 9) + long + ["", "b", "z" * 63, "bank of " * 16 + "credit"]
    l, r = tables(spark, left, right)
    cfg = kd.MatchConfig(scorer=scorer, score_threshold=threshold, top_n=top_n, left_tile_rows=12, right_tile_rows=12)
    got = {}
    for a, _, score, position in found(best_names(l, r, cfg)):
        got.setdefault(a, []).append((-score, position))
    kept = [n for n in left if n]
    for name, best in zip(kept, best_matches(scorer, kept, right, threshold, top_n).values()):
        assert [(j, pytest.approx(s)) for j, s in best] == [(p, -s) for s, p in sorted(got.get(name, []))], name


@pytest.mark.parametrize("scorer", ["partial_ratio", "WRatio", "ensemble"])
def test_both_kernels_give_the_same_rows(spark, scorer):
    """Equal to the last bit, whatever the type of the positions; names above 64 characters too."""
    rng = random.Random(6)
    left, right = made(rng, 150, 1, 14), made(rng, 120, 1, 14)
    for kind in ("bigint", "string"):
        l, r = tables(spark, left, right, kind)
        cfg = kd.MatchConfig(scorer=scorer, score_threshold=40.0, top_n=4)
        assert found(best_names(l, r, cfg)) == found(_kernel_best(l, r, cfg))


@pytest.mark.parametrize("scorer", ["partial_ratio", "WRatio", "ensemble"])
def test_no_python_where_left_names_fit_a_word(spark, scorer):
    l, r = tables(spark, ["red bank", "north"], ["red bnk", "north trust"])
    best = best_names(l, r, kd.MatchConfig(scorer=scorer, score_threshold=0.0, top_n=2))
    assert "Python" not in best._jdf.queryExecution().toString()
    assert len(best.collect()) == 4


def test_names_without_a_position_stay(spark):
    r = spark.createDataFrame([("x", "red bank", None), ("x", "red bonk", 1)], f"{BLOCK} string, {NAME} string, {POSITION} bigint")
    l = spark.createDataFrame([("x", "red bank")], [BLOCK, NAME])
    best = best_names(l, r, kd.MatchConfig(scorer="partial_ratio", score_threshold=0.0, top_n=2))
    assert {(row["_right_name"], row[POSITION]) for row in best.collect()} == {("red bank", None), ("red bonk", 1)}
