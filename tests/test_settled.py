"""Names whose cutoff is known before any tile is scored."""

import random
from collections import Counter

import numpy as np
import pytest

import kindred as kd
from kindred.functions import screen
from kindred.functions.scoring import best_pairs
from kindred.operators.compare import best_names, settled_names
from kindred.operators.rows import BLOCK, NAME, POSITION
from reference_scores import best_matches

WORDS = "the of and red bank credit union trust general north".split()


def made(rng, count, low, high):
    out = set()
    while len(out) < count:
        out.add(" ".join(rng.choice(WORDS) for _ in range(rng.randint(low, high))))
    return sorted(out, key=lambda _: rng.random())


def sides(rng):
    left = made(rng, 90, 6, 9) + made(rng, 3, 1, 2) + ["zq xw " * 5 + "zq", "the " * 20 + "end", ""]
    return left, made(rng, 25, 6, 9) + made(rng, 12, 1, 2) + ["", "zq xw xw"]


def unlike(a, b):
    short, long = sorted((len(a), len(b)))
    return 2 * long >= 3 * short and long <= 8 * short


def test_settled_names_share_one_token_with_enough(spark):
    left, right = sides(random.Random(1))
    l = spark.createDataFrame([(b, n) for b in "xy" for n in left], [BLOCK, NAME])
    r = spark.createDataFrame([("x", n, i) for i, n in enumerate(right)], [BLOCK, NAME, POSITION])
    expected = set()
    for a in left:
        held = Counter(w for b in right if b and unlike(a, b) for w in set(b.split()) & set(a.split()))
        if a and len(a) <= 64 and max(held.values(), default=0) >= 2:
            expected.add(("x", a))
    assert len(expected) > 50
    assert {tuple(row) for row in settled_names(l, r, 2).collect()} == expected


@pytest.mark.parametrize("scorer, threshold", [("WRatio", 0.0), ("ensemble", 50.0)])
def test_best_names_over_tiles_equal_brute_force(spark, scorer, threshold):
    left, right = sides(random.Random(2))
    l = spark.createDataFrame([("x", n) for n in left], [BLOCK, NAME])
    r = spark.createDataFrame([("x", n, i) for i, n in enumerate(right)], [BLOCK, NAME, POSITION])
    cfg = kd.MatchConfig(scorer=scorer, score_threshold=threshold, top_n=2, left_tile_rows=200, right_tile_rows=7)
    got = {}
    for row in best_names(l, r, cfg).collect():
        got.setdefault(row["_left_name"], []).append((-row["_score"], row[POSITION]))
    kept = [n for n in left if n]
    for name, best in zip(kept, best_matches(scorer, kept, right, threshold, 2).values()):
        assert [(j, pytest.approx(s)) for j, s in best] == [(p, -s) for s, p in sorted(got.get(name, []))], name


def test_settled_names_meet_no_full_pass(monkeypatch):
    """Names settled elsewhere are screened by characters, even where this tile has no such names."""
    rng = random.Random(3)
    left, right = made(rng, 90, 6, 9), made(rng, 60, 6, 9)
    monkeypatch.setattr(screen.Masks, "run", None)
    li, ri, s = best_pairs("ensemble", left, right, 50.0, 2, sure=np.ones(90, bool))
    expected = [
        (i, j, x) for i, best in best_matches("ensemble", left, right, 85.5, 2).items() for j, x in best
    ]
    assert [(i, j) for i, j, _ in expected] == list(zip(li.tolist(), ri.tolist()))
    assert np.allclose(s, [x for *_, x in expected])
