import random

import numpy as np
import pytest

from kindred.functions.scoring import best_pairs, overlaps, score_bounds, score_pairs, two_sides
from reference_scores import SCORERS, best_matches

WORDS = (
    "bank banco banca first national of the north south union credit capital trust sa ag plc "
    "llc de la del sur est a 1 b group holding savings general generale pjsc moldova agro ind"
).split()


def names(rng, count, alphabet="abcd ", longest=40):
    out = [""]
    while len(out) < count:
        if rng.random() < 0.5:
            words = [rng.choice(WORDS) for _ in range(rng.randint(1, 7))]
            if rng.random() < 0.3:
                words.append(words[0])
            text = " ".join(words)
        else:
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, longest)))
        text = " ".join(text.split())
        if rng.random() < 0.3 and out[-1]:
            text = " ".join(reversed(out[-1].split())) + rng.choice(["", " x", "s"])
        out.append(text)
    return out


@pytest.mark.parametrize("scorer", sorted(SCORERS))
def test_scores_equal_definition(scorer):
    rng = random.Random(5)
    left, right = names(rng, 250), names(rng, 250)
    left += names(rng, 4, longest=150)
    right += names(rng, 4, longest=150)
    at = np.arange(len(left))
    a, b = two_sides(left, right)
    got = score_pairs(scorer, a, at, b, at)
    want = np.array([SCORERS[scorer](x, y) for x, y in zip(left, right)])
    assert np.abs(got - want).max() < 1e-9
    flipped = score_pairs(scorer, b, at, a, at)
    assert np.array_equal(got, flipped)
    assert got.min() >= 0 and got.max() <= 100
    at = np.flatnonzero(a.size > 0)
    same = score_pairs(scorer, a, at, a, at)
    assert (same == 100).all()


@pytest.mark.parametrize("scorer", sorted(SCORERS))
def test_bounds_hold(scorer):
    rng = random.Random(6)
    left, right = names(rng, 90), names(rng, 90)
    a, b = two_sides(left, right)
    overlap = overlaps(a, b)
    bound, settled = score_bounds(scorer, a, b, overlap)
    li, ri = (x.ravel() for x in np.indices(bound.shape))
    exact = score_pairs(scorer, a, li, b, ri)
    assert (bound[li, ri] + 1e-3 >= exact).all()
    assert np.abs(bound - exact.reshape(bound.shape))[settled].max(initial=0) < 1e-3
    # Skipping hopeless terms must not change any score at or above the floor.
    for floor in (40.0, 80.0, 95.0):
        quick = score_pairs(scorer, a, li, b, ri, np.full(li.size, floor), overlap.at(li, ri))
        keep = exact >= floor
        assert np.array_equal(quick[keep], exact[keep])
        assert (quick[~keep] < floor).all()


@pytest.mark.parametrize("scorer", sorted(SCORERS))
@pytest.mark.parametrize("threshold,top_n", [(0, 3), (50, 5), (85.5, 2)])
def test_best_pairs_equal_brute_force(scorer, threshold, top_n):
    rng = random.Random(7)
    left, right = names(rng, 25, longest=25)[1:], names(rng, 60, longest=25)
    want = best_matches(scorer, left, right, threshold, top_n)
    li, ri, s = best_pairs(scorer, left, right, threshold, top_n)
    got = {i: [] for i in want}
    for i, j, x in zip(li.tolist(), ri.tolist(), s.tolist()):
        got[i].append((j, x))
    for i in want:
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]]
        assert np.allclose([x for _, x in got[i]], [x for _, x in want[i]], atol=1e-9)


@pytest.mark.parametrize("scorer", ["ensemble", "token_set_ratio"])
def test_texts_among_names(scorer, monkeypatch):
    """Splitting uneven names into runs, and matching tokens pair by pair, change nothing."""
    from kindred.functions import scoring

    rng = random.Random(9)
    left, right = names(rng, 20)[1:], names(rng, 50)
    left.append(" ".join(rng.choice(WORDS) for _ in range(40)))
    right.append(" ".join(rng.choice(WORDS) for _ in range(45)))
    want = best_pairs(scorer, left, right, 40, 4)
    monkeypatch.setattr(scoring, "_TOKEN_CELLS", 60)
    monkeypatch.setattr(scoring, "_FEW_TOKENS", 2)
    got = best_pairs(scorer, left, right, 40, 4)
    assert all(np.array_equal(x, y) for x, y in zip(want, got))


@pytest.mark.parametrize("scorer", sorted(SCORERS))
@pytest.mark.parametrize("threshold,top_n", [(0, 3), (50, 5), (85.5, 1)])
def test_screened_pairs_equal_brute_force(scorer, threshold, top_n, monkeypatch):
    """Left names met together, with cutoffs that rise every few pairs."""
    from kindred.functions import scoring

    monkeypatch.setattr(scoring, "_SCREEN_PAIRS", 90)
    monkeypatch.setattr(scoring, "_SCREEN_NAMES", 1)
    rng = random.Random(11)
    left, right = names(rng, 40, longest=64)[1:], names(rng, 90, longest=64)
    left += [" ".join(rng.choice(WORDS) for _ in range(30)), "bank", "x"]
    right += [" ".join(rng.choice(WORDS) for _ in range(25)), "x", "national"]
    right += [f"{w} {rng.choice(WORDS)}" for w in WORDS[:8]]
    want = best_matches(scorer, left, right, threshold, top_n)
    li, ri, s = best_pairs(scorer, left, right, threshold, top_n)
    got = {i: [] for i in want}
    for i, j, x in zip(li.tolist(), ri.tolist(), s.tolist()):
        got[i].append((j, x))
    for i in want:
        assert [j for j, _ in got[i]] == [j for j, _ in want[i]]
        assert np.allclose([x for _, x in got[i]], [x for _, x in want[i]], atol=1e-9)


@pytest.mark.parametrize("scorer", sorted(SCORERS))
def test_few_pairs_are_scored(scorer, monkeypatch):
    """Titles all alike: most pairs are ruled out by counts made for all left names at once."""
    from kindred.functions import scoring

    rng = random.Random(12)
    parts = "th an er on in ed re he is ing tion ly ble ou".split()
    title = lambda: " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(9))[:57].strip()
    left, right = [title() for _ in range(300)], [title() for _ in range(1500)]
    right[::30] = ["th an", "er on in"] * 25
    scored, inner = [], scoring.score_pairs

    def count(scorer, a, ai, *rest):
        scored.append(len(ai))
        return inner(scorer, a, ai, *rest)

    monkeypatch.setattr(scoring, "score_pairs", count)
    monkeypatch.setattr(scoring, "_SCREEN_PAIRS", 1 << 13, raising=False)
    best_pairs(scorer, left, right, 0, 2)
    assert sum(scored) < 0.15 * len(left) * len(right)


def test_window_bounds_hold():
    from kindred.functions.lanes import Strands
    from kindred.functions.screen import window_bounds

    rng = random.Random(13)
    left, right = names(rng, 200, longest=60), names(rng, 200, longest=60)
    sides = [(Strands(x), Strands([n[::-1] for n in x])) for x in (left, right)]
    at = np.flatnonzero([min(len(x), len(y)) <= 64 for x, y in zip(left, right)])
    bound = window_bounds(sides[0], at, sides[1], at)
    exact = np.array([SCORERS["partial_ratio"](left[i], right[i]) for i in at])
    assert (bound + 1e-3 >= exact).all()
