"""Native scorer Columns against the plain definitions."""

import random

import pytest
from pyspark.sql import functions as F

from kindred.functions import native
from reference_scores import lcs_length
from reference_scores import ratio as plain_ratio
from reference_scores import token_set_ratio as plain_token_set
from reference_scores import token_sort_ratio as plain_token_sort
from test_scoring import names

PLAIN = {"ratio": plain_ratio, "token_sort_ratio": plain_token_sort, "token_set_ratio": plain_token_set}


@pytest.fixture(scope="module")
def pairs(spark):
    rng = random.Random(23)
    left, right = names(rng, 300), names(rng, 300)
    # Longer than one and than two words of bits, so carries cross words.
    left += names(rng, 12, longest=200)
    right += names(rng, 12, longest=200)
    left += ["a" * 62, "ab" * 40, "x" * 130, "", None]
    right += ["a" * 63, "ba" * 40, "x" * 124 + "y", "", "bank"]
    rows = list(zip(left, right)) + list(zip(right, left))
    return rows, spark.createDataFrame(rows, "a string, b string")


def test_lcs_equals_dynamic_programming(pairs):
    rows, df = pairs
    got = df.select(native.lcs(F.col("a"), F.col("b")).alias("n")).collect()
    for (a, b), row in zip(rows, got):
        if a is None or b is None:
            continue
        assert row.n == lcs_length(a, b), (a, b)


@pytest.mark.parametrize("scorer", sorted(native.NATIVE))
def test_scores_equal_definition(pairs, scorer):
    rows, df = pairs
    got = df.select(native.native_score(scorer, F.col("a"), F.col("b")).alias("s")).collect()
    for (a, b), row in zip(rows, got):
        if a is None or b is None:
            assert row.s is None
        else:
            assert row.s == pytest.approx(PLAIN[scorer](a, b), abs=1e-9), (scorer, a, b)


def test_no_python_in_plan(pairs):
    _, df = pairs
    plan = df.select(native.native_score("token_set_ratio", F.col("a"), F.col("b")))._jdf.queryExecution()
    text = plan.executedPlan().toString()
    assert "Python" not in text and "ArrowEval" not in text


@pytest.mark.parametrize("scorer", ["token_sort_ratio", "token_set_ratio"])
@pytest.mark.parametrize("threshold", [0.0, 60.0])
def test_name_matches_native_equal_kernel(spark, monkeypatch, scorer, threshold):
    """Best names through the native join equal those of the NumPy tiles; no Python runs."""
    from dataclasses import replace

    import kindred as kd
    from test_match import CFG, table

    rng = random.Random(8)
    left = table(spark, rng, 80, "institution_name", "country_name", "lei")
    right = table(spark, rng, 120, "SP_ENTITY_NAME", "SP_COUNTRY_NAME", "SP_LEI")
    cfg = replace(CFG, scorer=scorer, score_threshold=threshold, top_n=4)
    fast = kd.name_matches(left, right, replace(cfg, native_scorers=True))
    plan = fast._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan
    got = sorted(map(tuple, fast.collect()))
    slow = sorted(map(tuple, kd.name_matches(left, right, cfg).collect()))
    assert [r[:3] for r in got] == [r[:3] for r in slow]
    assert all(abs(a[3] - b[3]) < 1e-9 for a, b in zip(got, slow))


@pytest.mark.parametrize("threshold", [0.0, 60.0])
def test_wratio_split_by_length_equals_kernel(spark, threshold):
    """WRatio with alike pairs in the JVM and the rest in the kernel equals the kernel alone."""
    from dataclasses import replace

    import kindred as kd
    from test_match import CFG, table

    rng = random.Random(9)
    left = table(spark, rng, 80, "institution_name", "country_name", "lei")
    right = table(spark, rng, 120, "SP_ENTITY_NAME", "SP_COUNTRY_NAME", "SP_LEI")
    cfg = replace(CFG, scorer="WRatio", score_threshold=threshold, top_n=4)
    split = sorted(map(tuple, kd.name_matches(left, right, replace(cfg, split_by_length=True)).collect()))
    whole = sorted(map(tuple, kd.name_matches(left, right, cfg).collect()))
    assert [r[:3] for r in split] == [r[:3] for r in whole]
    assert all(abs(a[3] - b[3]) < 1e-9 for a, b in zip(split, whole))
