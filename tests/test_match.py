import random
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import kindred as kd
from kindred.operators.ordinal import hot_groups, with_ordinal
from kindred.operators.rows import NAME, distinct_names, left_rows, right_rows
from reference_scores import SCORERS, best_matches

CFG = kd.MatchConfig(left_id_col="id", right_id_col="id", left_extra_cols=("id",), right_extra_cols=("id",))
WORDS = "banco banca bank nord sud credit agricole generale union trust sa ltd first group b c".split()
COUNTRIES = ["France", "USA", "United States", "Côte d'Ivoire", None, "Réunion", "Viet Nam", "Vietnam"]


def table(spark, rng, count, name, country, lei, copies=0.3):
    rows = []
    for i in range(count):
        if rows and rng.random() < copies:
            row = rng.choice(rows)[1:]
        else:
            words = [rng.choice(WORDS) for _ in range(rng.randint(0, 5))]
            text = " ".join(words).title() if rng.random() < 0.9 else None
            ids = " | ".join(rng.choice("ABCDEFGH") for _ in range(rng.randint(0, 2))) or None
            row = (text, rng.choice(COUNTRIES), ids)
        rows.append((i * 3 + 1, *row))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, f"id bigint, {name} string, {country} string, {lei} string").repartition(3)


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(11)
    left = table(spark, rng, 60, "institution_name", "country_name", "lei")
    right = table(spark, rng, 90, "SP_ENTITY_NAME", "SP_COUNTRY_NAME", "SP_LEI")
    return left.cache(), right.cache()


def brute_force(left, right, cfg):
    """Expected rows as (left id, right id, score, country_match, rank)."""
    l = sorted(left_rows(left, cfg).collect(), key=lambda r: r["_position"])
    r = sorted(right_rows(right, cfg).collect(), key=lambda r: r["_position"])
    out = []
    for a in l:
        if not a[NAME]:
            continue
        for same in (True, False) if cfg.relax_country else (True,):
            pool = [b for b in r if not same or b["_block"] == a["_block"]]
            best = best_matches(cfg.scorer, [a[NAME]], [b[NAME] for b in pool], cfg.score_threshold, cfg.top_n)[0]
            if best:
                out += [(a, pool[j], s, same) for j, s in best]
                break
    groups = {}
    for a, b, s, same in out:
        groups.setdefault((a["left_institution_name"], a["left_country_name"]), []).append((a, b, s, same))
    rows = []
    for group in groups.values():
        group.sort(key=lambda x: (-round(x[2], 2), x[0]["_position"], -x[2], x[1]["_position"]))
        rows += [(a["_position"], b["_position"], round(s, 2), c, n + 1) for n, (a, b, s, c) in enumerate(group)]
    return sorted(rows)


def run(left, right, cfg):
    rows = kd.match(left, right, cfg).collect()
    return sorted((r.left_id, r.right_id, r.fuzzy_score, r.country_match, r.match_rank) for r in rows)


@pytest.mark.parametrize("scorer", kd.SCORERS)
@pytest.mark.parametrize("threshold,top_n,relax", [(50.0, 5, False), (88.0, 2, True)])
def test_match_equals_brute_force(data, scorer, threshold, top_n, relax):
    cfg = replace(CFG, scorer=scorer, score_threshold=threshold, top_n=top_n, relax_country=relax)
    assert run(*data, cfg) == brute_force(*data, cfg)


def test_zero_threshold_keeps_everything(data):
    cfg = replace(CFG, score_threshold=0.0, top_n=1000)
    got = run(*data, cfg)
    assert got == brute_force(*data, cfg)
    assert any(score == 0 for _, _, score, _, _ in got)


def test_tiles_and_partitions_do_not_matter(data):
    left, right = data
    cfg = replace(CFG, relax_country=True, score_threshold=88.0)
    want = run(left, right, cfg)
    tiny = replace(cfg, left_tile_rows=2, right_tile_rows=3)
    assert run(left.repartition(7), right.repartition(1).orderBy(F.rand(3)), tiny) == want


def test_content_order_without_ids(data):
    left, right = data
    cfg = replace(CFG, left_id_col=None, right_id_col=None, left_extra_cols=(), right_extra_cols=())
    runs = [Counter(kd.match(left.repartition(n), right.repartition(n), cfg).collect()) for n in (1, 5)]
    assert runs[0] == runs[1]


def test_result_shape_and_order(data):
    left, right = data
    cfg = replace(CFG, left_extra_cols=("id", "lei", "nowhere"), relax_country=True)
    result = kd.match(left, right, cfg)
    assert result.columns == [
        "left_institution_name", "left_country_name", "left_lei", "right_SP_ENTITY_NAME",
        "right_SP_COUNTRY_NAME", "right_SP_LEI", "fuzzy_score", "lei_match", "country_match",
        "match_rank", "left_id", "left_nowhere", "right_id",
    ]
    kinds = dict(result.dtypes)
    assert (kinds["fuzzy_score"], kinds["match_rank"], kinds["lei_match"]) == ("double", "bigint", "boolean")
    rows = result.collect()
    assert {r.left_nowhere for r in rows} == {None}
    null_last = lambda v: (v is None, v or "")
    keys = [(null_last(r[0]), null_last(r[1]), r.match_rank) for r in rows]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    ids = lambda text: {x.strip() for x in (text or "").split("|") if x.strip()}
    assert all(r.lei_match == bool(ids(r.left_lei) & ids(r.right_SP_LEI)) for r in rows)


def test_hot_copies(spark, monkeypatch):
    """One record with most of the rows: the sliced numbering must change nothing."""
    rows = [(i, "First Bank", "France", "A") for i in range(200)]
    rows += [(1000 + i, "first bank", "France", None) for i in range(7)] + [(5000, "Trust", None, "B")]
    left = spark.createDataFrame(rows, "id bigint, institution_name string, country_name string, lei string")
    right = spark.createDataFrame(
        [(i, n, c, "A") for i, (n, c) in enumerate([("First Bank SA", "France"), ("1st Bank", "France"), ("Trust", None)])],
        "id bigint, SP_ENTITY_NAME string, SP_COUNTRY_NAME string, SP_LEI string",
    )
    want = run(left, right, CFG)
    assert want == brute_force(left, right, CFG)
    from kindred.plans import match as plan

    monkeypatch.setattr(plan, "hot_groups", lambda names: hot_groups(names, 20))
    monkeypatch.setattr(plan, "with_ordinal", lambda rows, keys, hot: with_ordinal(rows, keys, hot, 10))
    assert run(left, right, CFG) == want
    text = left.withColumn("id", F.format_string("file-a/part#%09d", "id"))
    cfg = replace(CFG, left_id_col="id")
    sliced = kd.match(text, right, cfg).select("left_id", "right_id", "match_rank").collect()
    assert sorted((int(r.left_id[-9:]), r.right_id, r.match_rank) for r in sliced) == sorted(
        (a, b, n) for a, b, _, _, n in want
    )


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_ordinal_slices(spark, kind):
    rows = left_rows(
        spark.range(500).select(
            F.col("id").cast(kind).alias("id"),
            F.when(F.col("id") % 5 < 4, "hot").otherwise(F.concat(F.lit("n"), F.col("id") % 7)).alias("institution_name"),
            F.when(F.col("id") % 3 == 0, "x").alias("country_name"),
        ),
        replace(CFG, left_extra_cols=()),
    )
    keys = ["left_institution_name", "left_country_name"]
    plain = with_ordinal(rows, keys, None)
    sliced = with_ordinal(rows, keys, hot_groups(distinct_names(rows), 50), 10)
    columns = ["_position", "_ordinal", "_group"]
    assert sorted(sliced.select(columns).collect()) == sorted(plain.select(columns).collect())


@pytest.mark.parametrize("kind", ["outlier", "clustered", "content"])
def test_hot_slices_are_even(spark, kind):
    """Slices stay near their size whatever the positions look like."""
    ids = {"outlier": "if(id = 0, 1000000000000, id)", "clustered": "format_string('part-0/file#%020d', id)", "content": "id"}[kind]
    rows = spark.range(20_000).selectExpr(f"{ids} as id", "'First Bank' as institution_name", "'France' as country_name")
    rows = left_rows(rows, replace(CFG, left_extra_cols=(), left_id_col=None if kind == "content" else "id"))
    sliced = with_ordinal(rows, ["left_institution_name", "left_country_name"], hot_groups(distinct_names(rows), 100), 1000)
    assert sliced.groupBy("_slice").count().agg(F.max("count")).first()[0] <= 2000
    assert sliced.agg(F.count_distinct("_ordinal"), F.max("_ordinal"), F.min("_group")).first() == (20_000, 20_000, 20_000)


def test_derived_results_are_not_sorted_first(data):
    results = kd.match(*data, CFG, ordered=False)
    for derived in (kd.validate_lei_scores(results), kd.unique_pairs(results, CFG), kd.run_summary(results, CFG)):
        assert "Sort [" not in derived._jdf.queryExecution().optimizedPlan().toString()
    assert "Sort [" in kd.match(*data, CFG)._jdf.queryExecution().optimizedPlan().toString()


def test_right_rows_are_narrowed_before_their_numbering(data):
    plan = kd.match(*data, CFG, ordered=False)._jdf.queryExecution().optimizedPlan().toString()
    limit = plan.index("WindowGroupLimit", plan.index("_nth"))
    assert "LeftSemi" in plan[limit:]


def test_plan_has_no_cross_join_and_limits_early(data):
    cfg = replace(CFG, relax_country=True)
    plan = kd.match(*data, cfg)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert "WindowGroupLimit" in plan


def test_no_match_keeps_schema(data):
    left, right = data
    nothing = kd.match(left.filter("false"), right, CFG)
    assert nothing.count() == 0 and "match_rank" in nothing.columns


def test_missing_columns(data):
    left, right = data
    bare = kd.match(left.drop("lei", "country_name"), right.drop("SP_LEI"), CFG)
    assert bare.filter("lei_match").count() == 0
    assert {r.left_country_name for r in bare.collect()} == {None}
    for needed in ("SP_ENTITY_NAME", "SP_COUNTRY_NAME"):
        with pytest.raises(ValueError, match=needed):
            kd.match(left, right.drop(needed), CFG)


@pytest.mark.parametrize("change", [{"scorer": "soundex"}, {"score_threshold": -1}, {"score_threshold": 101}, {"top_n": 0}])
def test_bad_settings(change):
    with pytest.raises(ValueError):
        kd.MatchConfig(**change)


def test_right_filter_and_unique_pairs(data):
    left, right = data
    cfg = replace(CFG, score_threshold=70.0)
    narrowed = kd.match(left, right, cfg, right_filter=F.col("SP_LEI").isNotNull())
    assert narrowed.filter("right_SP_LEI is null").count() == 0
    result = kd.match(left, right, cfg)
    pairs = kd.unique_pairs(result, cfg).collect()
    best = {}
    for r in result.collect():
        key = (r.left_institution_name, r.right_SP_ENTITY_NAME)
        best[key] = max(best.get(key, 0), r.fuzzy_score)
    assert {(r.left_institution_name, r.right_SP_ENTITY_NAME): r.fuzzy_score for r in pairs} == best
    assert len(pairs) == len(best)


def test_long_names(spark):
    """Names of hundreds of characters are compared whole."""
    rng = random.Random(2)
    text = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    left = spark.createDataFrame([(i, text(20), "x", None) for i in range(2)], "id int, institution_name string, country_name string, lei string")
    base = left.collect()
    others = [(i, text(3) + " " + base[i % 2][1] + text(9), "x", None) for i in range(3)]
    right = spark.createDataFrame(others, "id int, SP_ENTITY_NAME string, SP_COUNTRY_NAME string, SP_LEI string")
    for scorer in ("ensemble", "token_sort_ratio"):
        cfg = replace(CFG, scorer=scorer)
        assert run(left, right, cfg) == brute_force(left, right, cfg)


def test_score_column(spark):
    pairs = [("first bank", "bank first"), ("abc", ""), ("", ""), (None, "x"), ("a b", "a b c d e f")]
    df = spark.createDataFrame(pairs, "l string, r string").coalesce(1)
    for name, exact in SCORERS.items():
        got = [r[0] for r in df.select(kd.score_column(name, F.col("l"), F.col("r"))).collect()]
        want = [None if l is None else exact(l, r) for l, r in pairs]
        assert got == pytest.approx(want) if None not in want else [g is None for g in got] == [w is None for w in want]
    with pytest.raises(ValueError):
        kd.score_column("soundex", F.col("l"), F.col("r"))


@pytest.mark.parametrize("relax", [False, True])
def test_plans_stay_small(spark, data, relax):
    """The left rows are normalised once in the plan: no filter is pushed into the steps."""
    cfg = replace(CFG, relax_country=relax, score_threshold=60.0)
    result = kd.match(*data, cfg)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 300_000
