"""Queries of this engine over the given tables, with their SQL twins.

``entry(spark)`` is the flagship query, ``queries()`` one entry per operator, and
``oracle_sql()`` the same results in DuckDB SQL.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import kindred as kd  # noqa: E402
from checks import fixtures as fx  # noqa: E402
from checks import oracles as sql  # noqa: E402
from kindred.operators.stage import shared_folder  # noqa: E402

try:
    import corpus_pipeline
    from kindred.llm import queries as llm
except ImportError:  # the subpackage is optional
    llm = None

SMOKE_DIR = "/root/testdata/sf0.001"

# The configurations the queries run with.
ORG = replace(fx.ORG, score_threshold=60.0, top_n=3)
ORG_EXTRAS = replace(
    ORG, scorer="token_set_ratio", left_extra_cols=("branch_id", "balance"), right_extra_cols=("entity_id", "industry")
)
ORG_HIGH = replace(ORG, score_threshold=90.0, top_n=5)
ORG_TRUTH = replace(ORG, left_extra_cols=("branch_id",), right_extra_cols=("entity_id",))
PAGE = replace(fx.PAGE, left_extra_cols=("page_id",), right_extra_cols=("page_id",))
PAGE_SORT = replace(PAGE, scorer="token_sort_ratio")
PAGE_RELAXED = replace(
    fx.PAGE_RELAXED, scorer="WRatio", score_threshold=55.0, top_n=2,
    left_extra_cols=("page_id",), right_extra_cols=("page_id",),
)
PART = replace(fx.PART, score_threshold=70.0)
PAGE_BLANK = replace(PAGE, left_extra_cols=("page_id", "branch_code"), scorer="token_sort_ratio", score_threshold=70.0, top_n=3)
# Truth pairs here are also low, outranked, and both low and of another country.
ORG_NARROW = replace(ORG_TRUTH, score_threshold=88.0, top_n=1)
CUT = 80.0
INDUSTRY = "industry = 'MACHINERY'"


def entry(spark: SparkSession) -> DataFrame:
    """Branches linked to headquarters of their country, the three best above 60."""
    kd.ship(spark)
    return kd.match(*fx.org(spark, SMOKE_DIR), ORG)


# ------------------------------------------------------------------ normalisation queries


def normalize_names(spark, d):
    docs = fx.table(spark, d, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), "text")
    left, right = fx.org(spark, d)
    orgs = left.select(F.lit("branch"), "branch_id", "institution_name").union(
        right.select(F.lit("entity"), "entity_id", "SP_ENTITY_NAME")
    )
    return kd.normalise(docs.union(orgs), "text", None).withColumnRenamed("text", "name_key")


def normalize_countries(spark, d):
    left, right = fx.org(spark, d)
    both = left.select(F.lit("left").alias("side"), F.col("branch_id").alias("id"), F.col("country_name").alias("country"))
    both = both.union(right.select(F.lit("right"), "entity_id", "SP_COUNTRY_NAME"))
    return kd.normalise(both.withColumn("country_key", F.col("country")), None, "country_key")


def lei_sets(spark, d):
    left, _ = fx.pages(spark, d)
    return left.select("page_id", F.explode(kd.lei_set(F.col("codes"))).alias("lei"))


# ------------------------------------------------------------------------- scorer queries


SCORED = {
    "org": (fx.org, replace(fx.ORG, score_threshold=0.0, top_n=10)),
    "page": (fx.pages, replace(fx.PAGE, score_threshold=0.0, top_n=10)),
}


def _score_query(scorer, fixture):
    """The ten best-scoring names of the same country for every name, down to score 0."""

    def run(spark, d):
        kd.ship(spark)
        data, cfg = SCORED[fixture]
        return kd.name_matches(*data(spark, d), replace(cfg, scorer=scorer))

    return run


def _score_sql(scorer, fixture):
    cfg = SCORED[fixture][1]
    return f"""with {sql.keyed(fixture, cfg)}, {sql.scores(sql.STRICT_PAIRS, [scorer])},
        ln as (select distinct ck, nk from l where nk <> ''), rn as (select ck, nk, min(pos) as pos from r group by ck, nk)
        select ln.ck as country_key, a as left_key, b as right_key, {scorer} as score
        from ln join rn on ln.ck = rn.ck join scored on a = ln.nk and b = rn.nk
        qualify row_number() over (partition by ln.ck, ln.nk order by {scorer} desc, rn.pos) <= {cfg.top_n}"""


# ----------------------------------------------------------------------- pipeline queries


def candidate_counts(spark, d):
    return kd.candidate_counts(*fx.org(spark, d), ORG)


def _match_query(fixture, cfg, then=None):
    def run(spark, d):
        kd.ship(spark)
        result = kd.match(*fixture(spark, d), cfg, ordered=then is None)
        return then(result) if then else result

    return run


def prefiltered_match(spark, d):
    kd.ship(spark)
    return kd.match(*fx.org(spark, d), ORG, right_filter=F.expr(INDUSTRY))


def unmatched_left(spark, d):
    kd.ship(spark)
    left, right = fx.org(spark, d)
    found = kd.match(left, right, replace(ORG_TRUTH, score_threshold=90.0)).select("left_branch_id")
    return left.join(found.distinct(), F.col("branch_id") == F.col("left_branch_id"), "left_anti").select(
        "branch_id", "institution_name", "country_name"
    )


def rank_checks(result):
    """Ranks of every (left name, left country): they must run from 1 without gaps."""
    return result.groupBy("left_p_name", "left_p_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("match_rank").alias("first"),
        F.max("match_rank").alias("last"),
        F.count_distinct("match_rank").alias("n_ranks"),
    )


def truth_pairs(spark, d):
    return kd.truth_pairs(*fx.org(spark, d), ORG)


def truth_misses(spark, d):
    kd.ship(spark)
    return kd.truth_misses(*fx.org(spark, d), ORG)


def miss_reasons(spark, d):
    kd.ship(spark)
    return kd.miss_reasons(*fx.org(spark, d), ORG)


def scorer_comparison(spark, d):
    kd.ship(spark)
    return kd.compare_scorers(kd.truth_groups(*fx.org(spark, d), ORG), CUT)


def lei_confirmed(result):
    return result.filter("lei_match").select("left_page_id", "right_page_id", "left_codes", "right_codes")


def csv_roundtrip(spark, d):
    """Headquarters written as CSV, read back and matched."""
    kd.ship(spark)
    left, right = fx.org(spark, d)
    path = shared_folder(spark, "entities-csv")
    kd.write_table(right, path, "csv")
    again = kd.read_table(spark, path, "csv").withColumn("entity_id", F.col("entity_id").cast("bigint"))
    return kd.match(left, again, ORG)


def match_job(spark, d):
    """The whole job on stored tables: read, link, write; what was written, with its row count."""
    kd.ship(spark)
    paths = [shared_folder(spark, "branches"), shared_folder(spark, "entities"), shared_folder(spark, "matches")]
    for rows, path in zip(fx.org(spark, d), paths):
        kd.write_table(rows, path)
    report = kd.run_job(spark, *paths[:2], ORG, paths[2], right_filter=INDUSTRY, validate_lei=True)
    return kd.read_table(spark, paths[2]).withColumn("n_rows", F.lit(report.rows).cast("long"))


def match_blanks(spark, d):
    """Missing names and countries, the block of unknown countries, an extra that no table has."""
    kd.ship(spark)
    return kd.match(*fx.pages_blank(spark, d), PAGE_BLANK)


def schema_listing(spark, d):
    return kd.schema_of(fx.table(spark, d, "customer"))


def narrow_miss_reasons(spark, d):
    kd.ship(spark)
    return kd.miss_reasons(*fx.org(spark, d), ORG_NARROW)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    summary = lambda cfg: lambda result: kd.run_summary(result, cfg)
    out = {
        "normalize_names": normalize_names,
        "normalize_countries": normalize_countries,
        "lei_sets": lei_sets,
        "candidate_counts": candidate_counts,
    }
    for scorer in kd.SCORERS:
        out[f"score_{scorer}_org"] = _score_query(scorer, "org")
        out[f"score_{scorer}_page"] = _score_query(scorer, "page")
    out |= {
        "match_strict": _match_query(fx.org, ORG),
        "match_default_threshold": _match_query(fx.pages, PAGE),
        "match_token_sort": _match_query(fx.pages, PAGE_SORT),
        "match_high_threshold": _match_query(fx.org, ORG_HIGH),
        "match_with_extras": _match_query(fx.org, ORG_EXTRAS),
        "match_rank_dups": _match_query(fx.parts, PART),
        "match_rank_groups": _match_query(fx.parts, PART, rank_checks),
        "match_relaxed": _match_query(fx.pages_moved, PAGE_RELAXED),
        "prefiltered_match": prefiltered_match,
        "unmatched_left": unmatched_left,
        "lei_match_flag": _match_query(fx.pages, PAGE, lei_confirmed),
        "validate_scores": _match_query(fx.org, ORG, kd.validate_lei_scores),
        "run_summary": _match_query(fx.pages_moved, PAGE_RELAXED, summary(PAGE_RELAXED)),
        "input_summary": lambda spark, d: kd.input_summary(*fx.org(spark, d), ORG),
        "truth_pairs": truth_pairs,
        "truth_misses": truth_misses,
        "miss_reasons": miss_reasons,
        "scorer_comparison": scorer_comparison,
        "unique_pairs": _match_query(fx.parts, PART, lambda r: kd.unique_pairs(r, PART)),
        "preview": _match_query(fx.org, ORG, lambda r: kd.preview(r, ORG)),
        "csv_roundtrip": csv_roundtrip,
        "match_job": match_job,
        "match_blanks": match_blanks,
        "schema_listing": schema_listing,
        "narrow_miss_reasons": narrow_miss_reasons,
    }
    if llm:
        out |= llm.queries() | {"pipeline": corpus_pipeline.run}
    return out


def oracle_sql() -> dict[str, str]:
    org = sql.keyed("org", ORG)
    ranked = lambda fixture, cfg: f"with {sql.match_rows(fixture, cfg)} "
    misses = _misses_sql(ORG_TRUTH)
    stats = """select lei_match, count(*) as n, round_even(avg(fuzzy_score), 2) as avg_score,
        min(fuzzy_score) as min_score, max(fuzzy_score) as max_score,
        round_even(median(fuzzy_score), 2) as median_score from ranked group by lei_match"""
    compare = " union all ".join(
        f"select '{s}' as scorer, count(*) as n_pairs, count(*) filter ({s} >= {CUT}::double) as n_at_cut, "
        f"round_even(avg({s}), 2) as mean_score from t"
        for s in kd.SCORERS
    )
    out = {
        "normalize_names": f"""select kind, id, {sql.name_key('text')} as name_key from (
            select 'document' as kind, doc_id as id, text from documents
            union all select 'branch', branch_id, institution_name from ({sql.ORG_LEFT})
            union all select 'entity', entity_id, SP_ENTITY_NAME from ({sql.ORG_RIGHT}))""",
        "normalize_countries": f"""select side, id, country, {sql.country_key('country')} as country_key from (
            select 'left' as side, branch_id as id, country_name as country from ({sql.ORG_LEFT})
            union all select 'right', entity_id, SP_COUNTRY_NAME from ({sql.ORG_RIGHT}))""",
        "lei_sets": f"select page_id, unnest({sql.lei_set('codes')}) as lei from ({sql.PAGES})",
        "candidate_counts": f"""with {org},
            lc as (select ck, count(*) as n, count(distinct nk) as d from l group by ck),
            rc as (select ck, count(*) as n, count(distinct nk) as d from r group by ck)
            select lc.ck as country_key, lc.n as left_rows, rc.n as right_rows, lc.n * rc.n as n_pairs,
            lc.d * rc.d as n_name_pairs from lc join rc on lc.ck = rc.ck""",
    }
    for scorer in kd.SCORERS:
        out[f"score_{scorer}_org"] = _score_sql(scorer, "org")
        out[f"score_{scorer}_page"] = _score_sql(scorer, "page")
    out |= {
        "match_strict": sql.match_sql("org", ORG),
        "match_default_threshold": sql.match_sql("page", PAGE),
        "match_token_sort": sql.match_sql("page", PAGE_SORT),
        "match_high_threshold": sql.match_sql("org", ORG_HIGH),
        "match_with_extras": sql.match_sql("org", ORG_EXTRAS),
        "match_rank_dups": sql.match_sql("part", PART),
        "match_rank_groups": ranked("part", PART)
        + """select l_name as left_p_name, l_country as left_p_type, count(*) as n, min(match_rank) as first,
            max(match_rank) as last, count(distinct match_rank) as n_ranks from ranked group by l_name, l_country""",
        "match_relaxed": sql.match_sql("moved", PAGE_RELAXED),
        "prefiltered_match": sql.match_sql("org", ORG, INDUSTRY),
        "unmatched_left": ranked("org", replace(ORG_TRUTH, score_threshold=90.0))
        + """select pos as branch_id, name as institution_name, country as country_name from l
            where not exists (select 1 from ranked where l_pos = pos)""",
        "lei_match_flag": ranked("page", PAGE)
        + """select left_page_id, right_page_id, l_lei as left_codes, r_lei as right_codes
            from ranked where lei_match""",
        "validate_scores": ranked("org", ORG) + stats,
        "run_summary": ranked("moved", PAGE_RELAXED)
        + """select count(*) as n_pairs, count(*) filter (country_match) as n_strict,
            count(*) filter (not country_match) as n_relaxed,
            (select count(*) from (select distinct l_name, l_country from ranked)) as n_left_entities from ranked""",
        "input_summary": f"""with {org} select (select count(*) from l) as left_rows, count(*) as right_rows,
            count(distinct ck) as right_countries from r""",
        "truth_pairs": f"with {org}, {sql.truth(ORG)} select * from truth",
        "truth_misses": misses + "select * from missed",
        "miss_reasons": misses + "select miss_reason, count(*) as n from missed group by miss_reason",
        "scorer_comparison": f"""with {org}, {sql.truth(ORG)},
            {sql.scores('select left_key as a, right_key as b from truth', kd.SCORERS)},
            t as (select scored.* from truth join scored on a = left_key and b = right_key) {compare}""",
        "unique_pairs": ranked("part", PART)
        + f"""select {sql.result_columns(PART).replace('fuzzy_score, ', 'fuzzy_score, ')} from ranked
            qualify row_number() over (partition by l_name, r_name
              order by fuzzy_score desc, match_rank, l_country, l_lei, r_country, r_lei, lei_match, country_match) = 1""",
        "preview": ranked("org", ORG)
        + """select l_name as left_institution_name, l_country as left_country_name, l_lei as left_lei,
            r_name as right_SP_ENTITY_NAME, r_lei as right_SP_LEI, fuzzy_score, lei_match, match_rank from ranked
            order by l_name, l_country, match_rank limit 20""",
        "csv_roundtrip": sql.match_sql("org", ORG),
        "match_job": sql.match_sql("org", ORG, INDUSTRY).replace(" from ranked", ", count(*) over () as n_rows from ranked"),
        "match_blanks": sql.match_sql("blank", replace(PAGE_BLANK, left_extra_cols=("page_id",))).replace(
            " from ranked", ", null::varchar as left_branch_code from ranked"
        ),
        "schema_listing": """select column_name, case column_type when 'INTEGER' then 'int' when 'VARCHAR' then 'string'
            else lower(column_type) end as column_type from (describe select * from customer)""",
        "narrow_miss_reasons": _misses_sql(ORG_NARROW) + "select miss_reason, count(*) as n from missed group by miss_reason",
    }
    if llm:
        out |= llm.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out


def _misses_sql(cfg) -> str:
    """CTEs ending in ``missed``: identifier-confirmed pairs that the run does not return."""
    misses = (
        f"with {sql.match_rows('org', cfg)}, {sql.truth(cfg)}, "
        "gone as materialized (select * from truth where not exists (select 1 from ranked "
        "where ranked.l_pos = truth.left_id and ranked.r_pos = truth.right_id)), "
    )
    # The misses also lie across countries, so they are scored apart from the run's pairs.
    rescored = sql.scores("select left_key as a, right_key as b from gone", ["ensemble"])
    for cte in ("dp", "nm0", "nm1", "nm", "j0", "j1", "j2", "j3", "scored"):
        rescored = _rename(rescored, cte)
    return misses + rescored + f""", missed as (select left_id, right_id, left_country_key, right_country_key,
        round_even(ensemble, 2) as fuzzy_score,
        case when left_country_key <> right_country_key and ensemble < {cfg.score_threshold}::double
               then 'country_mismatch+low_score'
             when left_country_key <> right_country_key then 'country_mismatch'
             when ensemble < {cfg.score_threshold}::double then 'low_fuzzy_score'
             else 'outranked' end as miss_reason
      from gone join scored2 on a = left_key and b = right_key) """


def _rename(text: str, cte: str) -> str:
    """The same CTE chain under second names, for use beside the first."""
    import re

    return re.sub(rf"\b{cte}\b(?!\()", cte + "2", text)
