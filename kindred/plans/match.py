"""The linking pipeline: block, score, keep the best, retry across countries, rank."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MatchConfig
from ..functions.text import lei_overlap
from ..operators.compare import best_names
from ..operators.ordinal import hot_groups, spread, with_ordinal
from ..operators.rows import (
    BLOCK, COPIES, NAME, POSITION, distinct_names, left_rows, right_rows, top_rows,
)
from ..operators.stage import staged


def candidate_counts(left: DataFrame, right: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Size of the strict pass per country: rows on both sides, row pairs, name pairs.

    Counted from the sides' totals; the pairs themselves are never formed.
    """

    def side(rows, who):
        names = distinct_names(rows)
        return names.groupBy(BLOCK).agg(
            F.sum(COPIES).alias(f"{who}_rows"), F.count(F.lit(1)).alias(f"_{who}_names")
        )

    both = side(left_rows(left, cfg), "left").join(side(right_rows(right, cfg), "right"), BLOCK)
    return both.select(
        F.col(BLOCK).alias("country_key"),
        "left_rows",
        "right_rows",
        (F.col("left_rows") * F.col("right_rows")).alias("n_pairs"),
        (F.col("_left_names") * F.col("_right_names")).alias("n_name_pairs"),
    )


def name_matches(left: DataFrame, right: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Best distinct right names of every distinct left name of the same country."""
    names = [staged(distinct_names(rows)) for rows in (left_rows(left, cfg), right_rows(right, cfg))]
    return best_names(*names, cfg).select(
        F.col(BLOCK).alias("country_key"),
        F.col("_left_name").alias("left_key"),
        F.col("_right_name").alias("right_key"),
        F.col("_score").alias("score"),
    )


def unmatched_names(names: DataFrame, strict: DataFrame) -> DataFrame:
    """Distinct (country, name) of the left side that the strict pass left without a match."""
    found = strict.select(BLOCK, F.col("_left_name").alias(NAME)).distinct()
    return names.select(BLOCK, NAME).join(found, [BLOCK, NAME], "left_anti")


def relaxed_names(unmatched: DataFrame, right_names: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Best right names anywhere for names without a strict match.

    Nothing of their own country reaches the threshold, so the whole right side can be
    compared by distinct name, whatever the country, without finding such a pair again.
    """
    anywhere = F.lit("").alias(BLOCK)
    names = unmatched.select(anywhere, NAME).distinct()
    first = right_names.groupBy(NAME).agg(F.min(POSITION).alias(POSITION)).select(anywhere, NAME, POSITION)
    return best_names(staged(names), staged(first), cfg)


def _picked(names: DataFrame, right: DataFrame, keys, cfg: MatchConfig) -> DataFrame:
    """Turn best names into the best right rows, with what each needs to be ranked.

    Only a name's first ``top_n`` rows can be among a left name's best, and the best rows
    lie within the best names, so hot names and repeated rows never multiply.
    """
    block = [k for k in keys if k == BLOCK]
    # Few names match: only their rows are shuffled and numbered.
    wanted = names.select(*block, F.col("_right_name").alias(NAME)).distinct()
    rows = top_rows(right.join(wanted, list(keys), "left_semi"), keys, [F.col(POSITION)], cfg.top_n)
    pairs = names.drop(POSITION).withColumnRenamed("_right_name", NAME)
    joined = pairs.join(rows if block else rows.drop(BLOCK), list(keys))
    left_name = [BLOCK, "_left_name"]
    order = [F.desc("_score"), F.col(POSITION), F.col(NAME), F.col("_nth")]
    best = top_rows(joined, left_name, order, cfg.top_n, "_place")
    best = best.withColumn("fuzzy_score", F.bround("_score", 2))
    by_score = Window.partitionBy(*left_name).orderBy(F.desc("fuzzy_score"))
    alike = Window.partitionBy(*left_name, "fuzzy_score")
    return (
        best.withColumn("_above", F.rank().over(by_score) - 1)
        .withColumn("_alike", F.count(F.lit(1)).over(alike))
        .withColumn("_among", F.col("_place") - F.col("_above"))
        .drop(NAME, POSITION, "_nth", "_place", "_score")
        .withColumnRenamed("_left_name", NAME)
    )


def _result_columns(cfg: MatchConfig) -> list[str]:
    first = [f"left_{c}" for c in (cfg.left_name_col, cfg.left_country_col, cfg.left_lei_col)]
    first += [f"right_{c}" for c in (cfg.right_name_col, cfg.right_country_col, cfg.right_lei_col)]
    first += ["fuzzy_score", "lei_match", "country_match", "match_rank"]
    extras = [f"left_{c}" for c in cfg.left_extra_cols] + [f"right_{c}" for c in cfg.right_extra_cols]
    return list(dict.fromkeys(first + extras))


def match(
    left: DataFrame, right: DataFrame, cfg: MatchConfig | None = None, right_filter: Column | None = None,
    ordered: bool = True,
) -> DataFrame:
    """Link every left row to its best right rows.

    One row per kept pair: key columns, score, identifier and country flags, rank, extras;
    sorted by left name, left country and rank, unless ``ordered`` is False, which spares the
    sort where a summary follows.  ``right_filter`` narrows the right side first.  The
    distinct names of both sides and the strict matches among them are staged when this is
    called; the rest runs with the first action.
    """
    cfg = cfg or MatchConfig()
    if right_filter is not None:
        right = right.filter(right_filter)
    l, r = left_rows(left, cfg), right_rows(right, cfg)
    left_names, right_names = staged(distinct_names(l)), staged(distinct_names(r))

    strict = staged(best_names(left_names, right_names, cfg))
    found = _picked(strict, r, (BLOCK, NAME), cfg).withColumn("country_match", F.lit(True))
    matched = strict.select(BLOCK, F.col("_left_name").alias(NAME))
    if cfg.relax_country:
        missed = unmatched_names(left_names, strict)
        wide = _picked(relaxed_names(missed, right_names, cfg), r, (NAME,), cfg).drop(BLOCK)
        wide = missed.join(wide, NAME).withColumn("country_match", F.lit(False))
        found = found.unionByName(wide)
        matched = matched.unionByName(missed.filter(F.col(NAME) != "").select(BLOCK, NAME))

    name, country = f"left_{cfg.left_name_col}", f"left_{cfg.left_country_col}"
    # Only rows of names that can match need numbers; nameless ones never do (the strict
    # pass has none).  No filter may hold for all matched names: Catalyst would infer it
    # for the rows too and push it into their normalisation, substituting every step into
    # every other.  A union keeps only what holds on both sides.
    matched = staged(matched.distinct())
    wanted = lambda rows: rows.join(matched, [BLOCK, NAME], "left_semi")
    rows = with_ordinal(wanted(l), [name, country], hot_groups(wanted(left_names)))
    found, keys = spread(found, rows)
    # Copies of a left row share their matches, so the rank among all of them has a closed
    # form: everything scored higher, then equal scores of earlier copies, then own order.
    rank = F.col("_group") * F.col("_above") + (F.col("_ordinal") - 1) * F.col("_alike") + F.col("_among")
    lei = [F.col(f"`left_{cfg.left_lei_col}`"), F.col(f"`right_{cfg.right_lei_col}`")]
    if dict(l.dtypes)[f"left_{cfg.left_lei_col}"] != "string":
        lei[0] = F.lit(None).cast("string")  # only text holds identifier lists
    result = (
        rows.join(found, keys)
        .withColumn("match_rank", rank.cast("bigint"))
        .withColumn("lei_match", lei_overlap(*lei))
    )
    result = result.select(*[F.col(f"`{c}`") for c in _result_columns(cfg)])
    order = [F.col(f"`{c}`").asc_nulls_last() for c in (name, country, "match_rank")]
    return result.orderBy(*order) if ordered else result


def unique_pairs(results: DataFrame, cfg: MatchConfig) -> DataFrame:
    """One row per (left name, right name): the best-scoring, ties by the row's content."""
    keys = [f"left_{cfg.left_name_col}", f"right_{cfg.right_name_col}"]
    rest = [c for c in results.columns if c not in keys and c not in ("fuzzy_score", "match_rank")]
    order = [F.desc("fuzzy_score"), F.col("match_rank")] + [F.col(f"`{c}`") for c in rest]
    return top_rows(results, [F.col(f"`{k}`") for k in keys], order, 1).drop("_nth")
