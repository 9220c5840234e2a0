"""Summaries of a run and comparison with the identifier-confirmed pairs."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SCORERS, MatchConfig
from ..functions.scorers import score_column
from ..functions.text import lei_set, normalise
from ..operators.rows import BLOCK, NAME, POSITION, left_rows, right_rows
from .match import match


def validate_lei_scores(results: DataFrame) -> DataFrame:
    """Score statistics by ``lei_match``; tables without those columns come back as given.

    Scores have two decimals, so the exact median keeps at most 10,001 distinct values.
    """
    if not {"lei_match", "fuzzy_score"} <= set(results.columns):
        return results
    score = F.col("fuzzy_score")
    return results.groupBy("lei_match").agg(
        F.count(score).alias("n"),
        F.bround(F.avg(score), 2).alias("avg_score"),
        F.bround(F.min(score), 2).alias("min_score"),
        F.bround(F.max(score), 2).alias("max_score"),
        F.bround(F.median(score), 2).alias("median_score"),
    )


def run_summary(results: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Pairs found, by pass, and the number of distinct left (name, country)."""
    entity = F.struct(F.col(f"`left_{cfg.left_name_col}`"), F.col(f"`left_{cfg.left_country_col}`"))
    return results.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.count_if("country_match").alias("n_strict"),
        F.count_if(~F.col("country_match")).alias("n_relaxed"),
        F.count_distinct(entity).alias("n_left_entities"),
    )


def input_summary(left: DataFrame, right: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Rows per side and number of distinct right country keys."""
    both = left.select(F.lit(1).alias("l"), F.lit(0).alias("r"), F.lit(None).cast("string").alias("key")).union(
        right_rows(right, cfg).select(F.lit(0), F.lit(1), BLOCK)
    )
    return both.agg(
        F.sum("l").alias("left_rows"),
        F.sum("r").alias("right_rows"),
        F.count_distinct("key").alias("right_countries"),
    )


KEYS = ["left_key", "left_country_key", "right_key", "right_country_key"]


def _with_leis(rows: DataFrame, who: str, lei_col: str) -> DataFrame:
    text = dict(rows.dtypes)[f"{who}_{lei_col}"] == "string" or who == "right"
    leis = lei_set(F.col(f"`{who}_{lei_col}`")) if text else F.array().cast("array<string>")
    return rows.select(
        F.col(NAME).alias(f"{who}_key"),
        F.col(BLOCK).alias(f"{who}_country_key"),
        F.col(POSITION).alias(f"{who}_id"),
        F.array_sort(leis).alias(f"_{who}_leis"),
    )


def _sharing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Join on any shared identifier, once per pair.

    A pair sharing several is kept at the smallest, so its repeats need no second shuffle.
    """
    pairs = left.withColumn("_lei", F.explode("_left_leis")).join(
        right.withColumn("_lei", F.explode("_right_leis")), "_lei"
    )
    least = F.array_min(F.array_intersect("_left_leis", "_right_leis"))
    return pairs.filter(F.col("_lei") == least).drop("_lei", "_left_leis", "_right_leis")


def truth_pairs(left: DataFrame, right: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Pairs of rows that share an identifier, once each; both sides need an id column."""
    if cfg.left_id_col is None or cfg.right_id_col is None:
        raise ValueError("truth pairs need left_id_col and right_id_col")
    return _sharing(
        _with_leis(left_rows(left, cfg), "left", cfg.left_lei_col),
        _with_leis(right_rows(right, cfg), "right", cfg.right_lei_col),
    )


def truth_groups(left: DataFrame, right: DataFrame, cfg: MatchConfig) -> DataFrame:
    """The pairs sharing an identifier, counted by names and countries.

    Rows alike in name, country and identifiers are merged before the join, so copies of a
    record add to a count instead of multiplying pairs.
    """

    def merged(rows, who, lei_col):
        kept = _with_leis(rows, who, lei_col).drop(f"{who}_id")
        return kept.groupBy(*kept.columns).agg(F.count(F.lit(1)).alias(f"_{who}_rows"))

    pairs = _sharing(
        merged(left_rows(left, cfg), "left", cfg.left_lei_col),
        merged(right_rows(right, cfg), "right", cfg.right_lei_col),
    )
    return pairs.groupBy(*KEYS).agg(F.sum(F.col("_left_rows") * F.col("_right_rows")).alias("n_pairs"))


def _reason(score, cfg: MatchConfig):
    elsewhere = F.col("left_country_key") != F.col("right_country_key")
    low = score < cfg.score_threshold
    return (
        F.when(elsewhere & low, "country_mismatch+low_score")
        .when(elsewhere, "country_mismatch")
        .when(low, "low_fuzzy_score")
        .otherwise("outranked")
    )


def truth_misses(left: DataFrame, right: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Identifier-confirmed pairs the run does not return, with score and reason."""
    extras = {
        "left_extra_cols": tuple(dict.fromkeys([*cfg.left_extra_cols, cfg.left_id_col])),
        "right_extra_cols": tuple(dict.fromkeys([*cfg.right_extra_cols, cfg.right_id_col])),
    }
    truth = truth_pairs(left, right, cfg)
    found = match(left, right, replace(cfg, **extras), ordered=False).select(
        F.col(f"`left_{cfg.left_id_col}`").alias("left_id"),
        F.col(f"`right_{cfg.right_id_col}`").alias("right_id"),
    )
    missed = truth.join(found, ["left_id", "right_id"], "left_anti")
    score = score_column(cfg.scorer, F.col("left_key"), F.col("right_key"))
    return missed.withColumn("_raw", score).select(
        "left_id", "right_id", "left_country_key", "right_country_key",
        F.bround("_raw", 2).alias("fuzzy_score"), _reason(F.col("_raw"), cfg).alias("miss_reason"),
    )


def miss_reasons(left: DataFrame, right: DataFrame, cfg: MatchConfig) -> DataFrame:
    """Number of identifier-confirmed row pairs the run does not return, per reason.

    Works on counts by names and countries; no pair of rows is listed.
    """
    names = {
        "left_key": cfg.left_name_col, "left_country_key": cfg.left_country_col,
        "right_key": cfg.right_name_col, "right_country_key": cfg.right_country_col,
    }
    found = match(left, right, cfg, ordered=False).filter("lei_match").select(
        *[F.col(f"`{key.split('_')[0]}_{c}`").alias(key) for key, c in names.items()]
    )
    for who in ("left", "right"):
        found = normalise(found, f"{who}_key", f"{who}_country_key")
    found = found.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_found"))
    missed = (
        truth_groups(left, right, cfg)
        .join(found, KEYS, "left")
        .withColumn("n_missed", F.col("n_pairs") - F.coalesce("_found", F.lit(0)))
        .filter("n_missed > 0")
    )
    score = score_column(cfg.scorer, F.col("left_key"), F.col("right_key"))
    scored = missed.withColumn("_raw", score).withColumn("miss_reason", _reason(F.col("_raw"), cfg))
    return scored.groupBy("miss_reason").agg(F.sum("n_missed").alias("n"))


def compare_scorers(groups: DataFrame, cut: float = 80.0, scorers=SCORERS) -> DataFrame:
    """Per scorer: pairs scoring at least ``cut`` and the mean score.

    ``groups`` has ``left_key``, ``right_key`` and ``n_pairs``, as ``truth_groups`` gives
    them; every pair of names is scored once, whatever its number of row pairs.
    """
    weighted = groups.groupBy("left_key", "right_key").agg(F.sum("n_pairs").alias("_pairs"))
    scored = weighted.select(
        "_pairs", *[score_column(s, F.col("left_key"), F.col("right_key")).alias(s) for s in scorers]
    )
    long = scored.unpivot(["_pairs"], list(scorers), "scorer", "score")
    return long.groupBy("scorer").agg(
        F.sum("_pairs").alias("n_pairs"),
        F.sum(F.when(F.col("score") >= cut, F.col("_pairs")).otherwise(0)).alias("n_at_cut"),
        F.bround(F.sum(F.col("score") * F.col("_pairs")) / F.sum("_pairs"), 2).alias("mean_score"),
    )
