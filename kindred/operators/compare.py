"""Best-scoring names within blocks, by tiles of bounded size."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import native
from ..functions.scoring import FAR_LENGTH_RATIO, SCREEN_SIZE, best_pairs
from . import jvm
from .rows import BLOCK, NAME, POSITION, top_rows
from .stage import staged

# Left names of one part of a block share tiles.
PART = "_part"
TILE = [BLOCK, PART, "_left_tile", "_right_tile"]
# Tiles are at least so many, and meet by chance in twice as many tasks as the shuffle width.
FEWEST_TILES = 48
# Scorers that compare windows have a kernel in the JVM for left names of at most 64 characters.
WINDOWED = "partial_ratio", "WRatio", "ensemble"
# About a second of work; a tile's first pairs are scored before its cutoffs rule any out.
SMALLEST_TILE = 1 << 21


def _shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def tiles(left: DataFrame, right: DataFrame, left_rows: int, right_rows: int):
    """Cut every block into tiles of at most about ``left_rows`` x ``right_rows`` names.

    Every ``_part`` of a block's left names (one number by default) has tiles of its own.  A block of any size becomes many equal tasks: each side is split by a hash of the name
    and copied once per tile of the other side.  Blocks on one side only drop out.  Where
    there are too few pairs to fill the tasks with full tiles, tiles are made smaller.
    """
    width = _shuffle_width(left)
    if PART not in left.columns:
        left = left.withColumn(PART, F.lit(0))
    sizes = left.groupBy(BLOCK, PART).agg(F.count(F.lit(1)).alias("_n_left")).join(
        right.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("_n_right")), BLOCK
    )
    pairs = sizes.agg(F.sum(F.col("_n_left").cast("double") * F.col("_n_right"))).first()[0] or 0
    tile_pairs = max(SMALLEST_TILE, pairs / max(FEWEST_TILES, width))
    # The kernel is fastest with many left names side by side.
    left_rows = min(left_rows, math.ceil(math.sqrt(2 * tile_pairs)))
    right_rows = min(right_rows, math.ceil(tile_pairs / left_rows))
    sizes = sizes.select(
        BLOCK,
        F.col(PART).alias(PART),
        F.ceil(F.col("_n_left") / left_rows).alias("_left_tiles"),
        F.ceil(F.col("_n_right") / right_rows).alias("_right_tiles"),
    )

    def cut(names, own, other):
        spread = names.join(sizes, [BLOCK, PART] if PART in names.columns else BLOCK)
        return (
            spread.withColumn(f"_{own}_tile", F.pmod(F.xxhash64(NAME), f"_{own}_tiles"))
            .withColumn(
                f"_{other}_tile",
                F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(f"_{other}_tiles") - 1)),
            )
            .drop("_left_tiles", "_right_tiles")
            # A fixed width: tiles are small in bytes but long in work, so the adaptive
            # merging of small partitions must leave them apart.
            .repartition(2 * width, *TILE)
        )

    return cut(left, "left", "right"), cut(right, "right", "left")


def best_names(left: DataFrame, right: DataFrame, cfg) -> DataFrame:
    """Each left name's ``top_n`` best right names of its block that reach the threshold.

    ``left`` holds distinct (block, name); ``right`` distinct (block, name, position); both
    are read twice, so they should be staged.
    Result: block, _left_name, _right_name, _score, _position.  Score ties go to the
    smaller position.  Pairs exist only inside a task; what leaves it is at most ``top_n``
    per left name and tile, merged by one more top-n.
    """
    scorer, threshold, top_n = cfg.scorer, cfg.score_threshold, cfg.top_n
    if scorer in native.NATIVE and cfg.native_scorers:
        return _native_best(left, right, cfg)
    if scorer == "WRatio" and cfg.split_by_length:
        return _split_weighted(left, right, cfg)
    if scorer in WINDOWED and jvm.available(left.sparkSession):
        return _jvm_best(left, right, cfg)
    return _kernel_best(left, right, cfg)


def settled_names(left: DataFrame, right: DataFrame, top_n: int) -> DataFrame:
    """(block, name) of left names that share one token with ``top_n`` right names of unlike length.

    A shared token settles the weighted score of names of unlike length, but not far so, from
    below, so the best ``top_n`` of such a name all reach that score.  Counted per token and
    lengths, never by pair; only for left names short enough for the screen, which bounds the
    lengths that meet.
    """
    size, token = F.length(NAME), F.explode(F.array_distinct(F.split(NAME, " "))).alias("_token")
    own = left.filter((F.col(NAME) != "") & (size <= SCREEN_SIZE)).select(BLOCK, NAME, size.alias("_own"), token)
    held = right.filter((F.col(NAME) != "") & (size <= FAR_LENGTH_RATIO * SCREEN_SIZE))
    held = held.select(BLOCK, size.alias("_size"), token).groupBy(BLOCK, "_token", "_size").agg(F.count(F.lit(1)).alias("_n"))
    short, long = F.least("_own", "_size"), F.greatest("_own", "_size")
    enough = (
        own.select(BLOCK, "_token", "_own").distinct().join(held, [BLOCK, "_token"])
        .filter((2 * long >= 3 * short) & (long <= FAR_LENGTH_RATIO * short))
        .groupBy(BLOCK, "_token", "_own").agg(F.sum("_n").alias("_n")).filter(F.col("_n") >= top_n)
    )
    return own.join(enough, [BLOCK, "_token", "_own"], "left_semi").select(BLOCK, NAME).distinct()


def _marked(left: DataFrame, right: DataFrame, top_n: int) -> DataFrame:
    """Left names in two parts: those whose cutoff is known beforehand need far less of the kernel."""
    settled = settled_names(left, right, top_n).withColumn(PART, F.lit(1))
    return staged(left.join(settled, [BLOCK, NAME], "left").withColumn(PART, F.coalesce(PART, F.lit(0))))


def _jvm_best(left: DataFrame, right: DataFrame, cfg) -> DataFrame:
    """``best_names`` through the kernel in the JVM; longer left names go to the NumPy kernel."""
    left = left.select(BLOCK, NAME).filter(F.col(NAME) != "")
    long = left.filter(F.length(NAME) > SCREEN_SIZE)
    short, others = left.filter(F.length(NAME) <= SCREEN_SIZE), right.select(BLOCK, NAME, POSITION)
    if cfg.score_threshold > 0:  # a nameless right row scores 0
        others = others.filter(F.col(NAME) != "")
    if cfg.scorer != "partial_ratio":
        short = _marked(short, others, cfg.top_n)
    left_tiles, right_tiles = tiles(short, others, cfg.left_tile_rows, cfg.right_tile_rows)
    sure = F.col(PART) == 1
    scored = jvm.best_pairs(left_tiles, right_tiles, TILE, sure, cfg).select(
        BLOCK, "_left_name", "_right_name", "_score", POSITION
    )
    order = [F.desc("_score"), F.col(POSITION), F.col("_right_name")]
    best = top_rows(scored, [BLOCK, "_left_name"], order, cfg.top_n).drop("_nth")
    return best if long.isEmpty() else best.unionByName(_kernel_best(long, right, cfg))


def _kernel_best(left: DataFrame, right: DataFrame, cfg, apart_only: bool = False) -> DataFrame:
    """``best_names`` through the NumPy kernel, tile by tile."""
    scorer, threshold, top_n = cfg.scorer, cfg.score_threshold, cfg.top_n
    position = right.schema[POSITION].dataType.simpleString()
    schema = f"{BLOCK} string, _left_name string, _right_name string, _score double, {POSITION} {position}"
    columns = [BLOCK, "_left_name", "_right_name", "_score", POSITION]
    weighted = scorer in ("WRatio", "ensemble") and not apart_only

    def compare(lefts: pd.DataFrame, rights: pd.DataFrame) -> pd.DataFrame:
        lefts = lefts[lefts[NAME] != ""]
        if threshold > 0:  # a nameless right row scores 0
            rights = rights[rights[NAME] != ""]
        if not len(lefts) or not len(rights):
            return pd.DataFrame(columns=columns)
        rights = rights.sort_values([POSITION, NAME])
        names, others = lefts[NAME].to_numpy(), rights[NAME].to_numpy()
        sure = lefts[PART].to_numpy() == 1 if weighted else None
        li, ri, score = best_pairs(scorer, list(names), list(others), threshold, top_n, apart_only, sure)
        return pd.DataFrame(
            {
                BLOCK: lefts[BLOCK].iloc[0],
                "_left_name": names[li],
                "_right_name": others[ri],
                "_score": score,
                POSITION: rights[POSITION].to_numpy()[ri],
            }
        )

    left, right = left.select(BLOCK, NAME), right.select(BLOCK, NAME, POSITION)
    if weighted:
        left = _marked(left, right, top_n)
    left_tiles, right_tiles = tiles(left, right, cfg.left_tile_rows, cfg.right_tile_rows)
    scored = left_tiles.groupBy(*TILE).cogroup(right_tiles.groupBy(*TILE)).applyInPandas(compare, schema)
    order = [F.desc("_score"), F.col(POSITION), F.col("_right_name")]
    return top_rows(scored, [BLOCK, "_left_name"], order, top_n).drop("_nth")


def _features(names: DataFrame, scorer: str) -> DataFrame:
    """What a native scorer needs of one name, made once per distinct name."""
    if scorer == "token_set_ratio":
        return names.withColumn("_set", native.word_set(F.col(NAME)))
    if scorer == "WRatio":
        names = _features(_features(names, "ratio"), "token_set_ratio")
        return (
            names.withColumn("_sorted", native.sorted_words(F.col(NAME)))
            .withColumn("_mask_sorted", native.masks(F.col("_sorted")))
            .withColumn("_chars_sorted", native.chars(F.col("_sorted")))
            .drop("_sorted")
        )
    text = native.sorted_words(F.col(NAME)) if scorer == "token_sort_ratio" else F.col(NAME)
    return (
        names.withColumn("_text", text)
        .withColumn("_mask", native.masks(F.col("_text")))
        .withColumn("_chars", native.chars(F.col("_text")))
        .withColumn("_len", F.length("_text"))
        .drop("_text")
    )


def _pair_lcs(mask, chars_):
    la, lb = F.col("l_len"), F.col("r_len")
    return F.when(la <= lb, native.lcs_with(F.col("l" + mask), la, F.col("r" + chars_))).otherwise(
        native.lcs_with(F.col("r" + mask), lb, F.col("l" + chars_))
    )


def _split_weighted(left: DataFrame, right: DataFrame, cfg) -> DataFrame:
    """WRatio split by length ratio.

    Pairs of alike length score max(ratio, 0.95 token_sort, 0.95 token_set): Columns, in a
    join of tiles.  Only pairs of unlike length, whose terms need window alignments, go to
    the NumPy kernel.  Both halves keep their best ``top_n``; one more top-n merges them.
    """
    alike = _native_best(left, right, cfg)
    apart = _kernel_best(left, right, cfg, apart_only=True)
    order = [F.desc("_score"), F.col(POSITION), F.col("_right_name")]
    return top_rows(alike.unionByName(apart), [BLOCK, "_left_name"], order, cfg.top_n).drop("_nth")


def _native_best(left: DataFrame, right: DataFrame, cfg) -> DataFrame:
    """``best_names`` for scorers written as Columns: tiles meet in an equi-join.

    Pairs exist only in the task that joins two tiles; they are scored, cut at the
    threshold and limited to ``top_n`` per left name before anything is shuffled.
    For ratio-like scorers names of too unlike length are passed over before any LCS:
    200 x min / (|a| + |b|) bounds the score.
    """
    scorer, threshold = cfg.scorer, cfg.score_threshold
    left = _features(left.select(BLOCK, NAME).filter(F.col(NAME) != ""), scorer)
    right = right.select(BLOCK, NAME, POSITION)
    if threshold > 0:  # a nameless right row scores 0
        right = right.filter(F.col(NAME) != "")
    right = _features(right, scorer)
    left_tiles, right_tiles = tiles(left, right, cfg.left_tile_rows, cfg.right_tile_rows)
    own = [c for c in left_tiles.columns if c not in TILE]
    other = [c for c in right_tiles.columns if c not in TILE]
    pairs = left_tiles.select(*TILE, *[F.col(c).alias("l" + c) for c in own]).join(
        right_tiles.select(*TILE, *[F.col(c).alias("r" + c) for c in other]), TILE
    )
    la, lb = F.col("l_len"), F.col("r_len")
    if scorer == "token_set_ratio":
        score = native.token_set_from(F.col("l_set"), F.col("r_set"))
    elif scorer == "WRatio":
        pairs = pairs.filter((F.least(la, lb) > 0) & (2 * F.greatest(la, lb) < 3 * F.least(la, lb)))
        ratio = F.lit(200.0) * _pair_lcs("_mask", "_chars") / (la + lb)
        sort = F.lit(200.0) * _pair_lcs("_mask_sorted", "_chars_sorted") / (la + lb)
        token = F.greatest(sort, native.token_set_from(F.col("l_set"), F.col("r_set")))
        score = F.greatest(ratio, F.lit(0.95) * token)
    else:
        score = F.when(la + lb > 0, F.lit(200.0) * _pair_lcs("_mask", "_chars") / (la + lb)).otherwise(F.lit(0.0))
        if threshold > 0:
            most = F.lit(200.0) * F.least(la, lb) / (la + lb)
            pairs = pairs.filter(most >= threshold)
    scored = pairs.select(
        F.col(BLOCK), F.col("l" + NAME).alias("_left_name"), F.col("r" + NAME).alias("_right_name"),
        score.alias("_score"), F.col("r" + POSITION).alias(POSITION),
    ).filter(F.col("_score") >= threshold)
    order = [F.desc("_score"), F.col(POSITION), F.col("_right_name")]
    return top_rows(scored, [BLOCK, "_left_name"], order, cfg.top_n).drop("_nth")
