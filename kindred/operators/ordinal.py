"""Running number of rows within groups of any size."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .rows import BLOCK, COPIES, NAME, POSITION
from .stage import staged

HOT_ROWS = 1_000_000
SLICE_ROWS = 250_000


def hot_groups(names: DataFrame, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, int] | None:
    """Names with more than ``hot_rows`` rows and the number of their rows, or None.

    ``names`` should be staged.
    """
    hot = names.filter(F.col(COPIES) > hot_rows).select(BLOCK, NAME, COPIES)
    total = hot.agg(F.sum(COPIES)).first()[0]
    return (hot.drop(COPIES), total) if total else None


def _sliced(rows: DataFrame, total: int, slice_rows: int) -> DataFrame:
    """Rows of hot names with a slice number that grows with the position.

    Slices are ranges of (name, position), so they hold about ``slice_rows`` rows whatever
    the positions look like; rows of one position are alike, and a running number parts them.
    Ranges come from a sample, so the numbers are stored before anything is counted.
    """
    slices = math.ceil(total / slice_rows)
    spread_out = rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(
        slices, BLOCK, NAME, POSITION, "_salt"
    )
    return staged(spread_out.withColumn("_slice", F.spark_partition_id() + 1).drop("_salt"))


def with_ordinal(
    rows: DataFrame, keys, hot: tuple[DataFrame, int] | None, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Add ``_ordinal`` (1-based order by position) and ``_group`` (size) within ``keys``.

    ``keys`` must determine block and name.  Rows of hot names are cut into slices along the
    position; slices are numbered apart and shifted by the sizes of those before them, so no
    task ever holds such a group.  Then ``_slice`` is added too (0 for all other rows).
    """
    group = Window.partitionBy(*keys)

    def numbered(some):
        return some.withColumn("_ordinal", F.row_number().over(group.orderBy(POSITION))).withColumn(
            "_group", F.count(F.lit(1)).over(group)
        )

    if hot is None:
        return numbered(rows)
    names, total = hot
    cold = numbered(rows.join(names, [BLOCK, NAME], "left_anti")).withColumn("_slice", F.lit(0))
    marked = _sliced(rows.join(names, [BLOCK, NAME], "left_semi"), total, slice_rows)
    before = group.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    shift = (
        marked.groupBy(*keys, "_slice")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_shift", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .withColumn("_group", F.sum("_rows").over(group))
        .drop("_rows")
    )
    local = Window.partitionBy(*keys, "_slice").orderBy(POSITION)
    # Keys may be null: compare null-safe, under names of their own.
    own = {k: f"_key_{i}" for i, k in enumerate([*keys, "_slice"])}
    shift = shift.withColumnsRenamed(own)
    same = reduce(lambda x, y: x & y, [F.col(f"`{k}`").eqNullSafe(F.col(v)) for k, v in own.items()])
    joined = marked.withColumn("_local", F.row_number().over(local)).join(shift, same)
    joined = joined.withColumn("_ordinal", F.col("_local") + F.col("_shift")).drop("_local", "_shift", *own.values())
    return cold.unionByName(joined)


def spread(found: DataFrame, rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """What was found for each name, copied to the slices of its rows, and the join's keys.

    At most ``top_n`` rows are copied per slice, so a hot name's rows join slice by slice.
    """
    if "_slice" not in rows.columns:
        return found, [BLOCK, NAME]
    slices = rows.select(BLOCK, NAME, "_slice").distinct()
    return found.join(slices, [BLOCK, NAME]), [BLOCK, NAME, "_slice"]
