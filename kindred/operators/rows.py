"""Input rows with their comparison keys, and the distinct names among them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalise

BLOCK, NAME, POSITION = "_block", "_name", "_position"
COPIES = "_copies"


def column(df: DataFrame, name: str) -> Column:
    """The named column, or a null string where the table has none."""
    if name in df.columns:
        return F.col(f"`{name}`")
    return F.lit(None).cast("string")


def keyed_rows(df, prefix, name_col, country_col, lei_col, extra_cols, id_col, required=()):
    """Rows under their output names plus block key, name key and tie-breaking position.

    Only the mapped columns are read.  The position is the id column if one is given,
    else the row's content, so equal rows are interchangeable and order is never random.
    """
    for needed in required:
        if needed not in df.columns:
            raise ValueError(f"input has no column {needed!r}")
    wanted = list(dict.fromkeys([name_col, country_col, lei_col, *extra_cols]))
    kept = [column(df, c).alias(prefix + c) for c in wanted]
    if id_col is None:
        position = F.to_json(F.struct(*[column(df, c).alias(f"c{i}") for i, c in enumerate(wanted)]))
    elif id_col not in df.columns:
        raise ValueError(f"input has no id column {id_col!r}")
    else:
        kind = df.schema[id_col].dataType
        position = F.col(f"`{id_col}`")
        if isinstance(kind, T.IntegralType):
            position = position.cast("bigint")
        elif not isinstance(kind, T.StringType):
            raise ValueError(f"id column {id_col!r} must hold integers or strings")
    rows = df.select(
        column(df, country_col).alias(BLOCK),
        column(df, name_col).alias(NAME),
        position.alias(POSITION),
        *kept,
    )
    return normalise(rows, NAME, BLOCK)


def left_rows(left: DataFrame, cfg) -> DataFrame:
    return keyed_rows(
        left, "left_", cfg.left_name_col, cfg.left_country_col, cfg.left_lei_col,
        cfg.left_extra_cols, cfg.left_id_col,
    )


def right_rows(right: DataFrame, cfg) -> DataFrame:
    return keyed_rows(
        right, "right_", cfg.right_name_col, cfg.right_country_col, cfg.right_lei_col,
        cfg.right_extra_cols, cfg.right_id_col,
        required=(cfg.right_name_col, cfg.right_country_col),
    )


def top_rows(rows: DataFrame, keys, order, count, rank="_nth") -> DataFrame:
    """First ``count`` rows per key.  Spark also applies the limit before the shuffle."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= count)


def distinct_names(rows: DataFrame, keys=(BLOCK, NAME)) -> DataFrame:
    """Distinct names with their number of rows and first position.

    Aggregated before the shuffle, so any number of copies of a name costs one row.
    """
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(COPIES), F.min(POSITION).alias(POSITION)
    )
