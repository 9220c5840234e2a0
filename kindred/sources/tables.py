"""Reading, writing, describing and previewing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..config import MatchConfig

FORMATS = ("parquet", "csv")
ROW_POSITION = "row_position"


def table_format(path: str, fmt: str | None) -> str:
    fmt = (fmt or ("csv" if path.lower().rstrip("/").endswith(".csv") else "parquet")).lower()
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; choose one of {', '.join(FORMATS)}")
    return fmt


def read_table(
    spark: SparkSession, path: str, fmt: str | None = None, position: bool = False, multi_line: bool = False
) -> DataFrame:
    """Read Parquet, or CSV with a header as text columns.

    CSV is split into parts of a file; ``multi_line``, needed only where fields hold line
    breaks, makes each file one task.

    ``position`` adds ``row_position``, the file order of Parquet rows, for use as an id
    column; it comes from file metadata and is the same on every read: the row number of a
    single file, else file and row number as text.
    """
    if table_format(path, fmt) == "csv":
        if position:
            raise ValueError("row positions are only available for Parquet")
        # Doubled quotes inside a quoted field, as most writers of CSV put them.
        options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line}
        return spark.read.options(**options).csv(path)
    table = spark.read.parquet(path)
    if not position:
        return table
    if len(table.inputFiles()) == 1:
        return table.withColumn(ROW_POSITION, F.col("_metadata.row_index"))
    place = F.format_string("%s#%020d", F.col("_metadata.file_path"), F.col("_metadata.row_index"))
    return table.withColumn(ROW_POSITION, place)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    """Write Parquet or CSV and return the row count, taken while writing."""
    if fmt.lower() not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}; choose one of {', '.join(FORMATS)}")
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if fmt.lower() == "csv":
        writer.options(header=True, quote='"', escape='"').csv(path)
    else:
        writer.parquet(path)
    return seen.get["rows"]


def schema_of(df: DataFrame) -> DataFrame:
    """Column names and types, in table order; no data is read."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, "column_name string, column_type string")


def preview(results: DataFrame, cfg: MatchConfig, rows: int = 20) -> DataFrame:
    """The first rows of a result, narrowed to the key columns it has."""
    wanted = [
        f"left_{cfg.left_name_col}", f"left_{cfg.left_country_col}", f"left_{cfg.left_lei_col}",
        f"right_{cfg.right_name_col}", f"right_{cfg.right_lei_col}",
        "fuzzy_score", "lei_match", "match_rank",
    ]
    shown = list(dict.fromkeys(c for c in wanted if c in results.columns))
    order = [wanted[0], wanted[1], "match_rank"]
    by = [F.col(f"`{c}`").asc_nulls_last() for c in order if c in results.columns]
    # Rows alike in the order columns differ in what follows: the whole row breaks ties.
    by += [F.col(f"`{c}`").asc_nulls_last() for c in shown if c not in order]
    return results.orderBy(*by).select(*[F.col(f"`{c}`") for c in shown]).limit(rows)
