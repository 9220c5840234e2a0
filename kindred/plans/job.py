"""The whole job: read two tables, link them, validate, preview, save."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MatchConfig
from ..operators.stage import staged
from ..sources.tables import FORMATS, ROW_POSITION, preview, read_table, table_format, write_table
from .diagnostics import run_summary, validate_lei_scores
from .match import match


@dataclass(frozen=True)
class JobReport:
    """What a job leaves behind; the tables are small summaries, computed on demand."""

    rows: int
    summary: DataFrame
    preview: DataFrame
    validation: DataFrame | None


def _read_side(spark, path, fmt, cfg, id_col, multi_line):
    """The table, and the settings with file order as its id where they name none."""
    ordered = getattr(cfg, id_col) is None and table_format(path, fmt) == "parquet"
    table = read_table(spark, path, fmt, position=ordered, multi_line=multi_line)
    return table, replace(cfg, **{id_col: ROW_POSITION}) if ordered else cfg


def run_job(
    spark: SparkSession,
    left_path: str,
    right_path: str,
    cfg: MatchConfig | None = None,
    output: str = "matches.parquet",
    output_format: str = "parquet",
    left_format: str | None = None,
    right_format: str | None = None,
    validate_lei: bool = False,
    right_filter: Column | str | None = None,
    multi_line: bool = False,
) -> JobReport:
    """Link the two tables, write the result, and summarise what was written.

    Without an id column, file order breaks ties in Parquet input and content in CSV input.
    ``right_filter``, a column or SQL text, narrows the right side first.

    The summaries read the written result back, so the linking itself runs once.
    """
    cfg = cfg or MatchConfig()
    if output_format.lower() not in FORMATS:
        raise ValueError(f"unknown format {output_format!r}; choose one of {', '.join(FORMATS)}")
    left, cfg = _read_side(spark, left_path, left_format, cfg, "left_id_col", multi_line)
    right, cfg = _read_side(spark, right_path, right_format, cfg, "right_id_col", multi_line)
    results = match(left, right, cfg, F.expr(right_filter) if isinstance(right_filter, str) else right_filter)
    if output_format.lower() == "parquet":
        rows = write_table(results, output)
        saved = read_table(spark, output)
    else:
        # Text files lose the column types, so the summaries read a typed copy instead.
        saved = staged(results)
        rows = write_table(saved, output, output_format)
    return JobReport(
        rows=rows,
        summary=run_summary(saved, cfg),
        preview=preview(saved, cfg),
        validation=validate_lei_scores(saved) if validate_lei else None,
    )
