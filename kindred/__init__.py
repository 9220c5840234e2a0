"""Country-blocked linking of organisation records by name similarity, on Spark."""

from .config import SCORERS, MatchConfig
from .deploy import ship
from .functions.scorers import score_column
from .functions.text import country_key, lei_overlap, lei_set, name_key, normalise
from .plans.diagnostics import (
    compare_scorers, input_summary, miss_reasons, run_summary, truth_groups, truth_misses,
    truth_pairs, validate_lei_scores,
)
from .plans.job import JobReport, run_job
from .plans.match import candidate_counts, match, name_matches, unique_pairs
from .sources.tables import preview, read_table, schema_of, write_table

__all__ = [
    "SCORERS", "JobReport", "MatchConfig", "candidate_counts", "compare_scorers", "country_key",
    "input_summary", "lei_overlap", "lei_set", "match", "miss_reasons", "name_key",
    "name_matches", "normalise", "preview", "read_table", "run_job", "run_summary", "schema_of",
    "score_column", "ship", "truth_groups", "truth_misses", "truth_pairs", "unique_pairs",
    "validate_lei_scores", "write_table",
]
