"""Settings of one linking run."""

from __future__ import annotations

from dataclasses import dataclass

SCORERS = ("ensemble", "WRatio", "partial_ratio", "token_sort_ratio", "token_set_ratio")


@dataclass(frozen=True)
class MatchConfig:
    """Column mapping and tuning of a run; validated on construction.

    ``left_id_col`` / ``right_id_col`` name a unique integer or string column giving
    the row order that breaks ties.  Without one, rows are ordered by their content,
    so the result never depends on how the input happens to be partitioned.
    """

    left_name_col: str = "institution_name"
    left_country_col: str = "country_name"
    left_lei_col: str = "lei"
    right_name_col: str = "SP_ENTITY_NAME"
    right_country_col: str = "SP_COUNTRY_NAME"
    right_lei_col: str = "SP_LEI"
    score_threshold: float = 50.0
    top_n: int = 5
    scorer: str = "ensemble"
    relax_country: bool = False
    left_extra_cols: tuple[str, ...] = ()
    right_extra_cols: tuple[str, ...] = ()
    left_id_col: str | None = None
    right_id_col: str | None = None
    # Most distinct names of either side that one scoring task compares.
    left_tile_rows: int = 8192
    right_tile_rows: int = 16384
    # WRatio: score pairs of alike length as Columns in the JVM, the rest in the kernel.
    # Exact either way; off by default since the kernel's bounds make it faster (README).
    split_by_length: bool = False
    # ratio, token_sort_ratio, token_set_ratio: best names by a native join of tiles.  Exact,
    # off by default: inside ``match`` it was far slower than the kernel (README).
    native_scorers: bool = False

    def __post_init__(self):
        object.__setattr__(self, "left_extra_cols", tuple(self.left_extra_cols))
        object.__setattr__(self, "right_extra_cols", tuple(self.right_extra_cols))
        if self.scorer not in SCORERS:
            raise ValueError(f"unknown scorer {self.scorer!r}; choose one of {', '.join(SCORERS)}")
        if not 0 <= self.score_threshold <= 100:
            raise ValueError("score_threshold must lie between 0 and 100")
        if self.top_n < 1:
            raise ValueError("top_n must be at least 1")
        if self.left_tile_rows < 1 or self.right_tile_rows < 1:
            raise ValueError("tile sizes must be at least 1")
