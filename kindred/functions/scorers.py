"""Scorer registry: a scorer name to a Column over two normalised-name columns."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SCORERS
from . import native
from .scoring import score_pairs, two_sides


@lru_cache(maxsize=None)
def _udf(scorer: str):
    @F.pandas_udf("double")
    def score(left: pd.Series, right: pd.Series) -> pd.Series:
        # Each distinct name of the batch is encoded once.
        li, lefts = pd.factorize(left)
        ri, rights = pd.factorize(right)
        known = np.flatnonzero((li >= 0) & (ri >= 0))
        out = np.full(len(left), np.nan)
        if known.size:
            a, b = two_sides(list(lefts), list(rights))
            out[known] = score_pairs(scorer, a, li[known], b, ri[known])
        return pd.Series(out).where(~np.isnan(out), None)

    return score


def score_column(scorer: str, left: Column, right: Column) -> Column:
    """Score (0-100) of two normalised names; null if either is null.

    ``ratio``, the measure the others build on, is accepted besides the public scorers.
    """
    if scorer not in SCORERS and scorer != "ratio":
        raise ValueError(f"unknown scorer {scorer!r}; choose one of {', '.join(SCORERS)}")
    if scorer in native.NATIVE:
        return native.native_score(scorer, left, right)
    return _udf(scorer)(left, right)
