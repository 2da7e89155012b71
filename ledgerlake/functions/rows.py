"""Per-row scores used by survivorship rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F


def completeness_score(columns) -> Column:
    """Number of non-null values among ``columns`` (NaN counts as a value)."""
    terms = [F.col(c).isNotNull().cast("int") for c in columns]
    if not terms:
        return F.lit(0)
    return reduce(lambda a, b: a + b, terms)


def update_priority(c: str = "update_flag") -> Column:
    """1 when the update flag reads "1", else 0 (null included)."""
    return F.when(F.col(c).cast("string") == "1", F.lit(1)).otherwise(F.lit(0))
