"""Null-safe column expressions.

Spark 4 runs in ANSI mode: ``0/0`` raises instead of returning NaN, so every
ratio in the library goes through :func:`sdiv`.  NaN is normalised to NULL at
ingest (:func:`nan_to_null`) so NULL is the only missing marker.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sdiv(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (never raises)."""
    return F.try_divide(col(a), col(b))


def nan_to_null(c) -> Column:
    c = col(c)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c.cast("double"))


def r6(c) -> Column:
    """Round half-up to 6 decimals identically on Spark and DuckDB."""
    return F.floor(col(c) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)
