"""Cleaning workflow (file → regular grid → filled → de-spiked → compare/write).

Mirrors the reference's cleaning demo as one lazy plan: every step is a
DataFrame transformation; nothing runs until the caller's action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators import calendar, fill, report
from tsforge.plans.materialize import cut
from tsforge.spec import DEFAULT_CHUNK_ROWS


def clean(
    raw: DataFrame,
    freq: str | None = "D",
    fill_method=1,
    outlier_method=2,
    detect_method=2,
    threshold: float = 2.5,
    window: int = 10,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """Regularise (if ``freq``), fill gaps, handle outliers.  Keeps the
    regularised input as column ``original``.  The grid and the filled series
    are materialised (lineage cuts, see :mod:`tsforge.plans.materialize`)."""
    g = cut(calendar.regularize(raw, freq, chunk_rows)) if freq else raw
    g = g.withColumn("original", F.col("value"))
    g = cut(fill.missing_values(g, fill_method, chunk_rows=chunk_rows))
    return fill.handle_outliers(
        g, outlier_method, detect_method, threshold=threshold, window=window, chunk_rows=chunk_rows
    )


def clean_compare(raw: DataFrame, **kw) -> DataFrame:
    """L1 table of the cleaning workflow: original vs cleaned per point."""
    return report.compare(clean(raw, **kw), before="original", after="value")
