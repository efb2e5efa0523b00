"""Index alignment (B8): the reference's only join-like operator.

Same lineage → just add the column; different lineages → join on the series
key and timestamp (``left`` like column assignment, ``full`` like
``concat(axis=1)``).  Output is wide: one column per variable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align(a: DataFrame, b: DataFrame, how: str = "full", on=("series_id", "ts")) -> DataFrame:
    """Join two long frames on ``(series_id, ts)``; each side's variables
    become columns ``<var>`` (variables must be distinct across the sides)."""
    if how not in ("left", "full", "inner"):
        raise ValueError("how must be 'left', 'full' or 'inner'")
    on = list(on)

    def to_cols(df: DataFrame) -> DataFrame:
        vs = sorted(r[0] for r in df.select("var").distinct().collect())
        return df.groupBy(*on).agg(*[F.max(F.when(F.col("var") == v, F.col("value"))).alias(v) for v in vs])

    return to_cols(a).join(to_cols(b), on=on, how=how)
