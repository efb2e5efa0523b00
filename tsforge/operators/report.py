"""Comparison tables — the data behind the reference's charts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.spec import KEYS


def compare(df: DataFrame, before: str = "original", after: str = "value") -> DataFrame:
    """L1/L2 on one lineage: both versions are columns of the same frame, so no
    join is needed.  Adds ``changed`` (NULL-safe inequality) and ``delta``."""
    return df.select(
        *KEYS,
        "ts",
        "pos",
        F.col(before).alias("original"),
        F.col(after).alias("cleaned"),
        (~F.col(before).eqNullSafe(F.col(after))).alias("changed"),
        (F.col(after) - F.col(before)).alias("delta"),
    )


def compare_join(original: DataFrame, cleaned: DataFrame, how: str = "full") -> DataFrame:
    """L1 across lineages: full (or left) join on ``(series_id, var, pos)``."""
    o = original.select(*KEYS, "pos", F.col("ts").alias("_ts_o"), F.col("value").alias("original"))
    c = cleaned.select(*KEYS, "pos", F.col("ts").alias("_ts_c"), F.col("value").alias("cleaned"))
    j = o.join(c, on=[*KEYS, "pos"], how=how)
    return j.select(
        *KEYS,
        F.coalesce("_ts_o", "_ts_c").alias("ts"),
        "pos",
        "original",
        "cleaned",
        (~F.col("original").eqNullSafe(F.col("cleaned"))).alias("changed"),
        (F.col("cleaned") - F.col("original")).alias("delta"),
    )


def change_counts(cmp: DataFrame) -> DataFrame:
    """Per-variable number of changed points (the chart legend of L1)."""
    return cmp.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("changed").cast("bigint")).alias("n_changed"),
        F.sum(F.col("original").isNull().cast("bigint")).alias("n_missing_before"),
        F.sum(F.col("cleaned").isNull().cast("bigint")).alias("n_missing_after"),
    )
