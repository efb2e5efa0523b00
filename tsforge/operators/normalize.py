"""Normalisation.

Statistics are one aggregate per group joined back; the group is the sample
(matrix form, G1/G2: one min/max or mean/std over all steps × features of a
sample) or the ``(series_id, var)`` column (G3 and per-variable min-max).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.functions.expr import sdiv
from tsforge.spec import KEYS


def minmax_matrix(df: DataFrame, group=("series_id",), value: str = "x") -> DataFrame:
    """G1: ``(x - min) / (max - min)`` with one min/max per sample; constant → 0."""
    group = list(group)
    s = df.groupBy(*group).agg(F.min(value).alias("_mn"), F.max(value).alias("_mx"))
    x = F.col(value)
    scaled = F.when(F.col("_mx") == F.col("_mn"), F.lit(0.0)).otherwise(
        sdiv(x - F.col("_mn"), F.col("_mx") - F.col("_mn"))
    )
    return df.join(s, on=group, how="left").withColumn(value, scaled).drop("_mn", "_mx")


def zscore_matrix(df: DataFrame, group=("series_id",), value: str = "x") -> DataFrame:
    """``(x - mean) / std_pop`` per sample; std 0 → centred only."""
    group = list(group)
    s = df.groupBy(*group).agg(F.avg(value).alias("_mu"), F.stddev_pop(value).alias("_sd"))
    x = F.col(value) - F.col("_mu")
    scaled = F.when(F.col("_sd") == 0, x).otherwise(sdiv(x, F.col("_sd")))
    return df.join(s, on=group, how="left").withColumn(value, scaled).drop("_mu", "_sd")


def minmax(df: DataFrame, value: str = "value") -> DataFrame:
    """Per-variable min-max (the per-column form of G1)."""
    return minmax_matrix(df, group=KEYS, value=value)


def standardize(df: DataFrame, value: str = "value") -> DataFrame:
    """Per-variable standardisation with the population std (as ahead of PCA)."""
    s = df.groupBy(*KEYS).agg(F.avg(value).alias("_mu"), F.stddev_pop(value).alias("_sd"))
    return (
        df.join(s, on=KEYS, how="left")
        .withColumn(value, sdiv(F.col(value) - F.col("_mu"), F.col("_sd")))
        .drop("_mu", "_sd")
    )
