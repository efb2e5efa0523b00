"""Exact per-series quantiles (linear interpolation) and ranks, in one way for all sizes.

Rows are first combined to distinct values with their counts, so ties of any
size are one row.  The values are range-partitioned by (series, value) at
sampled cut points; rows per range give every range its first rank, and only
the ranges that hold a wanted order statistic are numbered.  The input is read
once, no buffer holds a whole series, and a range is about 1/partitions of the
distinct values, whichever series they belong to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.plans.materialize import cut
from tsforge.spec import KEYS


def _ranges(df: DataFrame, value_col: str, keys: list[str], partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """Distinct values (keys, _x, _c) with their _range, and per (keys, _range) the rows
    in it (_t), in earlier ranges (_before) and in all (n)."""
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    values = df.filter(F.col(value_col).isNotNull()).groupBy(*keys, F.col(value_col).cast("double").alias("_x")).agg(
        F.count(F.lit(1)).alias("_c"))
    ranged = cut(values.repartitionByRange(parts, *keys, "_x").withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy(*keys, "_range").agg(F.sum("_c").alias("_t"))
    w = Window.partitionBy(*keys)
    before = F.sum("_t").over(w.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    return ranged, totals.withColumn("_before", F.coalesce(before, F.lit(0))).withColumn("n", F.sum("_t").over(w))


def _in_range(ranged: DataFrame, side: DataFrame, keys: list[str]) -> DataFrame:
    """``ranged`` with the columns of ``side`` and ``_lo``, the rows of its key below the value."""
    upto = F.sum("_c").over(Window.partitionBy(*keys, "_range").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0))
    return ranged.join(side, on=[*keys, "_range"]).withColumn("_lo", F.col("_before") + upto - F.col("_c"))


def _pname(p: float) -> str:
    return f"{p * 100:g}".replace(".", "_")


def exact_quantiles(df: DataFrame, probs, value_col: str = "value", keys=KEYS, partitions: int | None = None) -> DataFrame:
    """One row per ``keys`` with a column ``q<i>`` per requested probability
    (named ``q{int(p*100)}``, e.g. q25/q75) and ``n`` = non-null count."""
    keys, probs = list(keys), [float(p) for p in probs]
    ranged, totals = _ranges(df, value_col, keys, partitions)

    def rank(p: float):  # position of the quantile, and the order statistics around it
        h = (F.col("n") - 1) * F.lit(p)
        low = F.floor(h).cast("bigint")
        return h, low, F.least(low + 1, F.col("n") - 1)

    wanted = F.array_distinct(F.array(*[k for p in probs for k in rank(p)[1:]]))
    here = F.filter(wanted, lambda k: (k >= F.col("_before")) & (k < F.col("_before") + F.col("_t")))
    need = totals.withColumn("_k", here).filter(F.size("_k") > 0).select(*keys, "_range", "_before", "n", "_k")
    hit = F.filter("_k", lambda k: (k >= F.col("_lo")) & (k < F.col("_lo") + F.col("_c")))
    found = _in_range(ranged, need, keys).select(*keys, "n", "_x", F.explode(hit).alias("_k"))
    at = found.groupBy(*keys, "n").agg(F.map_from_entries(F.collect_list(F.struct("_k", "_x"))).alias("_v"))

    def quantile(p: float):
        h, low, high = rank(p)
        a, b = F.col("_v")[low], F.col("_v")[high]
        return (a + (h - low) * (b - a)).alias(f"q{_pname(p)}")

    return at.select(*keys, "n", *[quantile(p) for p in probs])


def value_ranks(df: DataFrame, value_col: str = "value", keys=KEYS, partitions: int | None = None) -> DataFrame:
    """(keys, ``value_col``, rank): average rank (1-based) of every distinct value."""
    keys = list(keys)
    ranged, totals = _ranges(df, value_col, keys, partitions)
    return _in_range(ranged, totals, keys).select(
        *keys, F.col("_x").alias(value_col), (F.col("_lo") + (F.col("_c") + 1) / 2.0).alias("rank"))
