"""Canonical series derived from the driver's parquet tables.

Each builder returns a *raw* long frame ``series_id, var, ts, value`` (no
``pos``); calendar operators or :func:`tsforge.operators.scan.assign_positions`
add positions.  Base values are built from ``decimal`` sums so that Spark and
the DuckDB oracle start from identical doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.operators import scan
from tsforge.spec import LONG_COLUMNS


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dsum(c: str):
    return F.sum(F.col(c).cast("decimal(18,2)")).cast("double")


def _davg(c: str):
    return _dsum(c) / F.count(F.lit(1)).cast("double")


def _long(wide: DataFrame, ts: str, series: str, vars_: list[str]) -> DataFrame:
    return (
        wide.withColumn("series_id", F.lit(series))
        .unpivot(["series_id", ts], vars_, "var", "value")
        .select("series_id", "var", F.col(ts).alias("ts"), F.col("value").cast("double").alias("value"))
    )


def ord_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders by order date: ``revenue`` (sum of total price) and ``n_orders``."""
    o = table(spark, sf_dir, "orders")
    wide = o.groupBy("o_orderdate").agg(
        _dsum("o_totalprice").alias("revenue"), F.count(F.lit(1)).cast("double").alias("n_orders")
    )
    return _long(wide, "o_orderdate", "orders", ["revenue", "n_orders"])


def ship_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem by ship date: average quantity, price, discount and tax (4 variables)."""
    li = table(spark, sf_dir, "lineitem")
    wide = li.groupBy("l_shipdate").agg(
        _davg("l_quantity").alias("quantity"),
        _davg("l_extendedprice").alias("price"),
        _davg("l_discount").alias("discount"),
        _davg("l_tax").alias("tax"),
    )
    return _long(wide, "l_shipdate", "lineitem", ["quantity", "price", "discount", "tax"])


# Base for NTZ-safe truncation; timestamp_diff truncates toward zero, so the
# base must precede every timestamp.
_EPOCH = "1000-01-01 00:00:00"


def _hour(ts_col: str):
    # NTZ-safe hour truncation (no session-zone round trip)
    base = F.lit(_EPOCH).cast("timestamp_ntz")
    return F.timestamp_add("HOUR", F.timestamp_diff("HOUR", base, F.col(ts_col)), base)


def ev_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events: one series per event type, hourly mean value (var ``value``)."""
    e = table(spark, sf_dir, "events")
    return (
        e.groupBy(F.col("event_type").alias("series_id"), _hour("ts").alias("ts"))
        .agg(_davg("value").alias("value"))
        .select("series_id", F.lit("value").alias("var"), "ts", "value")
    )


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events per user (irregular): long frame with dense ``pos`` ordered by (ts, event_id)."""
    e = table(spark, sf_dir, "events")
    d = e.select(
        F.col("user_id").cast("string").alias("series_id"),
        F.lit("value").alias("var"),
        "ts",
        "event_id",
        F.col("value").cast("double").alias("value"),
    )
    return scan.assign_positions(d, order_cols=("ts", "event_id")).select(*LONG_COLUMNS)


def ev_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events per event type (irregular), ``pos`` ordered by (ts, event_id)."""
    e = table(spark, sf_dir, "events")
    d = e.select(
        F.col("event_type").alias("series_id"),
        F.lit("value").alias("var"),
        "ts",
        "event_id",
        F.col("value").cast("double").alias("value"),
    )
    return scan.assign_positions(d, order_cols=("ts", "event_id")).select(*LONG_COLUMNS)


def emb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings exploded: sample ``vec_id`` (as series), label, step 0..63."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").cast("string").alias("series_id"),
        F.col("label"),
        F.posexplode("embedding").alias("step", "x"),
    ).select("series_id", "label", F.col("step").cast("bigint").alias("step"), F.col("x").cast("double").alias("x"))
