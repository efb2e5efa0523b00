"""Sinks (A7-A9): write a cleaned / transformed / processed series and its
side-car record.  Executors write their partitions; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators import relations


def _stem(path: str) -> str:
    p = path.rstrip("/")
    return p.rsplit(".", 1)[0] if "." in p.split("/")[-1] else p


def to_wide(df: DataFrame, vars_: list[str] | None = None) -> DataFrame:
    return relations.wide(df, vars_).orderBy("series_id", "pos")


def save(df: DataFrame, path: str, fmt: str = "csv", index: bool = True, mode: str = "errorifexists",
         wide: bool = True, vars_: list[str] | None = None) -> None:
    """Write the series (wide: one column per variable).  ``index=False``
    drops the timestamp column."""
    out = to_wide(df, vars_) if wide else df
    if not index:
        out = out.drop("ts")
    w = out.write.mode(mode)
    if fmt == "csv":
        w.option("header", True).csv(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError("fmt must be 'csv' or 'parquet'")


def export_transformed(df: DataFrame, ledger: DataFrame, path: str, fmt: str = "csv", **kw) -> None:
    """Data plus ``<stem>_transformations`` (``column, transformation``)."""
    save(df, path, fmt, **kw)
    led = ledger.select(F.col("var").alias("column"), "transformation", "step_no")
    w = led.coalesce(1).write.mode(kw.get("mode", "errorifexists"))
    (w.option("header", True).csv if fmt == "csv" else w.parquet)(_stem(path) + "_transformations")


def processing_log(record: DataFrame, components: DataFrame, threshold: float = 0.7) -> DataFrame:
    """A9 log, one row a series, of the method that it really got: ``step, method, details,
    n_components, explained_variance``.  ``record`` comes from :func:`collinear.handling`: the
    details are the threshold and the names that drop removed, select kept, or combine
    and pca made; pca also has its number of components and the sum of their explained variance."""
    number = F.size(F.split("details", ","))
    upto = components.groupBy("series_id").agg(F.map_from_entries(F.collect_list(F.struct(
        F.col("pc").cast("int"), F.col("explained_variance_ratio")))).alias("_r"))
    kept = F.aggregate(F.filter(F.map_entries("_r"), lambda e: e["key"] <= number), F.lit(0.0), lambda a, e: a + e["value"])
    pca = F.col("method") == "pca"
    what = F.create_map(*[F.lit(x) for x in ("drop", "removed ", "select", "kept ", "combine", "combined ", "pca", "")])
    return record.join(upto, on="series_id", how="left").select(
        "series_id", F.lit("correlation_handling").alias("step"), "method",
        F.concat(F.lit(f"threshold={threshold}"), F.when(F.col("method") != "none", F.concat(
            F.lit("; "), F.try_element_at(what, F.col("method")), F.regexp_replace("details", ",", ", "))).otherwise("")).alias("details"),
        F.when(pca, number.cast("double")).alias("n_components"), F.when(pca, kept).alias("explained_variance"))


def export_processed(df: DataFrame, log: DataFrame, path: str, fmt: str = "csv", **kw) -> None:
    """Data plus ``<stem>_processing``."""
    save(df, path, fmt, **kw)
    w = log.coalesce(1).write.mode(kw.get("mode", "errorifexists"))
    (w.option("header", True).csv if fmt == "csv" else w.parquet)(_stem(path) + "_processing")
