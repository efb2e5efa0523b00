"""Labelled directory trees ``<root>/<split>/<label>/<file>.csv``.

One recursive ``read.csv`` over the whole tree (not one read per file); the
split, label and sample id come from the file path (``_metadata.file_path``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsforge.operators import normalize

SPLITS = ("train", "val", "test")
_PATH_RE = r"/([^/]+)/([^/]+)/([^/]+)\.csv$"


def scan_tree(spark: SparkSession, root: str, id_col: str = "ID") -> DataFrame:
    """Every ``*.csv`` under ``root`` as long rows
    ``split, label, series_id, step, var, value`` (the ID column becomes ``step``).
    Every file's header must name the same columns in the same order: a file
    that differs raises instead of being read by position."""
    raw = (spark.read.option("header", True).option("recursiveFileLookup", True)
           .option("pathGlobFilter", "*.csv").option("nullValue", "NaN")
           .option("enforceSchema", False).csv(root)
           .select("*", F.col("_metadata.file_path").alias("_path")))
    feats = [c for c in raw.columns if c not in (id_col, "_path")]
    d = raw.select(
        F.regexp_extract("_path", _PATH_RE, 1).alias("split"),
        F.regexp_extract("_path", _PATH_RE, 2).alias("label"),
        F.regexp_extract("_path", _PATH_RE, 3).alias("file"),
        F.col(id_col).cast("bigint").alias("step"),
        *[F.col(c).cast("double").alias(c) for c in feats],
    )
    d = d.withColumn("series_id", F.concat_ws("/", "split", "label", "file"))
    return d.unpivot(["split", "label", "series_id", "step"], feats, "var", "value")


def valid_splits(df: DataFrame, splits=SPLITS) -> tuple[DataFrame, DataFrame]:
    """Q22: rows under a known split vs. the rejected rest (reported, not dropped silently)."""
    ok = F.col("split").isin(*splits)
    return df.filter(ok), df.filter(~ok)


def normalise(df: DataFrame, method: str = "minmax") -> DataFrame:
    """G1/G2 over each sample's whole T×D matrix (one min/max or mean/std per file)."""
    d = df.withColumnRenamed("value", "x")
    if method == "minmax":
        out = normalize.minmax_matrix(d, group=("series_id",), value="x")
    elif method == "meanstd":
        out = normalize.zscore_matrix(d, group=("series_id",), value="x")
    else:
        raise ValueError("method must be 'minmax' or 'meanstd'")
    return out.withColumnRenamed("x", "value")


def matrices(df: DataFrame) -> DataFrame:
    """One row per sample: ``split, label, series_id, n_steps, matrix``
    (ARRAY<ARRAY<DOUBLE>> ordered by step, features ordered by name).  A
    sample is one file, so each group is bounded by the file's size."""
    feats = df.groupBy("split", "label", "series_id", "step").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("var", "value"))), lambda e: e["value"]).alias("row"))
    return feats.groupBy("split", "label", "series_id").agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.transform(F.array_sort(F.collect_list(F.struct("step", "row"))), lambda e: e["row"]).alias("matrix"))


def leakage(df: DataFrame, a: str = "train", b: str = "val") -> DataFrame:
    """Q23: samples of split ``b`` whose ordered content equals a sample of
    split ``a`` (equi-join on a hash of the ordered rows, then the rows compared)."""
    m = matrices(df).withColumn("h", F.xxhash64(F.to_json("matrix")))
    x = m.filter(F.col("split") == a).select(F.col("series_id").alias(f"{a}_id"), "label", "h", F.col("matrix").alias("ma"))
    y = m.filter(F.col("split") == b).select(F.col("series_id").alias(f"{b}_id"), F.col("label").alias("label_b"), "h",
                                             F.col("matrix").alias("mb"))
    return x.join(y, on="h").filter(F.col("ma").eqNullSafe(F.col("mb"))).drop("h", "ma", "mb")

