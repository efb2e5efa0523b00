"""CSV / in-memory series sources.

All sources return the canonical *raw* long frame ``series_id, var, ts, value``
(text ``NaN`` and double NaN normalised to NULL).  Use
:func:`tsforge.operators.calendar.regularize` (or ``scan.assign_positions``)
to add positions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.functions.expr import nan_to_null
from tsforge.spec import require_columns


def parse_ts(c, fmt: str | None = None):
    """B2: text → TIMESTAMP_NTZ; unparsable text becomes NULL."""
    c = F.col(c) if isinstance(c, str) else c
    if fmt:
        return F.try_to_timestamp(c, F.lit(fmt)).cast("timestamp_ntz")
    return F.coalesce(c.try_cast("timestamp_ntz"), F.try_to_timestamp(c).cast("timestamp_ntz"))


def to_long(
    df: DataFrame,
    ts_col: str,
    value_cols,
    series_cols=(),
    series_id: str = "series",
    ts_format: str | None = None,
) -> DataFrame:
    """A2/B1: a wide frame (one timestamp column, one column per variable) →
    long frame.  ``value_cols`` may be a string or a list; ``series_cols``
    (optional) identify several series in one table."""
    value_cols = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    series_cols = [series_cols] if isinstance(series_cols, str) else list(series_cols)
    require_columns(df, [ts_col, *value_cols, *series_cols])
    sid = F.concat_ws("|", *[F.col(c).cast("string") for c in series_cols]) if series_cols else F.lit(series_id)
    ts = F.col(ts_col)
    if not isinstance(df.schema[ts_col].dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        ts = parse_ts(ts_col, ts_format)
    base = df.select(sid.alias("series_id"), ts.cast("timestamp_ntz").alias("ts"),
                     *[F.col(c).cast("double").alias(c) for c in value_cols])
    return (base.unpivot(["series_id", "ts"], value_cols, "var", "value")
            .select("series_id", "var", "ts", nan_to_null("value").alias("value")))


def from_series(df: DataFrame, ts_col: str, value_col: str, name: str | None = None, series_id: str = "series"):
    """A3: univariate source; the variable is named ``name`` → ``value_col``."""
    return to_long(df, ts_col, [value_col], series_id=series_id).withColumn("var", F.lit(name or value_col or "value"))


def read_csv_series(
    spark: SparkSession,
    path: str,
    ts_col: str,
    value_cols,
    series_id: str | None = None,
    ts_format: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """A1: CSV with a header row; ``NaN`` text reads as NULL.  Without a schema
    every value column is cast to DOUBLE (no inference pass over the data)."""
    r = spark.read.option("header", True).option("nullValue", "NaN").option("mode", "PERMISSIVE")
    if schema is not None:
        r = r.schema(schema)
    df = r.csv(path)
    sid = series_id or path.rstrip("/").split("/")[-1].rsplit(".", 1)[0]
    return to_long(df, ts_col, value_cols, series_id=sid, ts_format=ts_format)
