"""Outlier and missing-value detection.

Every detector adds one boolean column (default ``is_outlier`` /
``is_missing``) to the long frame; NULL values are never outliers.
Per-series statistics are aggregated once (one row per ``(series_id, var)``)
and joined back — never an unbounded window over a whole series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.functions.expr import sdiv
from tsforge.operators import scan
from tsforge.operators.quantile import exact_quantiles
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS

METHODS = {0: "zscore", 1: "iqr", 2: "rolling_zscore", 3: "iforest"}


def _method(method) -> str:
    if method in METHODS:
        return METHODS[method]
    if method in METHODS.values():
        return method
    raise ValueError(f"unsupported outlier detection method {method!r}")


def zscore(df: DataFrame, threshold: float = 3.0, out: str = "is_outlier") -> DataFrame:
    """``|x - mean| / std_samp > threshold`` with per-series mean/std."""
    stats = df.groupBy(*KEYS).agg(F.avg("value").alias("_mu"), F.stddev_samp("value").alias("_sd"))
    z = F.abs(sdiv(F.col("value") - F.col("_mu"), F.col("_sd")))
    return (
        df.join(stats, on=KEYS, how="left")
        .withColumn(out, F.coalesce(z > F.lit(float(threshold)), F.lit(False)))
        .drop("_mu", "_sd")
    )


def iqr_bounds(df: DataFrame, k: float = 1.5) -> DataFrame:
    """Per-series ``q1, q3, lo, hi`` (exact, linear-interpolated quartiles)."""
    q = exact_quantiles(df, [0.25, 0.75])
    iqr = F.col("q75") - F.col("q25")
    return q.select(
        *KEYS,
        F.col("q25").alias("_q1"),
        F.col("q75").alias("_q3"),
        (F.col("q25") - F.lit(float(k)) * iqr).alias("_lo"),
        (F.col("q75") + F.lit(float(k)) * iqr).alias("_hi"),
    )


def iqr(df: DataFrame, k: float = 1.5, out: str = "is_outlier", keep_bounds: bool = False) -> DataFrame:
    """Outside ``[q1 - k*iqr, q3 + k*iqr]`` (the reference fixes k = 1.5)."""
    d = df.join(iqr_bounds(df, k), on=KEYS, how="left").withColumn(
        out, F.coalesce((F.col("value") < F.col("_lo")) | (F.col("value") > F.col("_hi")), F.lit(False))
    )
    return d if keep_bounds else d.drop("_q1", "_q3", "_lo", "_hi")


def rolling_zscore_bound(window: int) -> float:
    """Largest |z| a trailing window containing the point can produce: (w-1)/sqrt(w)."""
    return (window - 1) / window**0.5


def rolling_zscore(
    df: DataFrame,
    threshold: float = 3.0,
    window: int = 20,
    out: str = "is_outlier",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    strict: bool = False,
) -> DataFrame:
    """Z against the trailing ``window`` rows (incl. the point; min_periods 1;
    sample std).  With ``strict`` an unreachable threshold raises."""
    if window < 1:
        raise ValueError("window must be >= 1")
    if strict and threshold >= rolling_zscore_bound(window):
        raise ValueError(f"threshold {threshold} can never fire with window {window}")
    cols = df.columns
    h = scan.with_halo(df, before=window - 1, after=0, chunk_rows=chunk_rows)
    f = scan.rows_frame(window - 1, 0)
    z = F.abs(sdiv(F.col("value") - F.avg("value").over(f), F.stddev_samp("value").over(f)))
    h = h.withColumn(out, F.coalesce(z > F.lit(float(threshold)), F.lit(False)))
    return scan.drop_halo(h).select(*cols, out)


def missing(df: DataFrame, method=0, out: str = "is_missing") -> DataFrame:
    """C5 (method 0): NULL/NaN; C6 (method 1): NULL/NaN or exactly 0."""
    x = F.col("value")
    m = x.isNull() | F.isnan(x)
    if method == 1:
        m = m | (x == 0)
    elif method != 0:
        raise ValueError(f"unsupported missing-value detection method {method!r}")
    return df.withColumn(out, m)


def outliers(
    df: DataFrame,
    method=0,
    threshold: float = 3.0,
    window: int = 20,
    contamination: float = 0.05,
    out: str = "is_outlier",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """Dispatch by the reference's method codes (0 z, 1 IQR, 2 rolling z, 3 forest)."""
    m = _method(method)
    if m == "zscore":
        return zscore(df, threshold, out)
    if m == "iqr":
        return iqr(df, out=out)
    if m == "rolling_zscore":
        return rolling_zscore(df, threshold, window, out, chunk_rows)
    from tsforge.operators.iforest import isolation_forest

    return isolation_forest(df, contamination=contamination, out=out)
