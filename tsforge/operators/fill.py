"""Gap filling and outlier handling.

All fills are position based (the reference interpolates by row index, not by
timestamp distance) and only ever write NULL points; observed values are kept
bit-identical.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.functions.expr import sdiv
from tsforge.operators import detect, scan
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS


def linear(df: DataFrame, value_col: str = "value", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Linear interpolation by position; leading NULLs stay NULL, trailing
    NULLs take the last valid value."""
    cols = df.columns
    d = scan.valid_neighbours(df, value_col, chunk_rows)
    p0, v0, p1, v1 = F.col("_prev.p"), F.col("_prev.v"), F.col("_next.p"), F.col("_next.v")
    interp = v0 + (v1 - v0) * sdiv(F.col("pos") - p0, p1 - p0)
    return d.withColumn(value_col, F.coalesce(F.col(value_col), interp, v0)).select(*cols)


def auto_window(df: DataFrame) -> DataFrame:
    """Per-series window ``max(3, min(20, n // 10))``, n counting NULL rows."""
    return df.groupBy(*KEYS).agg(
        F.greatest(F.lit(3), F.least(F.lit(20), F.floor(F.count(F.lit(1)) / 10))).cast("int").alias("window")
    )


def rolling_mean(
    df: DataFrame, window: int | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """Fill NULLs with the trailing rolling mean (min_periods 1) of the
    unfilled series.  ``window=None`` uses the per-series D8 rule."""
    cols = df.columns
    if window is not None:
        h = scan.with_halo(df, before=window - 1, after=0, chunk_rows=chunk_rows)
        m = F.avg("value").over(scan.rows_frame(window - 1, 0))
        return scan.drop_halo(h.withColumn("value", F.coalesce(F.col("value"), m))).select(*cols)
    # variable window per series (3..20): collect the bounded frame, filter by the series' window
    d = df.join(auto_window(df), on=KEYS, how="left")
    h = scan.with_halo(d, before=19, after=0, chunk_rows=chunk_rows)
    pts = F.collect_list(
        F.when(F.col("value").isNotNull(), F.struct(F.col("pos").alias("p"), F.col("value").alias("v")))
    ).over(scan.rows_frame(19, 0))
    h = h.withColumn("_pts", pts).withColumn("_in", F.filter("_pts", lambda e: e["p"] > F.col("pos") - F.col("window")))
    mean = sdiv(F.aggregate("_in", F.lit(0.0), lambda acc, e: acc + e["v"]), F.size("_in"))
    return scan.drop_halo(h.withColumn("value", F.coalesce(F.col("value"), mean))).select(*cols)


def missing_values(
    df: DataFrame, method=1, window: int | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS
) -> DataFrame:
    """Dispatch by the reference's codes: 0 rolling mean, 1 linear, 2 spline, 3 seasonal."""
    if method in (0, "rolling_mean"):
        return rolling_mean(df, window, chunk_rows)
    if method in (1, "linear"):
        return linear(df, chunk_rows=chunk_rows)
    if method in (2, "spline"):
        return spline(df, degree=3, chunk_rows=chunk_rows)
    if method in (3, "seasonal"):
        return seasonal(df, period=7, chunk_rows=chunk_rows)
    raise ValueError(f"unsupported missing-value method {method!r}")


# ------------------------------------------------------------ outlier handling


def outliers_to_null(df: DataFrame, flag: str = "is_outlier") -> DataFrame:
    """D1."""
    return df.withColumn("value", F.when(F.col(flag), F.lit(None).cast("double")).otherwise(F.col("value")))


def clip_outliers(df: DataFrame, flag: str = "is_outlier", k: float = 1.5) -> DataFrame:
    """Only points both flagged and beyond an IQR fence move to the fence (fences that
    ``detect.iqr(keep_bounds=True)`` left are used)."""
    x = F.col("value")
    fenced = df if "_lo" in df.columns else df.join(detect.iqr_bounds(df, k), on=KEYS, how="left")
    return (
        fenced.withColumn(
            "value",
            F.when(F.col(flag) & (x < F.col("_lo")), F.col("_lo"))
            .when(F.col(flag) & (x > F.col("_hi")), F.col("_hi"))
            .otherwise(x),
        )
        .drop("_q1", "_q3", "_lo", "_hi")
    )


def handle_outliers(
    df: DataFrame,
    method=0,
    detect_method=0,
    threshold: float = 3.0,
    window: int = 20,
    contamination: float = 0.05,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    keep_flag: bool = False,
) -> DataFrame:
    """D1 (0 → NULL), D2 (1 → clip), D3 (2 → NULL then linear interpolation)."""
    if method not in (0, 1, 2):
        raise ValueError(f"unsupported outlier handling method {method!r}")
    cols = df.columns
    if method == 1 and detect._method(detect_method) == "iqr":  # one set of quartiles flags and clips
        d = detect.iqr(df, keep_bounds=True)
    else:
        d = detect.outliers(df, detect_method, threshold, window, contamination, "is_outlier", chunk_rows)
    if method == 0:
        d = outliers_to_null(d)
    elif method == 1:
        d = clip_outliers(d)
    else:
        d = linear(outliers_to_null(d), chunk_rows=chunk_rows)
    return d if keep_flag else d.select(*cols)


# ------------------------------------------------------------ decomposition


def decompose(df: DataFrame, period: int = 7, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Classical additive decomposition on a gap-free series.

    trend = centred moving average (even period: 2×p filter with half weights
    at both ends), NULL where the window is incomplete; seasonal = per-phase
    (``pos % period``) mean of the detrended series, centred to mean 0;
    resid = x - trend - seasonal.  Adds ``trend, seasonal, resid``.
    """
    if period < 2:
        raise ValueError("period must be >= 2")
    half = period // 2
    h = scan.with_halo(df, before=half, after=half, chunk_rows=chunk_rows)
    f = scan.rows_frame(half, half)
    n_in = F.count("value").over(f)
    if period % 2:
        trend = F.when(n_in == period, F.avg("value").over(f))
    else:
        w = scan.chunk_window()
        ends = F.lag("value", half).over(w) + F.lead("value", half).over(w)
        trend = F.when(n_in == period + 1, (F.sum("value").over(f) - F.lit(0.5) * ends) / F.lit(float(period)))
    d = scan.drop_halo(h.withColumn("trend", trend))
    d = d.withColumn("_phase", (F.col("pos") % period).cast("int"))
    phase = d.groupBy(*KEYS, "_phase").agg(F.avg(F.col("value") - F.col("trend")).alias("_pm"))
    centre = phase.groupBy(*KEYS).agg(F.avg("_pm").alias("_pmm"))
    seas = phase.join(centre, on=KEYS).select(*KEYS, "_phase", (F.col("_pm") - F.col("_pmm")).alias("seasonal"))
    return (
        d.join(seas, on=[*KEYS, "_phase"], how="left")
        .withColumn("resid", F.col("value") - F.col("trend") - F.col("seasonal"))
        .drop("_phase")
    )


def seasonal(df: DataFrame, period: int = 7, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Fill the NULL points with trend + seasonal + residual.

    Only observed points speak: the trend is the centred mean of windows without
    a gap, interpolated between them; the seasonal part the phase means of
    observed less trend; the residual is NULL where the value is, and
    interpolated from its observed neighbours.  Series of fewer than two periods,
    and points for which no window or phase was observed, are filled linearly."""
    cols = df.columns
    d = linear(df.withColumn("_orig", F.col("value")), chunk_rows=chunk_rows)
    dec = decompose(d.withColumn("_line", F.col("value")).withColumn("value", F.col("_orig")), period, chunk_rows)
    dec = linear(dec.drop("seasonal", "resid"), "trend", chunk_rows)
    dec = dec.withColumn("_phase", (F.col("pos") % period).cast("int"))
    phase = dec.groupBy(*KEYS, "_phase").agg(F.avg(F.col("_orig") - F.col("trend")).alias("_pm"))
    centre = phase.groupBy(*KEYS).agg(F.avg("_pm").alias("_pmm"))
    seas = phase.join(centre, on=KEYS).select(*KEYS, "_phase", (F.col("_pm") - F.col("_pmm")).alias("seasonal"))
    dec = dec.join(seas, on=[*KEYS, "_phase"], how="left")
    dec = linear(dec.withColumn("resid", F.col("_orig") - F.col("trend") - F.col("seasonal")), "resid", chunk_rows)
    n = dec.groupBy(*KEYS).agg((F.max("pos") + 1).alias("_n"))
    dec = dec.join(n, on=KEYS)
    recon = F.when(F.col("_n") >= 2 * period, F.col("trend") + F.col("seasonal") + F.col("resid"))
    return dec.withColumn("value", F.coalesce(F.col("_orig"), recon, F.col("_line"))).select(*cols)


def spline(df: DataFrame, degree: int = 3, chunk_rows: int = DEFAULT_CHUNK_ROWS, extrapolate: bool = True,
           use_ts: bool = False) -> DataFrame:
    """Interpolating spline through the valid points (see :mod:`tsforge.operators.spline`)."""
    from tsforge.operators.spline import spline_fill

    return spline_fill(df, degree=degree, chunk_rows=chunk_rows, extrapolate=extrapolate, use_ts=use_ts)
