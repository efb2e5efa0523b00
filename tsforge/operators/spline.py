"""Interpolating spline fill (D6, E8) as a chunked Spark job.

Knots are the non-null points, numbered by a running count (the chunked carry
in :mod:`tsforge.operators.scan`).  NULL rows are evaluated on the interval that
contains them (leading / trailing rows extrapolate with the end interval, or
stay NULL when ``extrapolate`` is False).

* cubic (D6): not-a-knot interpolating cubic (the ``s=0`` smoothing spline);
  fewer than 4 knots fall back to linear interpolation.  Knots are cut into
  chunks with ``HALO`` knots on both sides, and each chunk solves its tridiagonal
  system by cyclic reduction on whole arrays: log2(knots) vector steps, no loop
  over knots.  The system's rows have twice the weight of their neighbours on
  the diagonal, so an influence at least halves from knot to knot, whatever the
  spacing, and ``HALO`` knots away it is below rounding.  The true series ends
  keep their end conditions because no halo exists there.
* quadratic (E8): C¹ piecewise quadratic through the knots whose first two
  pieces form one parabola (not-a-knot analogue); no extrapolation.  Its slopes
  follow ``s' = 2d - s``, an alternating running sum of the secants ``d``: built-in
  windows per chunk with a carry, no Python.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators import scan
from tsforge.plans.materialize import cut
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS

HALO = 56

_SEG = "series_id string, var string, x0 double, x1 double, y0 double, y1 double, a0 double, a1 double"


def _shifted(v: np.ndarray, by: int, fill: float) -> np.ndarray:
    """``out[i] = v[i + by]``, ``fill`` beyond the ends."""
    out = np.full(len(v), fill)
    if by >= 0:
        out[:len(v) - by] = v[by:]
    else:
        out[-by:] = v[:by]
    return out


def solve_tridiagonal(sub: np.ndarray, diag: np.ndarray, sup: np.ndarray, rhs: np.ndarray) -> np.ndarray:
    """Parallel cyclic reduction: each step removes the neighbours at distance
    ``step`` from every equation at once and doubles the distance, until none is left."""
    a, b, c, d = (np.asarray(v, dtype="float64").copy() for v in (sub, diag, sup, rhs))
    a[0] = c[-1] = 0.0
    step = 1
    while step < len(b) and (a.any() or c.any()):
        up, down = -a / _shifted(b, -step, 1.0), -c / _shifted(b, step, 1.0)
        b = b + up * _shifted(c, -step, 0.0) + down * _shifted(a, step, 0.0)
        d = d + up * _shifted(d, -step, 0.0) + down * _shifted(d, step, 0.0)
        a, c = up * _shifted(a, -step, 0.0), down * _shifted(c, step, 0.0)
        step *= 2
    return d / b


def cubic_second_derivatives(x: np.ndarray, y: np.ndarray, natural_left: bool = False, natural_right: bool = False):
    """Second derivatives of the not-a-knot cubic through (x, y) (len >= 4).
    ``natural_*`` marks a chunk edge that is not a series end (halo side):
    M = 0 there, whose error is damped away by the halo."""
    h, slope = np.diff(x), np.diff(y) / np.diff(x)
    left, right = h[:-1], h[1:]
    sub, diag, sup = left.copy(), 2.0 * (left + right), right.copy()
    if not natural_left:
        # M0 = M1 + (M1 - M2) h0/h1, put into the first equation
        diag[0] += h[0] * (1.0 + h[0] / h[1])
        sup[0] -= h[0] ** 2 / h[1]
    if not natural_right:
        diag[-1] += h[-1] * (1.0 + h[-1] / h[-2])
        sub[-1] -= h[-1] ** 2 / h[-2]
    inner = solve_tridiagonal(sub, diag, sup, 6.0 * np.diff(slope))
    first = 0.0 if natural_left else inner[0] + h[0] / h[1] * (inner[0] - inner[1])
    last = 0.0 if natural_right else inner[-1] + h[-1] / h[-2] * (inner[-1] - inner[-2])
    return np.concatenate([[first], inner, [last]])


def _cubic_segments(knots: DataFrame, chunk_rows: int) -> DataFrame:
    counts = knots.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_m"))
    h = scan.with_halo(knots.join(counts, on=KEYS), before=HALO, after=HALO + 1, chunk_rows=max(int(chunk_rows), 4 * HALO))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        k = pdf["pos"].to_numpy(dtype=np.int64)
        x, y = pdf["_xpos"].to_numpy(dtype="float64"), pdf["value"].to_numpy(dtype="float64")
        home, m, n = pdf[scan.HOME].to_numpy(dtype=bool), int(pdf["_m"].iloc[0]), len(pdf)
        a = np.full(n, np.nan)  # linear pieces
        if m >= 4 and n >= 4:
            a = cubic_second_derivatives(x, y, natural_left=k[0] > 0, natural_right=k[-1] < m - 1)
        # a piece belongs to its left knot; the only knot of a series is a piece of no length
        at = np.flatnonzero(home[:-1]) if m > 1 else np.array([0])
        to = np.minimum(at + 1, n - 1)
        return pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "var": pdf["var"].iloc[0], "x0": x[at], "x1": x[to],
                             "y0": y[at], "y1": y[to], "a0": a[at], "a1": a[to]})

    return h.select(*KEYS, scan.CHUNK, scan.HOME, "pos", "_xpos", "value", "_m").groupBy(*KEYS, scan.CHUNK).applyInPandas(
        solve, _SEG)


def _quadratic_segments(knots: DataFrame, chunk_rows: int) -> DataFrame:
    """Pieces with the slopes at their ends: ``s_k = (-1)^k (s_0 - 2 Σ_{j<k} (-1)^j d_j)``,
    where s_0 is the slope at the first knot of the parabola through the first three."""
    w = scan.chunk_window()
    pieces = scan.drop_halo(scan.with_halo(knots, before=0, after=1, chunk_rows=chunk_rows).select(
        *KEYS, scan.CHUNK, scan.HOME, "pos", F.col("_xpos").cast("double").alias("x0"), F.col("value").alias("y0"),
        F.lead("_xpos").over(w).cast("double").alias("x1"), F.lead("value").over(w).alias("y1")))
    d = (F.col("y1") - F.col("y0")) / (F.col("x1") - F.col("x0"))
    sign = F.when(F.col("pos") % 2 == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
    pieces = scan.running_sum(pieces.withColumn("_d", F.when(F.col("x1").isNotNull(), d)).withColumn("_e", sign * F.col("_d")),
                              "_e", "_sum", chunk_rows)
    h, e = F.col("x1") - F.col("x0"), lambda i, c: F.max(F.when(F.col("pos") == i, c))
    start = pieces.filter(F.col("pos") < 2).groupBy(*KEYS).agg(
        e(0, F.col("_d")).alias("_d0"), e(1, F.col("_d")).alias("_d1"), e(0, h).alias("_h0"), e(1, h).alias("_h1"))
    bend = F.col("_h0") * (F.col("_d1") - F.col("_d0")) / (F.col("_h0") + F.col("_h1"))
    start = start.select(*KEYS, (F.col("_d0") - F.coalesce(bend, F.lit(0.0))).alias("_s0"))
    a1 = -sign * (F.col("_s0") - 2.0 * F.col("_sum"))
    # the last knot starts no piece, unless it is the only one
    return pieces.filter(F.col("x1").isNotNull() | (F.col("pos") == 0)).join(start, on=KEYS).select(
        *KEYS, "x0", F.coalesce("x1", "x0").alias("x1"), "y0", F.coalesce("y1", "y0").alias("y1"),
        (2.0 * F.col("_d") - a1).alias("a0"), a1.alias("a1"))


def spline_fill(df: DataFrame, degree: int = 3, chunk_rows: int = DEFAULT_CHUNK_ROWS, extrapolate: bool = True,
                use_ts: bool = False) -> DataFrame:
    if degree not in (2, 3):
        raise ValueError("degree must be 2 or 3")
    cols = df.columns
    ind = df.withColumn("_iv", F.when(F.col("value").isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0)))
    r = scan.running_sum(ind, "_iv", "_cum", chunk_rows)
    # knots and pieces are read by several branches below
    knots = cut(r.filter(F.col("value").isNotNull()).select(
        *KEYS, F.col("pos").alias("_xpos"), "value", (F.col("_cum") - 1).cast("bigint").alias("pos")))
    seg = cut((_cubic_segments if degree == 3 else _quadratic_segments)(knots, int(chunk_rows)))
    # interval of each row: starts at the previous knot (first interval for leading rows,
    # last interval for trailing rows)
    nb = scan.valid_neighbours(df, "value", chunk_rows)
    ends = seg.groupBy(*KEYS).agg(F.min("x0").alias("_first_x"), F.max("x0").alias("_last_x"))
    rows = nb.join(ends, on=KEYS, how="left").withColumn(
        "_x0", F.when(F.col("_prev").isNull(), F.col("_first_x"))
        .otherwise(F.least(F.col("_prev.p").cast("double"), F.col("_last_x"))))
    j = rows.join(seg.withColumnRenamed("x0", "_x0"), on=[*KEYS, "_x0"], how="left")
    x = F.col("pos").cast("double")
    hh = F.col("x1") - F.col("_x0")
    if degree == 3:
        cub = (F.col("a0") * F.pow(F.col("x1") - x, 3) / (6 * hh) + F.col("a1") * F.pow(x - F.col("_x0"), 3) / (6 * hh)
               + (F.col("y0") / hh - F.col("a0") * hh / 6) * (F.col("x1") - x)
               + (F.col("y1") / hh - F.col("a1") * hh / 6) * (x - F.col("_x0")))
        lin = F.col("y0") + (F.col("y1") - F.col("y0")) * F.try_divide(x - F.col("_x0"), hh)
        est = F.when(F.col("a0").isNull() | F.isnan("a0"), lin).otherwise(cub)
    else:
        # q(x) = y0 + s0 (x-x0) + (s1-s0)/(2h) (x-x0)^2
        t = x - F.col("_x0")
        est = F.col("y0") + F.col("a0") * t + F.try_divide(F.col("a1") - F.col("a0"), 2 * hh) * t * t
    est = F.when(hh == 0, F.col("y0")).otherwise(est)
    if not extrapolate:
        est = F.when(F.col("_prev").isNotNull() & F.col("_next").isNotNull(), est)
    return j.withColumn("value", F.coalesce(F.col("value"), est)).select(*cols)
