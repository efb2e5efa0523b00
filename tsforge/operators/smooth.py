"""Smoothing.

* F1 centred moving average: a bounded frame on the chunked scan (halo).
* F2 exponential smoothing ``y_t = (1-a) y_{t-1} + a x_t`` with gaps: every
  valid row is an affine map of the previous state, so a chunk is summarised
  by one composed map (JVM ``aggregate`` over the chunk's points); the maps are
  folded over chunks (one row per chunk) and each chunk is then replayed from
  its carried-in state.  Nothing orders a whole series in one task.
* F3 LOESS (local linear, tricube, no robustness iterations) over the
  ``k = int(frac*n)`` nearest positions, from power sums (:mod:`loess`): time
  and memory of a chunk don't hang on ``k``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.operators import loess as kernel
from tsforge.operators import scan
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS


def centred_frame(window: int) -> tuple[int, int]:
    """(before, after) of a centred window of ``window`` rows (even: one more before)."""
    after = (window - 1) // 2
    return window - 1 - after, after


def moving_average(df: DataFrame, window: int = 3, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """centred mean where the whole window is valid, else the original value."""
    if window < 1:
        raise ValueError("window must be >= 1")
    cols = df.columns
    before, after = centred_frame(window)
    h = scan.with_halo(df, before, after, chunk_rows)
    f = scan.rows_frame(before, after)
    sm = F.when(F.count("value").over(f) == window, F.avg("value").over(f)).otherwise(F.col("value"))
    return scan.drop_halo(h.withColumn("value", sm)).select(*cols)


# ------------------------------------------------------------------ EWM

# Largest drop of the cumulative log-multiplier inside one vectorised block
# (keeps exp(-L) far from overflow).
_LOG_SPAN = 50.0


def ewm_valid(x: np.ndarray, pos: np.ndarray, y_in: float, last_pos: int | None, alpha: float) -> np.ndarray:
    """EWM state after every row of a chunk, NaN on NULL rows (to be forward
    filled).  Vectorised: inside a block, ``y_i = e^{L_i} (y_start + Σ_{j≤i}
    b_j e^{-L_j})`` with ``L`` the cumulative log of the multipliers; blocks end
    before ``L`` has dropped by ``_LOG_SPAN`` or at a reset (first valid point,
    or a gap so long that the old state no longer counts)."""
    q = 1.0 - alpha
    out = np.full(len(x), np.nan)
    v = np.nonzero(~np.isnan(x))[0]
    if len(v) == 0:
        return out
    pv = pos[v].astype(np.float64)
    prev = np.empty(len(v))
    prev[0] = np.nan if last_pos is None else float(last_pos)
    prev[1:] = pv[:-1]
    g = pv - prev
    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
        w = np.power(q, g)
        m = np.where(np.isnan(g), 0.0, w / (w + alpha))
        b = np.where(np.isnan(g), x[v], alpha * x[v] / (w + alpha))
    first_reset = np.isnan(y_in) and last_pos is None
    y = np.empty(len(v))
    state = y_in
    i = 0
    n = len(v)
    with np.errstate(divide="ignore"):
        logm = np.log(m)
    while i < n:
        if m[i] == 0.0 or (i == 0 and first_reset):
            state = b[i]
            y[i] = state
            i += 1
            continue
        cum = np.cumsum(logm[i:])
        stop = np.nonzero((cum < -_LOG_SPAN) | ~np.isfinite(cum))[0]
        j = i + (int(stop[0]) if len(stop) else n - i)
        if j == i:  # single huge drop: plain step
            state = m[i] * state + b[i]
            y[i] = state
            i += 1
            continue
        L = cum[: j - i]
        y[i:j] = np.exp(L) * (state + np.cumsum(b[i:j] * np.exp(-L)))
        state = y[j - 1]
        i = j
    out[v] = y
    return out



_EWM_SCHEMA = "series_id string, var string, pos long, value double"


def ewm(df: DataFrame, alpha: float = 0.2, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """pandas ``ewm(alpha, adjust=False).mean()`` semantics with NULL gaps.

    A valid point ``x`` at ``g`` rows after the previous valid point maps the
    state ``y`` to ``(q^g y + a x) / (q^g + a)`` (q = 1-a); the first valid point
    sets ``y = x``; NULL rows repeat ``y``; rows before the first valid point
    stay NULL.
    """
    if not 0 < alpha <= 1:
        raise ValueError("alpha must be in (0, 1]")
    cols = df.columns
    a = float(alpha)
    q = 1.0 - a
    d = scan.with_chunk(df, chunk_rows)
    # last valid position before each chunk (carry over chunks)
    per_chunk = d.groupBy(*KEYS, scan.CHUNK).agg(
        F.max(F.when(F.col("value").isNotNull(), F.col("pos"))).alias("_lv"),
        F.array_sort(
            F.collect_list(
                F.when(F.col("value").isNotNull(), F.struct(F.col("pos").alias("p"), F.col("value").alias("x")))
            )
        ).alias("_pts"),
    )
    wc = Window.partitionBy(*KEYS).orderBy(scan.CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = per_chunk.withColumn("_lv_in", F.max("_lv").over(wc))

    # compose the chunk's maps: state (M, B, last pos); y_end = M*y_in + B
    def step(acc, e):
        g = e["p"] - acc["lp"]
        w = F.pow(F.lit(q), g)
        first = acc["lp"].isNull()
        m = F.when(first, F.lit(0.0)).otherwise(w / (w + F.lit(a)))
        b = F.when(first, e["x"]).otherwise(F.lit(a) * e["x"] / (w + F.lit(a)))
        return F.struct((acc["M"] * m).alias("M"), (acc["B"] * m + b).alias("B"), e["p"].alias("lp"))

    init = F.struct(F.lit(1.0).alias("M"), F.lit(0.0).alias("B"), F.col("_lv_in").alias("lp"))
    maps = per_chunk.select(*KEYS, scan.CHUNK, "_lv_in", F.aggregate("_pts", init, step).alias("_map"))
    maps = maps.select(*KEYS, scan.CHUNK, "_lv_in", F.col("_map.M").alias("_M"), F.col("_map.B").alias("_B"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        # y entering chunk c = composition of the maps of chunks < c; a map with
        # M == 0 starts from scratch (it holds the series' first valid point)
        pdf = pdf.sort_values(scan.CHUNK)
        y = np.nan
        y_in = np.empty(len(pdf))
        for i, (m, b) in enumerate(zip(pdf["_M"].to_numpy(dtype="float64"), pdf["_B"].to_numpy(dtype="float64"))):
            y_in[i] = y
            y = b if m == 0.0 else m * y + b
        return pd.DataFrame({"series_id": pdf["series_id"].to_numpy(), "var": pdf["var"].to_numpy(),
                             scan.CHUNK: pdf[scan.CHUNK].to_numpy(), "_y_in": y_in})

    carry = maps.groupBy(*KEYS).applyInPandas(fold, f"series_id string, var string, {scan.CHUNK} long, _y_in double")
    rows = d.join(carry, on=[*KEYS, scan.CHUNK], how="left").join(
        per_chunk.select(*KEYS, scan.CHUNK, "_lv_in"), on=[*KEYS, scan.CHUNK], how="left"
    )

    def replay(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        x = pdf["value"].to_numpy(dtype="float64", na_value=np.nan)
        pos = pdf["pos"].to_numpy(dtype=np.int64)
        y0 = pdf["_y_in"].iloc[0]
        lp = pdf["_lv_in"].iloc[0]
        y0 = np.nan if pd.isna(y0) else float(y0)
        lp = None if pd.isna(lp) else int(lp)
        yv = ewm_valid(x, pos, y0, lp, a)
        out = pd.Series(yv).ffill().to_numpy()
        out[np.isnan(out)] = y0 if not np.isnan(y0) else np.nan
        return pd.DataFrame({"series_id": pdf["series_id"].to_numpy(), "var": pdf["var"].to_numpy(),
                             "pos": pos, "value": out})

    sm = rows.select(*KEYS, scan.CHUNK, "pos", "value", "_y_in", "_lv_in").groupBy(*KEYS, scan.CHUNK).applyInPandas(
        replay, _EWM_SCHEMA
    )
    return df.drop("value").join(sm, on=[*KEYS, "pos"], how="inner").select(*cols)


# ------------------------------------------------------------------ LOESS


def loess(df: DataFrame, frac: float = 0.1, window: int = 3, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """local linear LOESS with tricube weights on positions; F4: series with
    ``k = int(frac*n) < 2`` fall back to the centred moving average (F1).

    Positions are treated as the regressor (the reference passes ``arange(n)``);
    exact for gap-free series.  A chunk gets the rows of the blocks in which its
    neighbourhoods begin and end (blocks of k/4 rows, at most a chunk) and of
    all blocks in between only their power sums, so a task holds some chunks of
    rows whatever the neighbourhood.  A point whose valid neighbours have
    next to no weight (all at the rim) is NULL.
    """
    if not 0 < frac <= 1:
        raise ValueError("frac must be in (0, 1]")
    cols = df.columns
    size = df.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"), F.avg("value").alias("_mean"))
    k = F.floor(F.col("_n") * F.lit(frac)).cast("bigint")
    size = size.withColumn("_k", k).withColumn(
        "_len", F.greatest(F.lit(1), F.least(F.lit(int(chunk_rows)), F.ceil(F.col("_k") / 4.0))).cast("bigint"))
    d = df.join(size, on=KEYS, how="inner")
    small = d.filter(F.col("_k") < 2).select(*cols)
    big = d.filter(F.col("_k") >= 2)
    rows = big.select(*KEYS, "pos", (F.col("value") - F.col("_mean")).alias("y"), "_len",
                      F.expr("pos div _len").alias("block"))

    # what each chunk needs: block -> its rows, or only its power sums
    c = int(chunk_rows)
    need = size.filter(F.col("_k") >= 2).withColumn(
        scan.CHUNK, F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_n - 1) div {c}"))))
    need = need.withColumn("_a", F.col(scan.CHUNK) * c).withColumn("_b", F.least(F.col("_a") + c, F.col("_n")))

    def left(i):
        return F.least(F.greatest(F.ceil(i - F.col("_k") / 2.0), F.lit(0)), F.col("_n") - F.col("_k")).cast("bigint")

    need = need.withColumn("_l0", left(F.col("_a"))).withColumn("_l1", left(F.col("_b") - 1))
    up = lambda x: f"(({x}) + _len - 1) div _len"
    gaps = {"_g0": up("_l1"), "_g1": "_a div _len", "_h0": up("_b"), "_h1": "(_l0 + _k) div _len"}
    need = need.select("*", *[F.expr(e).alias(n) for n, e in gaps.items()]).withColumn(
        "block", F.explode(F.sequence(F.expr("_l0 div _len"), F.expr("(greatest(_l1 + _k, _b) - 1) div _len"))))
    far = ((F.col("block") >= F.col("_g0")) & (F.col("block") < F.col("_g1"))) | (
        (F.col("block") >= F.col("_h0")) & (F.col("block") < F.col("_h1")))
    need = need.withColumn("_far", far)
    u = (F.expr("pos % _len") - (F.col("_len") - 1) / 2.0) / F.col("_len")
    valid = F.when(F.col("y").isNotNull(), F.lit(1.0))
    sums = rows.groupBy(*KEYS, "block").agg(F.array(
        *[F.coalesce(F.sum(F.pow(u, F.lit(p)) * F.col("y")), F.lit(0.0)) for p in range(kernel.N_VALUE)],
        *[F.coalesce(F.sum(F.pow(u, F.lit(p)) * valid), F.lit(0.0)) for p in range(kernel.N_ONE)]).alias("sums"))
    at = [*KEYS, scan.CHUNK, "block", "_n", "_k", "_len", "_mean"]
    near = need.filter(~F.col("_far")).select(*at).join(rows.drop("_len"), on=[*KEYS, "block"]).withColumn(
        "sums", F.lit(None).cast("array<double>"))
    between = need.filter("_far").select(*at).join(sums, on=[*KEYS, "block"]).withColumn(
        "pos", F.lit(None).cast("bigint")).withColumn("y", F.lit(None).cast("double"))
    parts = near.unionByName(between)

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        n, k, length = (int(pdf[x].iloc[0]) for x in ("_n", "_k", "_len"))
        a = int(pdf[scan.CHUNK].iloc[0]) * c
        points = pdf[pdf["pos"].notna()]
        pos = points["pos"].to_numpy(dtype=np.int64)
        y = points["y"].to_numpy(dtype="float64", na_value=np.nan)
        i = np.sort(pos[(pos >= a) & (pos < a + c)])
        blocks = kernel.Blocks(pos, y, length)
        lo, r = kernel.neighbourhood(i, n, k)
        hi = lo + k
        b = min(a + c, n)
        l0, l1 = (int(kernel.neighbourhood(np.array([x]), n, k)[0][0]) for x in (a, b - 1))
        ends = [(-(-l1 // length) * length, a // length * length), (-(-b // length) * length, (l0 + k) // length * length)]
        sides = [np.zeros((kernel.N_ALL, len(i))) for _ in ends]
        far = pdf[pdf["pos"].isna()]
        for side, (begin, end), (x0, x1) in zip(sides, ends, ((lo, i), (i, hi))):
            if begin < end:  # the blocks in between, the same ones for all points: moved to the chunk, then to the points
                mid, mine = (a + b - 1) / 2.0, far[(far["block"] * length >= begin) & (far["block"] * length < end)]
                if len(mine):
                    centre = mine["block"].to_numpy(dtype="float64") * length + blocks.middle
                    all_ = kernel.moved(np.stack(mine["sums"].to_numpy()).T, (centre - mid) / k,
                                        np.full(len(mine), length / k)).sum(axis=1, keepdims=True)
                    side += kernel.moved(all_, (mid - i) / r, k / r)
                side += blocks.sums(x0, np.minimum(x1, begin), i, r) + blocks.sums(np.maximum(x0, end), x1, i, r)
            else:
                side += blocks.sums(x0, x1, i, r)
        out = kernel.fit(*sides, i, r) + float(pdf["_mean"].iloc[0])
        return pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "var": pdf["var"].iloc[0], "pos": i, "value": out})

    sm = parts.groupBy(*KEYS, scan.CHUNK).applyInPandas(fit, _EWM_SCHEMA)
    fitted = big.select(*[x for x in cols if x != "value"]).join(sm, on=[*KEYS, "pos"], how="inner").select(*cols)
    return fitted.unionByName(moving_average(small, window, chunk_rows))
