"""Stationarity and autocorrelation diagnostics.

All statistics are per ``(series_id, var)`` rows.  ACF, PACF and KPSS reduce
to lag-product sums (:mod:`tsforge.operators.lags`) computed in one chunked
pass; the small per-series solves (Levinson-Durbin) run in a grouped pandas
function over the per-lag table, never over the points.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.functions.expr import sdiv
from tsforge.operators import lags, scan
from tsforge.plans.materialize import cut
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS

# Two-sided 95 % normal quantile and KPSS critical values / p grid.
Z975 = 1.959963984540054
KPSS_CRIT = {"c": [0.347, 0.463, 0.574, 0.739], "ct": [0.119, 0.146, 0.176, 0.216]}
KPSS_PVALS = [0.10, 0.05, 0.025, 0.01]


def trend_direction(df: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """H1: 'increasing' (non-strict monotone up), 'decreasing', or 'unclear'."""
    h = scan.with_halo(df, before=1, after=0, chunk_rows=chunk_rows)
    prev = F.lag("value", 1).over(scan.chunk_window())
    h = h.withColumn("_up", F.coalesce(F.col("value") >= prev, F.lit(True))).withColumn(
        "_dn", F.coalesce(F.col("value") <= prev, F.lit(True))
    )
    a = scan.drop_halo(h).groupBy(*KEYS).agg(F.bool_and("_up").alias("_u"), F.bool_and("_dn").alias("_d"))
    return a.select(
        *KEYS,
        F.when(F.col("_u"), "increasing").when(F.col("_d"), "decreasing").otherwise("unclear").alias("trend"),
    )


def autocorr(df: DataFrame, lag: int = 12, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """H2: Pearson correlation of the series with itself shifted by ``lag``
    (pairwise complete), NULL when a side has zero variance.  Adds ``n`` (rows)."""
    h = scan.with_halo(df, before=lag, after=0, chunk_rows=chunk_rows)
    h = h.withColumn("_y", F.lag("value", lag).over(scan.chunk_window()))
    d = scan.drop_halo(h)
    both = F.col("value").isNotNull() & F.col("_y").isNotNull()
    x = F.when(both, F.col("value"))
    y = F.when(both, F.col("_y"))
    a = d.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("n"),
        F.covar_pop(x, y).alias("_c"),
        F.var_pop(x).alias("_vx"),
        F.var_pop(y).alias("_vy"),
    )
    r = sdiv(F.col("_c"), F.sqrt(F.col("_vx") * F.col("_vy")))
    return a.select(*KEYS, "n", F.lit(lag).cast("bigint").alias("lag"), r.alias("autocorr"))


def seasonality(df: DataFrame, period: int = 12, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """H3: seasonal iff ``n >= 2*period`` and ``|autocorr(period)| > 0.5``."""
    a = autocorr(df, period, chunk_rows)
    flag = (F.col("n") >= 2 * period) & F.coalesce(F.abs(F.col("autocorr")) > 0.5, F.lit(False))
    return a.select(*KEYS, "n", F.lit(period).cast("bigint").alias("period"), "autocorr", flag.alias("seasonal"))


def acf(df: DataFrame, nlags: int = 40, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """H4 + H5: biased ACF for lags 0..nlags with the Bartlett 95 % band.

    Columns: ``lag, acf, band`` where band is the half-width
    ``z·sqrt((1 + 2Σ_{j<k} acf_j²)/n)`` (lag 0 → 0, lag 1 → z/√n)."""
    c = lags.centred(df)
    ls = lags.lag_sums(c, nlags, x="_e", chunk_rows=chunk_rows)
    n = c.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    a = ls.join(n, on=KEYS, how="inner")
    w0 = Window.partitionBy(*KEYS)
    g0 = F.max(F.when(F.col("lag") == 0, F.col("s"))).over(w0)
    a = a.withColumn("acf", sdiv(F.col("s"), g0))
    wc = Window.partitionBy(*KEYS).orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    sq = F.coalesce(F.sum(F.when(F.col("lag") >= 1, F.col("acf") * F.col("acf"))).over(wc), F.lit(0.0))
    band = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(
        F.lit(Z975) * F.sqrt((F.lit(1.0) + F.lit(2.0) * sq) / F.col("n"))
    )
    return a.select(*KEYS, "lag", "n", "acf", band.alias("band"))


def _verdict(count, lagmax, nlags: int):
    return (
        F.when(count == 0, F.lit("white_noise"))
        .when(count > F.lit(nlags / 2.0), F.lit("slow_decay"))
        .otherwise(F.concat(F.lit("cutoff_"), lagmax.cast("string")))
    )


def acf_significant(df: DataFrame, nlags: int = 40, rule: str = "reference", chunk_rows: int = DEFAULT_CHUNK_ROWS):
    """H6: significant lags of the ACF.  ``rule='reference'`` compares |acf| with
    the full band width (2·half-width) and counts lag 0, as the reference does;
    ``rule='halfwidth'`` uses the half-width and lags >= 1."""
    a = acf(df, nlags, chunk_rows)
    if rule == "reference":
        sig = F.abs(F.col("acf")) > F.lit(2.0) * F.col("band")
    elif rule == "halfwidth":
        sig = (F.col("lag") >= 1) & (F.abs(F.col("acf")) > F.col("band"))
    else:
        raise ValueError("rule must be 'reference' or 'halfwidth'")
    s = a.withColumn("_sig", F.coalesce(sig, F.lit(False)))
    g = s.groupBy(*KEYS).agg(
        F.array_sort(F.collect_list(F.when(F.col("_sig"), F.col("lag")))).alias("significant_lags"),
        F.sum(F.col("_sig").cast("bigint")).alias("n_significant"),
        F.max(F.when(F.col("_sig"), F.col("lag"))).alias("last_significant"),
    )
    return g.withColumn("verdict", _verdict(F.col("n_significant"), F.col("last_significant"), nlags))


# ------------------------------------------------------------------ PACF


def _levinson(gamma: np.ndarray, nlags: int) -> np.ndarray:
    """PACF from autocovariances gamma[0..nlags] (Durbin-Levinson)."""
    out = np.full(nlags + 1, np.nan)
    out[0] = 1.0
    if gamma[0] == 0 or not np.isfinite(gamma[0]):
        return out
    phi = np.zeros(nlags + 1)
    v = gamma[0]
    for k in range(1, nlags + 1):
        acc = gamma[k] - np.dot(phi[1:k], gamma[1:k][::-1])
        if v == 0:
            break
        pk = acc / v
        new = phi.copy()
        new[k] = pk
        new[1:k] = phi[1:k] - pk * phi[1:k][::-1]
        phi = new
        v = v * (1 - pk * pk)
        out[k] = pk
    return out


def pacf(df: DataFrame, nlags: int = 40, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """H7: Yule-Walker PACF with adjusted autocovariances (divisor n-k).
    Columns ``lag, n, pacf, band`` (band = 1.96/√n, H8)."""
    c = lags.centred(df)
    ls = lags.lag_sums(c, nlags, x="_e", chunk_rows=chunk_rows)
    n = c.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    a = ls.join(n, on=KEYS, how="inner").withColumn("gamma", sdiv(F.col("s"), F.col("n") - F.col("lag")))

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        g = pdf["gamma"].to_numpy(dtype="float64", na_value=np.nan)
        p = _levinson(g, len(g) - 1)
        nn = int(pdf["n"].iloc[0])
        return pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "var": pdf["var"].iloc[0],
                             "lag": pdf["lag"].to_numpy(), "n": nn, "pacf": p,
                             "band": Z975 / math.sqrt(nn) if nn > 0 else np.nan})

    return a.select(*KEYS, "lag", "n", "gamma").groupBy(*KEYS).applyInPandas(
        solve, "series_id string, var string, lag long, n long, pacf double, band double"
    )


def pacf_significant(df: DataFrame, nlags: int = 40, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """H8: PACF lags with |pacf| > 1.96/√n (lag 0 included, as in the reference)."""
    p = pacf(df, nlags, chunk_rows)
    s = p.withColumn("_sig", F.coalesce(F.abs(F.col("pacf")) > F.col("band"), F.lit(False)))
    g = s.groupBy(*KEYS).agg(
        F.array_sort(F.collect_list(F.when(F.col("_sig"), F.col("lag")))).alias("significant_lags"),
        F.sum(F.col("_sig").cast("bigint")).alias("n_significant"),
        F.max(F.when(F.col("_sig"), F.col("lag"))).alias("last_significant"),
    )
    return g.withColumn("verdict", _verdict(F.col("n_significant"), F.col("last_significant"), nlags))


# ------------------------------------------------------------------ KPSS


def _kpss_p_expr(stat, regression: str):
    crit, pv = KPSS_CRIT[regression], KPSS_PVALS
    # np.interp over increasing critical values, clipped to [0.01, 0.10]
    e = F.when(stat <= crit[0], F.lit(pv[0]))
    for i in range(len(crit) - 1):
        x0, x1, y0, y1 = crit[i], crit[i + 1], pv[i], pv[i + 1]
        e = e.when(stat <= x1, F.lit(y0) + (stat - F.lit(x0)) * F.lit((y1 - y0) / (x1 - x0)))
    return e.otherwise(F.lit(pv[-1]))


def _partial_sums(e: DataFrame, maxlag: int, chunk_rows: int) -> DataFrame:
    """Per chunk of ``_e`` (NULL: 0): m rows, total, the sums of the running sum and of its
    square from the chunk's start (upto, upto2), and the lag products of lags 0..maxlag."""
    h = scan.with_halo(e, before=maxlag, after=0, chunk_rows=chunk_rows)

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        v, home = pdf["_e"].to_numpy(dtype="float64", na_value=np.nan), pdf[scan.HOME].to_numpy(dtype=bool)
        upto = np.cumsum(np.nan_to_num(v[home]))
        v, home = lags.on_grid(pdf["pos"].to_numpy(dtype=np.int64), v, home)
        products, _ = lags.lag_products(v, v, home, maxlag)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in (*KEYS, scan.CHUNK)}, "m": [len(upto)],
                             "total": [upto[-1] if len(upto) else 0.0], "upto": [upto.sum()],
                             "upto2": [(upto * upto).sum()], "products": [products]})

    return h.groupBy(*KEYS, scan.CHUNK).applyInPandas(
        part, f"series_id string, var string, {scan.CHUNK} long, m long, total double, upto double, upto2 double, "
              "products array<double>")


def kpss(df: DataFrame, regression: str = "c", nlags="auto", chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """KPSS statistic, p-value (interpolated, clipped to [0.01, 0.10]) and
    lags; ``stationary`` iff p > 0.05.  Residuals from the mean (``c``) or a
    linear trend in position (``ct``); Bartlett long-run variance; automatic
    lag rule of Hobijn et al. (as statsmodels ``nlags='auto'``)."""
    if regression not in KPSS_CRIT:
        raise ValueError("regression must be 'c' or 'ct'")
    # read 1: the regression; read 2: partial sums and short lags per chunk; read 3 (automatic lags): the lags it wants
    if regression == "c":
        fitted = [F.avg("value").alias("_a"), F.lit(0.0).alias("_b")]
    else:
        fitted = [F.regr_intercept("value", "pos").alias("_a"), F.regr_slope("value", "pos").alias("_b")]
    st = cut(df.groupBy(*KEYS).agg(*fitted, F.count(F.lit(1)).alias("n")))
    e = df.select(*KEYS, "pos", "value").join(st, on=KEYS).select(
        *KEYS, "pos", (F.col("value") - F.col("_a") - F.col("_b") * F.col("pos")).alias("_e"))
    n_max = st.agg(F.max("n")).first()[0] or 0
    short = int(n_max ** (2.0 / 9.0)) if nlags == "auto" else min(int(nlags), max(n_max - 1, 0))
    parts = cut(_partial_sums(e, short, chunk_rows))
    before = Window.partitionBy(*KEYS).orderBy(scan.CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    c = F.coalesce(F.sum("total").over(before), F.lit(0.0))
    eta = parts.select(*KEYS, (F.col("m") * c * c + 2.0 * c * F.col("upto") + F.col("upto2")).alias("_v")).groupBy(
        *KEYS).agg(F.sum("_v").alias("_ss")).join(st.select(*KEYS, "n"), on=KEYS)
    ls = lags.summed(parts, KEYS, {"products": "s"})
    if nlags == "auto":
        covl = F.floor(F.pow(F.col("n").cast("double"), F.lit(2.0 / 9.0)))
        g = ls.join(st.select(*KEYS, "n"), on=KEYS).filter(F.col("lag") <= covl).withColumn(
            "_r", F.when(F.col("lag") == 0, F.col("s") / F.col("n")).otherwise(F.col("s") / (F.col("n") / 2.0)))
        sh = g.groupBy(*KEYS, "n").agg(F.sum("_r").alias("_s0"), F.sum(F.col("lag") * F.col("_r")).alias("_s1"))
        auto = F.floor(
            F.lit(1.1447) * F.pow(F.pow(F.col("_s1") / F.col("_s0"), F.lit(2.0)), F.lit(1.0 / 3.0))
            * F.pow(F.col("n").cast("double"), F.lit(1.0 / 3.0))
        ).cast("bigint")
        lag_tab = cut(sh.select(*KEYS, F.least(auto, F.col("n") - 1).alias("lags")))
        lmax = lag_tab.agg(F.max("lags")).first()[0] or 0
        ls = lags.lag_sums(e, int(lmax), x="_e", chunk_rows=chunk_rows)
    else:
        lag_tab = eta.select(*KEYS, F.least(F.lit(int(nlags)), F.col("n") - 1).alias("lags"))
    gl = ls.join(lag_tab, on=KEYS).filter(F.col("lag") <= F.col("lags"))
    wts = F.when(F.col("lag") == 0, F.lit(1.0)).otherwise(2.0 * (1.0 - F.col("lag") / (F.col("lags") + 1.0)))
    lrv = gl.groupBy(*KEYS, "lags").agg(F.sum(wts * F.col("s")).alias("_lrv"))
    out = eta.join(lrv, on=KEYS).withColumn("_s2", F.col("_lrv") / F.col("n"))
    stat = sdiv(F.col("_ss") / (F.col("n") * F.col("n")), F.col("_s2"))
    out = out.select(*KEYS, "n", "lags", stat.alias("statistic"))
    p = _kpss_p_expr(F.col("statistic"), regression)
    crit = F.create_map(*sum(([F.lit(k), F.lit(v)] for k, v in zip(["10%", "5%", "2.5%", "1%"], KPSS_CRIT[regression])), []))
    return out.select(*KEYS, "n", "lags", "statistic", p.alias("p_value"), crit.alias("critical_values"),
                      (p > 0.05).alias("stationary"))


# ------------------------------------------------------------------ verdicts


def verdict_expr(adf_p, kpss_p, alpha: float = 0.05):
    """H13 ladder: ADF stationary iff p <= alpha; KPSS stationary iff p > alpha."""
    a = adf_p <= F.lit(alpha)
    k = kpss_p > F.lit(alpha)
    return (
        F.when(a & k, "strictly_stationary")
        .when(~a & ~k, "non_stationary")
        .when(a & ~k, "trend_stationary")
        .otherwise("difference_stationary")
    )
