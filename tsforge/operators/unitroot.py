"""Unit-root and cointegration tests (H9-H11, H13, J7-J9) on the moments pass.

* ADF: one Gram of ``[1, x_{t-1}, Δx_{t-1..P}, Δx_t]`` over the common sample
  gives every lag order's SSR (nested leading blocks) for AIC/BIC selection;
  the final fit adds the head rows the chosen order can use.
* Phillips-Perron: OLS of ``x_t`` on ``[1, x_{t-1}]`` from regression
  aggregates, Newey-West long-run variance from residual lag sums.
* Engle-Granger: OLS residual of ``y ~ 1 + x`` then ADF without constant,
  two-variable MacKinnon p-value.
* Granger: one Gram of ``[1, y lags, x lags, y]``; restricted / unrestricted
  SSRs per lag order, SSR F-test.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.functions import dist
from tsforge.functions.expr import sdiv
from tsforge.operators import lags, moments, relations, scan
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS

ADF_SCHEMA = ("series_id string, var string, statistic double, p_value double, used_lag long, nobs long, "
              "icbest double, crit_1 double, crit_5 double, crit_10 double, stationary boolean")


# Fixed value: one-sided 95 % normal quantile, the level of the last lag with autolag 't-stat'.
Z95 = 1.6448536269514722


def default_maxlag(n: int, ntrend: int) -> int:
    return min(n // 2 - ntrend - 1, int(math.ceil(12.0 * (n / 100.0) ** 0.25)))


def adf(
    df: DataFrame,
    regression: str = "c",
    autolag: str | None = "AIC",
    maxlag: int | None = None,
    alpha: float = 0.05,
    n_vars: int = 1,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
) -> DataFrame:
    """H9: augmented Dickey-Fuller test per ``(series_id, var)`` (regression
    ``c`` or ``n``; autolag ``AIC``, ``BIC``, ``t-stat`` (the longest lag order whose
    last lag is significant, ``icbest`` its absolute t value) or ``None``).  The
    input must be gap-free (fill first).  ``n_vars`` selects the MacKinnon table (2 for
    Engle-Granger residuals)."""
    if regression not in ("c", "n"):
        raise ValueError("regression must be 'c' or 'n'")
    if autolag not in ("AIC", "BIC", "aic", "bic", "t-stat", None):
        raise ValueError("autolag must be 'AIC', 'BIC', 't-stat' or None")
    ntrend = 1 if regression == "c" else 0
    # residuals of a regression with constant (n_vars = 2) use the constant case's tables
    table = "n" if regression == "n" and n_vars == 1 else "c"
    st = df.groupBy(*KEYS).agg(F.count("value").alias("_n"), F.avg("value").alias("_mu"))
    n_max = st.agg(F.max("_n")).first()[0] or 0
    P = maxlag if maxlag is not None else max(default_maxlag(int(n_max), ntrend), 0)
    ml = (F.lit(int(maxlag)) if maxlag is not None else
          F.least(F.floor(F.col("_n") / 2) - ntrend - 1, F.ceil(12.0 * F.pow(F.col("_n") / 100.0, 0.25)))).cast("bigint")
    # centring improves conditioning and is exact when a constant is in the
    # model; without a constant ('n') the level itself matters
    x = F.col("value") - F.col("_mu") if ntrend else F.col("value")
    d = (df.join(st, on=KEYS).withColumn("_ml", ml).withColumn("_x", x)
         .withColumn("_start", F.col("_ml") + 1))
    width = ntrend + 1 + P + 1

    def build(a, pos):
        x = a["_x"]
        m = len(x)
        dx = np.full(m, np.nan)
        dx[1:] = x[1:] - x[:-1]
        cols = []
        if ntrend:
            cols.append(np.ones(m))
        xl = np.full(m, np.nan)
        xl[1:] = x[:-1]
        cols.append(xl)
        for j in range(1, P + 1):
            c = np.full(m, np.nan)
            c[j:] = dx[:-j] if j < m else c[j:]
            cols.append(c)
        cols.append(dx)
        return np.column_stack(cols) if m else np.zeros((0, width))

    def needed(start):  # start = own maxlag + 1: trend, x_{t-1}, its own lags, Δx_t
        return list(range(ntrend + start)) + [width - 1]

    g = moments.lagged_gram(d, ["_x"], halo=P + 1, width=width, build=build, chunk_rows=chunk_rows, needed=needed)
    g = g.join(d.groupBy(*KEYS).agg(F.first("_n").alias("n"), F.first("_ml").alias("ml")), on=KEYS)
    crit_vars = n_vars
    method = autolag.upper() if autolag else None

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        n, mlag = int(r["n"]), int(r["ml"])
        G = np.asarray(r["gram"], dtype="float64").reshape(width, width)
        heads = sorted(((int(h["pos"]), np.asarray(h["z"], dtype="float64")) for h in r["heads"]), key=lambda t: t[0])
        y = width - 1
        base = list(range(ntrend + 1))
        out = dict(series_id=r["series_id"], var=r["var"], statistic=np.nan, p_value=np.nan, used_lag=None,
                   nobs=None, icbest=np.nan, crit_1=np.nan, crit_5=np.nan, crit_10=np.nan, stationary=None)
        if mlag < 0 or n - 1 - mlag <= len(base):
            return pd.DataFrame([out])
        best, icbest = mlag, np.nan
        body_rows = int(r["rows"])  # rows actually in the common sample (gaps skipped)
        if method == "T-STAT":
            for p in range(mlag, -1, -1):
                cols = base + [ntrend + 1 + j for j in range(p)]
                b, ssr, inv = moments.ols_from_gram(G, cols, y)
                var = ssr / (body_rows - len(cols)) * inv[-1, -1] if body_rows > len(cols) else 0.0
                best, icbest = p, abs(b[-1]) / math.sqrt(var) if var > 0 else np.inf
                if icbest >= Z95:
                    break
        elif method:
            nob = body_rows
            scores = []
            for p in range(0, mlag + 1):
                cols = base + [ntrend + 1 + j for j in range(p)]
                _, ssr, _ = moments.ols_from_gram(G, cols, y)
                llf = -nob / 2.0 * (math.log(2 * math.pi) + math.log(ssr / nob) + 1.0) if ssr > 0 else np.inf
                k = len(cols)
                ic = -2 * llf + (2 * k if method == "AIC" else math.log(nob) * k)
                scores.append((ic, k, p))
            icbest, _, best = min(scores)
        cols = base + [ntrend + 1 + j for j in range(best)]
        Gf = G.copy()
        nob = body_rows
        for p_, z in heads:
            if p_ >= best + 1 and not np.isnan(z[cols + [y]]).any():
                zz = np.where(np.isnan(z), 0.0, z)
                Gf += np.outer(zz, zz)
                nob += 1
        beta, ssr, inv = moments.ols_from_gram(Gf, cols, y)
        dof = nob - len(cols)
        if dof <= 0:
            return pd.DataFrame([out])
        s2 = ssr / dof
        ix = ntrend  # position of x_{t-1} in cols
        se = math.sqrt(s2 * inv[ix, ix]) if s2 * inv[ix, ix] > 0 else np.nan
        stat = beta[ix] / se if se and np.isfinite(se) else np.nan
        p = dist.mackinnon_p(stat, crit_vars, table)
        cv = dist.mackinnon_crit(nob, crit_vars, table)
        out.update(statistic=stat, p_value=p, used_lag=best, nobs=nob, icbest=icbest,
                   crit_1=cv["1%"], crit_5=cv["5%"], crit_10=cv["10%"],
                   stationary=bool(p <= alpha) if np.isfinite(p) else None)
        return pd.DataFrame([out])

    return g.groupBy(*KEYS).applyInPandas(solve, ADF_SCHEMA)


def phillips_perron(df: DataFrame, lags_: int | None = None, alpha: float = 0.05,
                    chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Phillips-Perron Z-tau (constant), Bartlett long-run variance with
    ``ceil(12 (n/100)^¼)`` lags by default; MacKinnon p-value."""
    h = scan.with_halo(df, before=1, after=0, chunk_rows=chunk_rows)
    h = h.withColumn("_yl", F.lag("value", 1).over(scan.chunk_window()))
    full = scan.drop_halo(h)  # keeps every position (lag products stay position-based)
    d = full.filter(F.col("_yl").isNotNull() & F.col("value").isNotNull())
    reg = d.groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("_m"), F.regr_slope("value", "_yl").alias("_b"),
        F.regr_intercept("value", "_yl").alias("_a"), F.var_pop("_yl").alias("_vy"))
    n_tab = df.groupBy(*KEYS).agg(F.count("value").alias("n"))
    lag_n = (F.lit(int(lags_)) if lags_ is not None else F.ceil(12.0 * F.pow(F.col("n") / 100.0, 0.25))).cast("bigint")
    reg = reg.join(n_tab, on=KEYS).withColumn("lags", lag_n)
    Lmax = int(lags_) if lags_ is not None else int(reg.agg(F.max("lags")).first()[0] or 0)
    u = full.join(reg.select(*KEYS, "_a", "_b"), on=KEYS).withColumn(
        "_u", F.col("value") - F.col("_a") - F.col("_b") * F.col("_yl"))
    ls = lags.lag_sums(u.select(*KEYS, "pos", "_u"), Lmax, x="_u", chunk_rows=chunk_rows)
    j = ls.join(reg.select(*KEYS, "_m", "lags"), on=KEYS).filter(F.col("lag") <= F.col("lags"))
    w = F.when(F.col("lag") == 0, F.lit(1.0)).otherwise(2.0 * (1.0 - F.col("lag") / (F.col("lags") + 1.0)))
    lr = j.groupBy(*KEYS).agg(F.sum(F.when(F.col("lag") == 0, F.col("s"))).alias("_uu"),
                              F.sum(w * F.col("s")).alias("_lrs"))
    t = reg.join(lr, on=KEYS)
    m = F.col("_m")
    gamma0 = F.col("_uu") / m
    lam2 = F.col("_lrs") / m
    s2 = F.col("_uu") / (m - 2)
    se = F.sqrt(s2 / (m * F.col("_vy")))
    tstat = sdiv(F.col("_b") - 1.0, se)
    z = F.sqrt(sdiv(gamma0, lam2)) * tstat - 0.5 * sdiv(lam2 - gamma0, F.sqrt(lam2)) * sdiv(m * se, F.sqrt(s2))
    out = t.select(*KEYS, "n", "lags", z.alias("statistic"))

    @F.pandas_udf("double")
    def pval(s: pd.Series) -> pd.Series:
        return s.map(lambda v: dist.mackinnon_p(float(v), 1) if pd.notna(v) else np.nan)

    return out.withColumn("p_value", pval("statistic")).withColumn("stationary", F.col("p_value") <= alpha)


def engle_granger(df: DataFrame, y: str, x: str, alpha: float = 0.05, autolag: str | None = "AIC",
                  maxlag: int | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Cointegration of ``y`` and ``x`` (same series_id): OLS residual, ADF
    without constant (AIC by default), two-variable MacKinnon p; cointegrated
    iff p < alpha."""
    relations.require(df, y, x)
    w = relations.wide(df.filter(F.col("var").isin(y, x)), [x, y]).dropna(subset=[x, y])
    co = w.groupBy("series_id").agg(F.regr_slope(y, x).alias("_b"), F.regr_intercept(y, x).alias("_a"))
    r = w.join(co, on="series_id").select(
        "series_id", F.lit(f"{y}~{x}").alias("var"), "ts", "pos", (F.col(y) - F.col("_a") - F.col("_b") * F.col(x)).alias("value"))
    res = adf(r, regression="n", autolag=autolag, maxlag=maxlag, n_vars=2, chunk_rows=chunk_rows)
    return res.join(co.select("series_id", F.col("_b").alias("slope"), F.col("_a").alias("intercept")), on="series_id") \
        .withColumn("cointegrated", F.col("p_value") < alpha)


GRANGER_SCHEMA = "series_id string, dependent string, independent string, lag long, f_stat double, p_value double, df_num long, df_denom long, significant boolean"


def granger(df: DataFrame, dependent: str, independent: str, maxlag: int = 4, alpha: float = 0.05,
            chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Does ``independent`` help predict ``dependent``?  SSR F-test per
    lag order 1..maxlag (each order on its own sample, starting at row L)."""
    M = int(maxlag)
    relations.require(df, dependent, independent)
    w = relations.wide(df.filter(F.col("var").isin(dependent, independent)), [dependent, independent])
    d = w.select("series_id", F.lit("granger").alias("var"), "pos", F.col(dependent).alias("_y"),
                 F.col(independent).alias("_x"))
    st = d.groupBy("series_id").agg(F.avg("_y").alias("_my"), F.avg("_x").alias("_mx"), F.min("pos").alias("_p0"),
                                    F.count(F.lit(1)).alias("n"))
    d = (d.join(st, on="series_id").withColumn("_y", F.col("_y") - F.col("_my")).withColumn("_x", F.col("_x") - F.col("_mx"))
         .withColumn("_start", F.col("_p0") + M))
    width = 1 + 2 * M + 1

    def build(a, pos):
        yv, xv = a["_y"], a["_x"]
        m = len(yv)
        cols = [np.ones(m)]
        for series in (yv, xv):
            for j in range(1, M + 1):
                c = np.full(m, np.nan)
                if j < m:
                    c[j:] = series[:-j]
                cols.append(c)
        cols.append(yv)
        return np.column_stack(cols) if m else np.zeros((0, width))

    g = moments.lagged_gram(d, ["_y", "_x"], halo=M, width=width, build=build, chunk_rows=chunk_rows)
    g = g.join(st.select("series_id", "n", "_p0"), on="series_id")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        r = pdf.iloc[0]
        n, p0 = int(r["n"]), int(r["_p0"])
        G = np.asarray(r["gram"], dtype="float64").reshape(width, width)
        heads = [(int(h["pos"]), np.asarray(h["z"], dtype="float64")) for h in r["heads"]]
        rows = []
        for L in range(1, M + 1):
            restricted = [0] + [j for j in range(1, L + 1)]
            unrestricted = restricted + [M + j for j in range(1, L + 1)]
            GL = G.copy()
            for p_, z in heads:
                if p_ - p0 >= L and not np.isnan(z[unrestricted + [width - 1]]).any():
                    zz = np.where(np.isnan(z), 0.0, z)
                    GL += np.outer(zz, zz)
            nob = int(round(GL[0, 0]))  # rows in the regression (constant column), gaps skipped
            _, ssr_r, _ = moments.ols_from_gram(GL, restricted, width - 1)
            _, ssr_u, _ = moments.ols_from_gram(GL, unrestricted, width - 1)
            dfd = nob - 2 * L - 1
            f = ((ssr_r - ssr_u) / L) / (ssr_u / dfd) if dfd > 0 and ssr_u > 0 else np.nan
            p = dist.f_sf(f, L, dfd) if np.isfinite(f) else np.nan
            rows.append((r["series_id"], dependent, independent, L, f, p, L, dfd, bool(p < alpha) if np.isfinite(p) else None))
        return pd.DataFrame(rows, columns=["series_id", "dependent", "independent", "lag", "f_stat", "p_value", "df_num",
                                           "df_denom", "significant"])

    return g.groupBy("series_id").applyInPandas(solve, GRANGER_SCHEMA)


def stationarity_verdict(adf_res: DataFrame, kpss_res: DataFrame, alpha: float = 0.05) -> DataFrame:
    """Join ADF and KPSS results, apply the verdict ladder."""
    from tsforge.operators.stationarity import verdict_expr

    j = adf_res.select(*KEYS, F.col("p_value").alias("adf_p")).join(
        kpss_res.select(*KEYS, F.col("p_value").alias("kpss_p")), on=KEYS)
    return j.select(*KEYS, "adf_p", (F.col("adf_p") <= alpha).alias("adf_stationary"), "kpss_p",
                    (F.col("kpss_p") > alpha).alias("kpss_stationary"),
                    verdict_expr(F.col("adf_p"), F.col("kpss_p"), alpha).alias("conclusion"))


# Johansen critical values (det_order 0) at 90, 95 and 99 %, for k - r = 1..12.
JOHANSEN_TRACE = (
    (2.7055, 3.8415, 6.6349), (13.4294, 15.4943, 19.9349), (27.0669, 29.7961, 35.4628), (44.4929, 47.8545, 54.6815),
    (65.8202, 69.8189, 77.8202), (91.1090, 95.7542, 104.9637), (120.3673, 125.6185, 135.9825),
    (153.6341, 159.5290, 171.0905), (190.8714, 197.3772, 210.0366), (232.1030, 239.2468, 253.2526),
    (277.3740, 285.1402, 300.2821), (326.5354, 334.9795, 351.2150),
)
JOHANSEN_MAXEIG = (
    (2.7055, 3.8415, 6.6349), (12.2971, 14.2639, 18.5200), (18.8928, 21.1314, 25.8650), (25.1236, 27.5858, 32.7172),
    (31.2379, 33.8777, 39.3693), (37.2786, 40.0763, 45.8662), (43.2947, 46.2299, 52.3069), (49.2855, 52.3622, 58.6634),
    (55.2412, 58.4332, 64.9960), (61.2041, 64.5040, 71.2525), (67.1307, 70.5392, 77.4877), (73.0563, 76.5734, 83.7105),
)

JOHANSEN_SCHEMA = ("series_id string, r long, eigenvalue double, trace_stat double, trace_crit_90 double, "
                   "trace_crit_95 double, trace_crit_99 double, max_eig_stat double, max_eig_crit_90 double, "
                   "max_eig_crit_95 double, max_eig_crit_99 double, rank long")


def johansen(df: DataFrame, vars_: list[str] | None = None, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Johansen trace / max-eigenvalue statistics (constant, one lagged
    difference) for the listed variables of each series; ``rank`` from the
    sequential 95 % trace test.  Beyond the tables (k - r > 12) the critical
    values are NULL, and so is ``rank`` if the test needs one of them.  One Gram pass of
    ``[1, Δx_t, Δx_{t-1}, x_{t-1}]``; the k×k eigenproblem per series."""
    vars_ = vars_ or relations.variables(df)
    k = len(vars_)
    w = relations.wide(df.filter(F.col("var").isin(*vars_)), vars_).dropna(subset=vars_)
    st = w.groupBy("series_id").agg(F.min("pos").alias("_p0"), F.count(F.lit(1)).alias("_N"))
    d = w.join(st, on="series_id").select("series_id", F.lit("johansen").alias("var"), "pos",
                                          *[F.col(v).alias(f"_v{i}") for i, v in enumerate(vars_)],
                                          (F.col("_p0") + 2).alias("_start"))
    width = 1 + 3 * k
    cols = [f"_v{i}" for i in range(k)]

    def build(a, pos):
        X = np.column_stack([a[c] for c in cols]) if cols else np.zeros((len(pos), 0))
        m = len(pos)
        dx = np.full_like(X, np.nan)
        dx[1:] = X[1:] - X[:-1]
        dxl = np.full_like(X, np.nan)
        dxl[1:] = dx[:-1]
        xl = np.full_like(X, np.nan)
        xl[1:] = X[:-1]
        return np.column_stack([np.ones(m), dx, dxl, xl])

    g = moments.lagged_gram(d, cols, halo=2, width=width, build=build, chunk_rows=chunk_rows)

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        G = np.asarray(pdf["gram"].iloc[0], dtype="float64").reshape(width, width)
        n = G[0, 0]
        s = G[0, 1:] / n
        C = G[1:, 1:] / n - np.outer(s, s)  # demeaned second moments
        i0, i1, ik = slice(0, k), slice(k, 2 * k), slice(2 * k, 3 * k)
        S11 = C[i1, i1]
        inv11 = np.linalg.pinv(S11)

        def part(a, b):
            return C[a, b] - C[a, i1] @ inv11 @ C[i1, b]

        s00, s0k, skk = part(i0, i0), part(i0, ik), part(ik, ik)
        sig = s0k.T @ np.linalg.pinv(s00) @ s0k
        lam = np.sort(np.real(np.linalg.eigvals(np.linalg.pinv(skk) @ sig)))[::-1]
        lam = np.clip(lam, 0.0, 1.0 - 1e-15)
        rows, rank, unknown = [], None, False
        missing = (np.nan,) * 3
        for r in range(k):
            trace = -n * np.sum(np.log(1.0 - lam[r:]))
            maxe = -n * np.log(1.0 - lam[r])
            kr = k - r
            tc = JOHANSEN_TRACE[kr - 1] if kr <= len(JOHANSEN_TRACE) else missing
            mc = JOHANSEN_MAXEIG[kr - 1] if kr <= len(JOHANSEN_MAXEIG) else missing
            unknown = unknown or (rank is None and np.isnan(tc[1]))
            if rank is None and not unknown and trace <= tc[1]:
                rank = r
            rows.append([pdf["series_id"].iloc[0], r, lam[r], trace, *tc, maxe, *mc])
        out = pd.DataFrame(rows, columns=["series_id", "r", "eigenvalue", "trace_stat", "trace_crit_90", "trace_crit_95",
                                          "trace_crit_99", "max_eig_stat", "max_eig_crit_90", "max_eig_crit_95",
                                          "max_eig_crit_99"])
        out["rank"] = pd.array([None if unknown else k if rank is None else rank] * len(out), dtype="Int64")
        return out

    return g.select("series_id", "gram").groupBy("series_id").applyInPandas(solve, JOHANSEN_SCHEMA)
