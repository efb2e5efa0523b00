"""Multivariate relationships.

Variables of one series are the ``var`` values of a ``series_id``.  Pairwise
statistics are one aggregation over a pivoted frame (one row per
``(series_id, pos)``, one column per variable), so the work is a single
shuffle by ``(series_id, pos)`` whatever the series length; the per-series
k×k results are tiny tables.  Eigen-solves run in a grouped pandas function
over those k×k tables, never over the points.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.functions.expr import sdiv
from tsforge.operators import lags
from tsforge.operators.quantile import value_ranks
from tsforge.plans.materialize import cut
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS

# Fixed value: two-sided 95 % normal quantile.
Z975 = 1.959963984540054


def variables(df: DataFrame) -> list[str]:
    """Distinct variable names, sorted (the column order used for pairs)."""
    return sorted(r[0] for r in df.select("var").distinct().collect())


def wide(df: DataFrame, vars_: list[str] | None = None) -> DataFrame:
    """Pivot the long frame to ``series_id, pos, ts, <var>...``."""
    vars_ = vars_ or variables(df)
    # one aggregation (one shuffle by series_id, pos) instead of pivot + join for ts
    return df.groupBy("series_id", "pos").agg(
        F.first("ts", ignorenulls=True).alias("ts"),
        *[F.max(F.when(F.col("var") == v, F.col("value"))).alias(v) for v in vars_],
    )


def _pair_stats(w: DataFrame, vars_: list[str], fn, *more) -> DataFrame:
    """One row per series: ``_p<i>_<j>`` = fn of each pair on its complete rows, and the aggregates ``more``."""
    aggs = [F.count(F.lit(1)).alias("_rows"), *more]
    for i, a in enumerate(vars_):
        for j in range(i + 1, len(vars_)):
            b = vars_[j]
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            aggs.append(fn(F.when(both, F.col(a)), F.when(both, F.col(b))).alias(f"_p{i}_{j}"))
    return w.groupBy("series_id").agg(*aggs)


def _pearson(xa, xb):
    return sdiv(F.covar_pop(xa, xb), F.sqrt(F.var_pop(xa) * F.var_pop(xb)))


def correlation(df: DataFrame, method: str = "pearson", vars_: list[str] | None = None) -> DataFrame:
    """J1/J2 (+L3): long matrix ``series_id, var1, var2, corr`` incl. the diagonal.
    Pairwise-complete; NULL where a side has zero variance."""
    vars_ = vars_ or variables(df)
    if method == "spearman":
        df = average_ranks(df)
    elif method != "pearson":
        raise ValueError("method must be 'pearson' or 'spearman' (kendall: see kendall())")
    w = wide(df, vars_).drop("ts")
    # one aggregation: the pivoted rows are read once
    stats = _pair_stats(w, vars_, _pearson, *[F.var_pop(v).alias(f"_v_{i}") for i, v in enumerate(vars_)])
    arr = []
    for i, a in enumerate(vars_):
        for j in range(i + 1, len(vars_)):
            b, c = vars_[j], F.col(f"_p{i}_{j}")
            arr += [F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), c.alias("corr")),
                    F.struct(F.lit(b).alias("var1"), F.lit(a).alias("var2"), c.alias("corr"))]
    for i, v in enumerate(vars_):
        arr.append(F.struct(F.lit(v).alias("var1"), F.lit(v).alias("var2"),
                            F.when(F.col(f"_v_{i}") > 0, F.lit(1.0)).alias("corr")))
    return stats.select("series_id", F.explode(F.array(*arr)).alias("_c")).select("series_id", "_c.var1", "_c.var2", "_c.corr")


def average_ranks(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Replace ``value`` by its average rank (1-based, ties averaged) within
    ``(series_id, var)`` (:func:`quantile.value_ranks`: no task orders a whole series)."""
    ranks = value_ranks(df, partitions=partitions)
    return df.join(ranks, on=[*KEYS, "value"], how="left").withColumn("value", F.col("rank")).select(*df.columns)


def strong_pairs(corr: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Upper-triangle pairs (var1 < var2 in column order) with |r| > threshold,
    numbered in pair order (``pair_no`` from 1)."""
    up = corr.filter((F.col("var1") < F.col("var2")) & (F.abs(F.col("corr")) > F.lit(threshold)))
    w = Window.partitionBy("series_id").orderBy("var1", "var2")
    return up.withColumn("pair_no", F.row_number().over(w).cast("bigint"))


def require(df: DataFrame, *names: str) -> None:
    """Raises if one of the variables doesn't occur."""
    missing = sorted(set(names) - set(variables(df.filter(F.col("var").isin(*names)))))
    if missing:
        raise ValueError(f"unknown variable(s): {missing}")


def ccf(df: DataFrame, var1: str, var2: str, nlags: int = 20, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Cross-correlation corr(x_{t+k}, y_t) for k = 0..nlags, adjusted
    covariance (divisor n-k) over population standard deviations; plus the
    ±1.96/√n band (J6) and a significance flag."""
    require(df, var1, var2)
    w = wide(df.filter(F.col("var").isin(var1, var2)), [var1, var2] if var1 != var2 else [var1])
    y_col = var2 if var1 != var2 else var1
    st = w.groupBy("series_id").agg(
        F.avg(var1).alias("_mx"), F.avg(y_col).alias("_my"), F.stddev_pop(var1).alias("_sx"),
        F.stddev_pop(y_col).alias("_sy"), F.count(F.lit(1)).alias("n"))
    c = w.join(st, on="series_id").select(
        "series_id", F.lit(f"{var1}|{y_col}").alias("var"), "pos",
        (F.col(var1) - F.col("_mx")).alias("_xo"), (F.col(y_col) - F.col("_my")).alias("_yo"))
    ls = lags.lag_sums(c, nlags, x="_xo", y="_yo", chunk_rows=chunk_rows)
    out = ls.join(st, on="series_id").select(
        "series_id", F.lit(var1).alias("var1"), F.lit(y_col).alias("var2"), "lag", "n",
        sdiv(F.col("s") / (F.col("n") - F.col("lag")), F.col("_sx") * F.col("_sy")).alias("ccf"),
        (F.lit(Z975) / F.sqrt(F.col("n"))).alias("band"))
    return out.withColumn("significant", F.coalesce(F.abs(F.col("ccf")) > F.col("band"), F.lit(False)))


def ccf_significant(cc: DataFrame) -> DataFrame:
    """List of significant lags per pair."""
    return cc.groupBy("series_id", "var1", "var2").agg(
        F.array_sort(F.collect_list(F.when(F.col("significant"), F.col("lag")))).alias("significant_lags"),
        F.sum(F.col("significant").cast("bigint")).alias("n_significant"))


# ------------------------------------------------------------------ PCA


def _sign_fix(vecs: np.ndarray) -> np.ndarray:
    # make the largest-|.| loading of every component positive (first on ties)
    idx = np.argmax(np.abs(vecs), axis=0)
    s = np.sign(vecs[idx, np.arange(vecs.shape[1])])
    s[s == 0] = 1.0
    return vecs * s


def pca(df: DataFrame, vars_: list[str] | None = None, scale: bool = True) -> tuple[DataFrame, DataFrame]:
    """PCA of the standardised (``scale``) or centred variables.

    Returns ``(components, loadings)``: ``components`` = ``series_id, pc,
    eigenvalue, explained_variance_ratio, cumulative``; ``loadings`` =
    ``series_id, var, pc, loading`` (unit eigenvectors, largest-|.| entry
    positive).  Rows with any NULL variable are excluded (complete cases)."""
    vars_ = vars_ or variables(df)
    w = wide(df, vars_).drop("ts").dropna(subset=vars_)
    aggs = []
    for i, a in enumerate(vars_):
        for b in vars_[i:]:
            c = F.covar_pop(a, b) if a != b else F.var_pop(a)
            aggs.append(c.alias(f"c{i}_{vars_.index(b)}"))
    cov = w.groupBy("series_id").agg(*aggs)
    k = len(vars_)
    arr = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), F.col(f"c{i}_{j}").alias("c"))
                    for i in range(k) for j in range(i, k)])
    cov_long = cov.select("series_id", F.explode(arr).alias("_e")).select("series_id", "_e.i", "_e.j", "_e.c")

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        m = np.zeros((k, k))
        for i, j, c in zip(pdf["i"], pdf["j"], pdf["c"]):
            m[i, j] = m[j, i] = c
        if scale:
            d = np.sqrt(np.diag(m))
            with np.errstate(divide="ignore", invalid="ignore"):
                m = m / np.outer(d, d)
            m[~np.isfinite(m)] = 0.0
        vals, vecs = np.linalg.eigh(m)
        order = np.argsort(-vals, kind="stable")
        vals, vecs = vals[order], _sign_fix(vecs[:, order])
        tot = vals.sum()
        ratio = vals / tot if tot > 0 else np.full(k, np.nan)
        rows = []
        for p in range(k):
            for v in range(k):
                rows.append((pdf["series_id"].iloc[0], p + 1, vals[p], ratio[p], float(np.cumsum(ratio)[p]), vars_[v],
                             vecs[v, p]))
        return pd.DataFrame(rows, columns=["series_id", "pc", "eigenvalue", "explained_variance_ratio", "cumulative",
                                           "var", "loading"])

    res = cov_long.groupBy("series_id").applyInPandas(
        solve, "series_id string, pc long, eigenvalue double, explained_variance_ratio double, cumulative double, "
               "var string, loading double")
    comps = res.select("series_id", "pc", "eigenvalue", "explained_variance_ratio", "cumulative").distinct()
    loads = res.select("series_id", "var", "pc", "loading")
    return comps, loads


def component_map(df: DataFrame, loadings: DataFrame, n_components: int | None = None, scale: bool = True) -> DataFrame:
    """The scores as a linear map (:func:`linear_map`): weight = loading / population std and
    offset = -mean · weight over the rows where all variables are present."""
    vars_ = variables(df)
    w = wide(df, vars_).dropna(subset=vars_)
    stats = w.groupBy("series_id").agg(F.array(*[
        F.struct(F.lit(v).alias("var"), F.avg(v).alias("_m"), F.stddev_pop(v).alias("_sd")) for v in vars_]).alias("_s"))
    each = cut(stats).select("series_id", F.inline("_s"))
    ld = loadings if n_components is None else loadings.filter(F.col("pc") <= n_components)
    weight = sdiv(F.col("loading"), F.col("_sd")) if scale else F.col("loading")
    return ld.join(each, on=["series_id", "var"]).withColumn("weight", weight).select(
        "series_id", F.concat(F.lit("PC"), F.col("pc").cast("string")).alias("out_var"), "var", "weight",
        (-F.col("_m") * F.col("weight")).alias("offset"), F.lit(True).alias("whole"))


def linear_map(df: DataFrame, weights: DataFrame) -> DataFrame:
    """New variables as weighted sums: ``weights`` (series_id, out_var, var, weight, offset,
    whole) has a row for each term of each output.  A value is NULL where a term
    is; rows of ``whole`` outputs exist only where all their terms do.  The map of a
    series is one small row; each time point is read once and gives one row an output."""
    vars_ = variables(df)
    known = weights.filter(F.col("var").isin(vars_))
    terms = [F.max(F.when(F.col("var") == v, F.col("weight"))) for v in vars_]
    outs = known.groupBy("series_id", "out_var").agg(
        F.array(*terms).alias("w"), F.sum("offset").alias("offset"), F.max("whole").alias("whole"))
    maps = outs.groupBy("series_id").agg(F.collect_list(F.struct("out_var", "w", "offset", "whole")).alias("_map"))
    rows = wide(df, vars_).join(maps, on="series_id")
    x = F.array(*vars_)
    rows = rows.select("series_id", "pos", "ts", x.alias("_x"), F.explode("_map").alias("_o"))
    used = F.filter(F.arrays_zip("_x", F.col("_o.w").alias("w")), lambda e: e["w"].isNotNull())
    value = F.aggregate(used, F.col("_o.offset"), lambda acc, e: acc + e["_x"] * e["w"])  # a NULL term makes it NULL
    out = rows.select("series_id", F.col("_o.out_var").alias("var"), "ts", "pos", value.alias("value"), F.col("_o.whole").alias("_w"))
    return out.filter(~F.col("_w") | F.col("value").isNotNull()).drop("_w")


def pca_scores(df: DataFrame, loadings: DataFrame, n_components: int | None = None, scale: bool = True,
               whiten: bool = False, components: DataFrame | None = None) -> DataFrame:
    """PCA scores as a long frame (``var = 'PC<i>'``): Σ_v z_v(t)·loading(v, pc).
    ``z`` uses the population std (``scale``) on complete rows."""
    weights = component_map(df, loadings, n_components, scale)
    if whiten and components is not None:
        sd = components.select("series_id", F.concat(F.lit("PC"), F.col("pc").cast("string")).alias("out_var"),
                               F.sqrt("eigenvalue").alias("_sd"))
        weights = weights.join(sd, on=["series_id", "out_var"]).withColumn(
            "weight", sdiv(F.col("weight"), F.col("_sd"))).withColumn("offset", sdiv(F.col("offset"), F.col("_sd"))).drop("_sd")
    return linear_map(df, weights)


def n_components_for(components: DataFrame, target: float = 0.8) -> DataFrame:
    """Smallest number of components reaching ``target`` cumulative ratio
    (k when never reached)."""
    return components.groupBy("series_id").agg(
        F.coalesce(F.min(F.when(F.col("cumulative") >= F.lit(target) - F.lit(1e-12), F.col("pc"))),
                   F.max("pc")).alias("n_components"))


def top_features(loadings: DataFrame, top: int = 3) -> DataFrame:
    """The ``top`` variables with the largest |loading| per component."""
    w = Window.partitionBy("series_id", "pc").orderBy(F.abs(F.col("loading")).desc(), F.col("var"))
    return (loadings.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= top)
            .withColumn("abs_loading", F.abs("loading")).select("series_id", "pc", "rank", "var", "abs_loading"))
