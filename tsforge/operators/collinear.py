"""Collinearity handling.

Decisions are driven by the small per-series tables (correlation matrix,
strong pairs, variances); the greedy walks of ``drop`` / ``select`` run in a
grouped pandas function over each series' pair table (≤ k² rows).  Every
handler is a linear map of a series' variables: the small table of its weights
is applied to the points in one pass (:func:`relations.linear_map`).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.functions.expr import sdiv
from tsforge.operators import relations
from tsforge.plans.materialize import cut
from tsforge.spec import KEYS


def importance(df: DataFrame) -> DataFrame:
    """Default importance: sample variance per variable."""
    return df.groupBy(*KEYS).agg(F.var_samp("value").alias("importance"))


def strength(corr: DataFrame) -> DataFrame:
    """Total correlation strength per variable: Σ|r| - 1 (self correlation)."""
    return corr.groupBy("series_id", F.col("var1").alias("var")).agg(
        (F.sum(F.abs("corr")) - 1).alias("strength"))


def _kept(names: DataFrame) -> DataFrame:
    """The map that leaves the variables ``names`` (series_id, var) as they are."""
    return names.select("series_id", F.col("var").alias("out_var"), "var", F.lit(1.0).alias("weight"),
                        F.lit(0.0).alias("offset"), F.lit(False).alias("whole"))


def combine_map(names: DataFrame, pairs: DataFrame, how: str = "average", imp: DataFrame | None = None) -> DataFrame:
    """J19/J20 as a linear map: for strong pair i ``combined_i`` = (a+b)/2 (``average``) or the
    inverse-variance mix ``v_b/(v_a+v_b)·a + v_a/(v_a+v_b)·b`` (``weighted``, ``imp`` = variances);
    the first member of every pair is dropped, the second kept."""
    if how == "average":
        p = pairs.select("series_id", "pair_no", "var1", "var2", F.lit(0.5).alias("w1"), F.lit(0.5).alias("w2"))
    elif how == "weighted":
        one, two = (imp.select("series_id", F.col("var").alias(f"var{i}"), F.col("importance").alias(f"_v{i}")) for i in (1, 2))
        total = F.col("_v1") + F.col("_v2")
        p = pairs.join(one, on=["series_id", "var1"]).join(two, on=["series_id", "var2"]).select(
            "series_id", "pair_no", "var1", "var2", sdiv(F.col("_v2"), total).alias("w1"), sdiv(F.col("_v1"), total).alias("w2"))
    else:
        raise ValueError("how must be 'average' or 'weighted'")
    terms = F.explode(F.array(F.struct(F.col("var1").alias("var"), F.col("w1").alias("weight")),
                              F.struct(F.col("var2").alias("var"), F.col("w2").alias("weight"))))
    mixed = p.select("series_id", F.concat(F.lit("combined_"), F.col("pair_no").cast("string")).alias("out_var"),
                     terms.alias("t")).select("series_id", "out_var", "t.*", F.lit(0.0).alias("offset"), F.lit(False).alias("whole"))
    first = pairs.select("series_id", F.col("var1").alias("var"))
    return _kept(names.join(first, on=["series_id", "var"], how="left_anti")).unionByName(mixed)


def combine(df: DataFrame, pairs: DataFrame, how: str = "average") -> DataFrame:
    """``df`` with the strong pairs combined (:func:`combine_map`)."""
    imp = cut(importance(df))
    return relations.linear_map(df, combine_map(imp.select("series_id", "var"), pairs, how, imp))


def _greedy(pairs: DataFrame, score: DataFrame, rule: str) -> DataFrame:
    """Per-series greedy walk over strong pairs in pair order → variables to remove."""
    s1 = score.select("series_id", F.col("var").alias("var1"), F.col("score").alias("s1"))
    s2 = score.select("series_id", F.col("var").alias("var2"), F.col("score").alias("s2"))
    t = pairs.join(s1, on=["series_id", "var1"], how="left").join(s2, on=["series_id", "var2"], how="left")

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pair_no")
        out: list[str] = []
        gone: set[str] = set()
        for a, b, sa, sb in zip(pdf["var1"], pdf["var2"], pdf["s1"].fillna(0.0), pdf["s2"].fillna(0.0)):
            if a in gone or b in gone:
                continue
            if rule == "drop":  # drop the member with larger total strength (tie → second)
                victim = a if sa > sb else b
            else:  # select: keep the more important (tie → keep second)
                victim = b if sa > sb else a
            gone.add(victim)
            out.append(victim)
        return pd.DataFrame({"series_id": pdf["series_id"].iloc[0] if len(pdf) else None, "var": out})

    return t.select("series_id", "pair_no", "var1", "var2", "s1", "s2").groupBy("series_id").applyInPandas(
        walk, "series_id string, var string")


def drop(df: DataFrame, corr: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Returns (kept points, removed variables)."""
    removed = _greedy(pairs, strength(corr).withColumnRenamed("strength", "score"), "drop")
    return df.join(removed, on=["series_id", "var"], how="left_anti"), removed


def select(df: DataFrame, pairs: DataFrame, imp: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Keep the more important member of each pair (importance = sample
    variance unless given as ``series_id, var, importance``)."""
    imp = importance(df) if imp is None else imp
    removed = _greedy(pairs, imp.withColumnRenamed("importance", "score"), "select")
    return df.join(removed, on=["series_id", "var"], how="left_anti"), removed


def auto_choice(df: DataFrame, pairs: DataFrame, imp: DataFrame | None = None) -> DataFrame:
    """Mean |r| of strong pairs > 0.85 → pca; population std of |r| > 0.2 →
    pca; CV of importance (population std / mean) > 0.5 → select; else
    combine.  Series without strong pairs → none."""
    imp = importance(df) if imp is None else imp
    ps = pairs.groupBy("series_id").agg(F.avg(F.abs("corr")).alias("mean_abs_r"),
                                        F.stddev_pop(F.abs("corr")).alias("std_abs_r"),
                                        F.count(F.lit(1)).alias("n_pairs"))
    cv = imp.groupBy("series_id").agg((F.stddev_pop("importance") / F.avg("importance")).alias("cv_importance"))
    j = df.select("series_id").distinct().join(ps, on="series_id", how="left").join(cv, on="series_id", how="left")
    m = (F.when(F.coalesce(F.col("n_pairs"), F.lit(0)) == 0, "none")
         .when(F.col("mean_abs_r") > 0.85, "pca").when(F.col("std_abs_r") > 0.2, "pca")
         .when(F.col("cv_importance") > 0.5, "select").otherwise("combine"))
    return j.select("series_id", F.coalesce("n_pairs", F.lit(0)).alias("n_pairs"), "mean_abs_r", "std_abs_r",
                    "cv_importance", m.alias("method"))


def reduce_pca(df: DataFrame, max_components: int = 3) -> DataFrame:
    """Replace the variables by the first ``min(max_components, k)`` PCs."""
    _, loads = relations.pca(df)
    return relations.pca_scores(df, loads, n_components=max_components)


METHODS = ("pca", "drop", "combine", "select")


def handling(df: DataFrame, method: str = "auto", threshold: float = 0.7, how: str = "average", n_components: int = 3,
             imp: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What is to be done with each series, as small tables: ``weights`` (the linear map
    :func:`relations.linear_map` applies), ``choice`` (series_id, method: its J22 decision or the
    given method; ``none`` without strong pairs) and ``record`` (series_id, method, details:
    removed names for drop, kept names for select, new names for combine and pca).
    ``imp`` (series_id, var, importance) replaces the sample variance in select and in the decision."""
    if method not in (*METHODS, "auto"):
        raise ValueError(f"method must be one of {', '.join(METHODS)}, auto: {method!r}")
    variance = cut(importance(df))
    names, imp = variance.select("series_id", "var"), variance if imp is None else imp
    corr = cut(relations.correlation(df))
    pairs = cut(relations.strong_pairs(corr, threshold))
    if method == "auto":
        choice = cut(auto_choice(df, pairs, imp))
    else:
        strong = pairs.select("series_id").distinct().withColumn("method", F.lit(method))
        choice = cut(names.select("series_id").distinct().join(strong, on="series_id", how="left").withColumn(
            "method", F.coalesce("method", F.lit("none"))))
    made = {"none": (_kept(names), None)}
    wanted = METHODS if method == "auto" else (method,)
    if "drop" in wanted and method != "auto":  # the automatic decision never drops
        gone = _greedy(pairs, strength(corr).withColumnRenamed("strength", "score"), "drop")
        made["drop"] = _kept(names.join(gone, on=["series_id", "var"], how="left_anti")), gone
    if "select" in wanted:
        gone = _greedy(pairs, imp.withColumnRenamed("importance", "score"), "select")
        left = names.join(gone, on=["series_id", "var"], how="left_anti")
        made["select"] = _kept(left), left
    if "combine" in wanted:
        made["combine"] = combine_map(names, pairs, how, variance), None
    by_pca = choice.filter(F.col("method") == "pca").select("series_id")
    if not by_pca.isEmpty():
        some = df.join(by_pca, on="series_id", how="left_semi")
        _, loads = relations.pca(some)
        made["pca"] = relations.component_map(some, loads, n_components), None
    weights, record = None, None
    for name, (table, listed) in made.items():
        mine = choice.filter(F.col("method") == name).select("series_id")
        w = table.join(mine, on="series_id", how="left_semi")
        new = w.filter(F.col("out_var") != F.col("var")).select("series_id", F.col("out_var").alias("var")).distinct()
        listed = (new if listed is None else listed).join(mine, on="series_id", how="right").groupBy("series_id").agg(
            F.array_join(F.array_sort(F.collect_set("var")), ",").alias("details")).withColumn("method", F.lit(name))
        weights = w if weights is None else weights.unionByName(w)
        record = listed if record is None else record.unionByName(listed)
    return cut(weights), choice, cut(record.select("series_id", "method", "details"))


def handle(df: DataFrame, method: str = "auto", threshold: float = 0.7, how: str = "average", n_components: int = 3,
           imp: DataFrame | None = None) -> DataFrame:
    """J16: 'pca' | 'drop' | 'combine' | 'select' | 'auto' (each series by its own J22 decision).  A
    series without strong pairs is returned unchanged."""
    return relations.linear_map(df, handling(df, method, threshold, how, n_components, imp)[0])


def handle_auto(df: DataFrame, threshold: float = 0.7, max_components: int = 3,
                imp: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """J16 with ``method='auto'``; returns (data, decisions)."""
    weights, choice, _ = handling(df, "auto", threshold, n_components=max_components, imp=imp)
    return relations.linear_map(df, weights), choice


def effect(before: DataFrame, after: DataFrame) -> DataFrame:
    """Mean |r| over the k² cells with the diagonal zeroed, before vs after,
    and the reduction in percent."""
    def mean_abs(c: DataFrame, name: str) -> DataFrame:
        return c.groupBy("series_id").agg(
            (F.sum(F.when(F.col("var1") != F.col("var2"), F.abs("corr")).otherwise(0.0)) / F.count(F.lit(1))).alias(name))
    j = mean_abs(before, "mean_abs_before").join(mean_abs(after, "mean_abs_after"), on="series_id")
    return j.withColumn("reduction_pct", F.try_divide(F.col("mean_abs_before") - F.col("mean_abs_after"),
                                                      F.col("mean_abs_before")) * 100.0)


def effect_pairs(before: DataFrame, after: DataFrame) -> DataFrame:
    """The correlation of every pair of variables before and after the
    handling (NULL where a variable exists on one side only)."""
    def pairs(c: DataFrame, name: str) -> DataFrame:
        return c.filter(F.col("var1") < F.col("var2")).select("series_id", "var1", "var2", F.col("corr").alias(name))
    return pairs(before, "corr_before").join(pairs(after, "corr_after"), on=["series_id", "var1", "var2"], how="full")
