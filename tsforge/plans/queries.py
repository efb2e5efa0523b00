"""Named queries over the driver tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads the given tables (or series Spark derives from them) in
full.  Output doubles are rounded half-up to 6 decimals (``r6``) exactly as the
oracle SQL does, so both engines hash identical values.
"""

from __future__ import annotations

from functools import reduce

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.functions.expr import r6
from tsforge.operators import (align, calendar, collinear, detect, fill, normalize, relations, report, smooth,
                               spectral, stationarity, transform, unitroot)
from tsforge.plans import cleaning
from tsforge.plans.materialize import cut
from tsforge.sources import tables as tb

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def finish(df: DataFrame) -> DataFrame:
    """Round doubles (r6, skipped beyond 1e12) and widen ints to BIGINT."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.abs(c) < F.lit(1e12), r6(c)).otherwise(c.cast("double")).alias(f.name)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint").alias(f.name)
        cols.append(c)
    return df.select(*cols)


# ------------------------------------------------------------------ series


def ord_grid(spark, sf):
    return cut(calendar.regularize(tb.ord_daily(spark, sf), "D"))


def ev_grid(spark, sf):
    return cut(calendar.regularize(tb.ev_hourly(spark, sf), "H"))


def ship_grid(spark, sf):
    return cut(calendar.regularize(tb.ship_daily(spark, sf), "D"))


# ------------------------------------------------------------------ §3.1 flagship


@query("clean_compare")
def q_clean_compare(spark, sf):
    """ord_daily → daily grid → linear fill → rolling z (w=10, t=2.5) → NULL → linear → L1."""
    raw = tb.ord_daily(spark, sf)
    return finish(cleaning.clean_compare(raw, freq="D", fill_method=1, outlier_method=2, detect_method=2,
                                         threshold=2.5, window=10))


@query("clean_change_counts")
def q_clean_change_counts(spark, sf):
    raw = tb.ord_daily(spark, sf)
    return finish(report.change_counts(cleaning.clean_compare(raw, freq="D", threshold=2.5, window=10)))


# ------------------------------------------------------------------ B: calendar


@query("asfreq_daily")
def q_asfreq_daily(spark, sf):
    return finish(ord_grid(spark, sf))


@query("asfreq_hourly")
def q_asfreq_hourly(spark, sf):
    return finish(ev_grid(spark, sf))


# ------------------------------------------------------------------ C: detection


@query("missing_mask")
def q_missing_mask(spark, sf):
    return finish(detect.missing(ev_grid(spark, sf), 0))


@query("missing_or_zero_mask")
def q_missing_or_zero_mask(spark, sf):
    g = ev_grid(spark, sf)
    # deterministic zeros: hour-of-day 0 of every series reads as 0
    g = g.withColumn("value", F.when(F.hour("ts") == 0, F.lit(0.0)).otherwise(F.col("value")))
    return finish(detect.missing(g, 1))


@query("outlier_zscore")
def q_outlier_zscore(spark, sf):
    return finish(detect.zscore(tb.user_events(spark, sf), 3.0))


@query("outlier_iqr")
def q_outlier_iqr(spark, sf):
    return finish(detect.iqr(tb.user_events(spark, sf)))


@query("outlier_rolling_zscore")
def q_outlier_rolling_zscore(spark, sf):
    return finish(detect.rolling_zscore(tb.ev_raw(spark, sf), threshold=3.0, window=20))


# ------------------------------------------------------------------ D: handling and fills


@query("outlier_to_null")
def q_outlier_to_null(spark, sf):
    return finish(fill.handle_outliers(tb.user_events(spark, sf), method=0, detect_method=0, threshold=3.0))


@query("outlier_clip")
def q_outlier_clip(spark, sf):
    return finish(fill.handle_outliers(tb.user_events(spark, sf), method=1, detect_method=1))


@query("outlier_interpolate")
def q_outlier_interpolate(spark, sf):
    return finish(fill.handle_outliers(ord_grid(spark, sf), method=2, detect_method=0, threshold=3.0))


@query("fill_linear")
def q_fill_linear(spark, sf):
    return finish(fill.linear(ev_grid(spark, sf)))


@query("fill_rolling_mean")
def q_fill_rolling_mean(spark, sf):
    return finish(fill.rolling_mean(ev_grid(spark, sf), window=5))


@query("fill_rolling_mean_auto")
def q_fill_rolling_mean_auto(spark, sf):
    return finish(fill.rolling_mean(ev_grid(spark, sf), window=None))


@query("auto_window")
def q_auto_window(spark, sf):
    return finish(fill.auto_window(ev_grid(spark, sf)))


# ------------------------------------------------------------------ G: normalisation


@query("ds_minmax")
def q_ds_minmax(spark, sf):
    return finish(normalize.minmax_matrix(tb.emb(spark, sf)))


@query("ds_minmax_per_var")
def q_ds_minmax_per_var(spark, sf):
    return finish(normalize.minmax(ship_grid(spark, sf)))


@query("ds_zscore")
def q_ds_zscore(spark, sf):
    return finish(normalize.zscore_matrix(tb.emb(spark, sf)))


@query("standardize")
def q_standardize(spark, sf):
    return finish(normalize.standardize(ship_grid(spark, sf)))


# ------------------------------------------------------------------ E: resampling

_RULE_NAMES = {"D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}
_DS_METHODS = {"mean": 0, "sum": 1, "max": 2, "min": 3}


def _ds_input(spark, sf, rule):
    # daily buckets from the raw (irregular) event stream; coarser ones from daily orders
    if rule == "D":
        return tb.ev_raw(spark, sf)
    return tb.ord_daily(spark, sf)


def _make_downsample(rule, method):
    def q(spark, sf):
        return finish(calendar.downsample(_ds_input(spark, sf, rule), rule, _DS_METHODS[method]))

    return q


for _r, _rn in _RULE_NAMES.items():
    for _m in _DS_METHODS:
        QUERIES[f"downsample_{_m}_{_rn}"] = _make_downsample(_r, _m)


@query("upsample_ffill_hour")
def q_upsample_ffill_hour(spark, sf):
    return finish(calendar.upsample(tb.ord_daily(spark, sf), "H", 0))


@query("upsample_linear_hour")
def q_upsample_linear_hour(spark, sf):
    return finish(calendar.upsample(tb.ord_daily(spark, sf), "H", 1))


@query("upsample_ffill_minute")
def q_upsample_ffill_minute(spark, sf):
    return finish(calendar.upsample(tb.ev_hourly(spark, sf), "T", 0))


@query("upsample_linear_minute")
def q_upsample_linear_minute(spark, sf):
    return finish(calendar.upsample(tb.ev_hourly(spark, sf), "T", 1))


# ------------------------------------------------------------------ F: smoothing


@query("smooth_ma_odd")
def q_smooth_ma_odd(spark, sf):
    return finish(smooth.moving_average(ev_grid(spark, sf), 3))


@query("smooth_ma_even")
def q_smooth_ma_even(spark, sf):
    return finish(smooth.moving_average(ev_grid(spark, sf), 4))


@query("smooth_ewm")
def q_smooth_ewm(spark, sf):
    return finish(smooth.ewm(ev_grid(spark, sf), 0.2))


@query("smooth_loess")
def q_smooth_loess(spark, sf):
    return finish(smooth.loess(fill.linear(ev_grid(spark, sf)), frac=0.1))


# ------------------------------------------------------------------ I: transforms


@query("diff_1")
def q_diff_1(spark, sf):
    return finish(transform.diff(ship_grid(spark, sf), 1))


@query("diff_2")
def q_diff_2(spark, sf):
    return finish(transform.diff(ship_grid(spark, sf), 2))


@query("diff_seasonal")
def q_diff_seasonal(spark, sf):
    return finish(transform.seasonal_diff(ship_grid(spark, sf), 12))


@query("log_transform")
def q_log_transform(spark, sf):
    # differenced input has values <= 0, exercising the shift rule
    return finish(transform.log(transform.diff(ship_grid(spark, sf), 1)))


@query("sqrt_transform")
def q_sqrt_transform(spark, sf):
    return finish(transform.sqrt(transform.diff(ship_grid(spark, sf), 1)))


@query("boxcox")
def q_boxcox(spark, sf):
    return finish(transform.boxcox(ship_grid(spark, sf), refine=0))


@query("boxcox_lambda")
def q_boxcox_lambda(spark, sf):
    return finish(transform.boxcox_lambda(ship_grid(spark, sf), refine=0).select(*["series_id", "var", "lmbda"]))


_CHAIN = ["log", ("diff", {"order": 1})]


@query("transform_chain")
def q_transform_chain(spark, sf):
    return finish(transform.chain(ship_grid(spark, sf), _CHAIN))


@query("transform_ledger")
def q_transform_ledger(spark, sf):
    return finish(transform.ledger(ship_grid(spark, sf), _CHAIN))


# ------------------------------------------------------------------ H: diagnostics


def ev_filled(spark, sf):
    return cut(fill.linear(ev_grid(spark, sf)))


@query("trend_direction")
def q_trend_direction(spark, sf):
    g = ship_grid(spark, sf)
    # a cumulative count is monotone: exercises the 'increasing' branch too
    cum = calendar.regularize(tb.ord_daily(spark, sf), "D").filter(F.col("var") == "n_orders")
    from tsforge.operators import scan

    cum = scan.running_sum(cum, "value", "value2").select("series_id", F.lit("cum_orders").alias("var"), "ts", "pos",
                                                          F.col("value2").alias("value"))
    return finish(stationarity.trend_direction(g.unionByName(cum)))


@query("autocorr_lag12")
def q_autocorr_lag12(spark, sf):
    return finish(stationarity.autocorr(ev_filled(spark, sf), 12))


@query("seasonality_flag")
def q_seasonality_flag(spark, sf):
    return finish(stationarity.seasonality(ev_filled(spark, sf), 12))


@query("acf")
def q_acf(spark, sf):
    return finish(stationarity.acf(ev_filled(spark, sf), 40))


@query("acf_significant_lags")
def q_acf_significant_lags(spark, sf):
    return finish(stationarity.acf_significant(ev_filled(spark, sf), 40))


@query("pacf_lag12")
def q_pacf_lag12(spark, sf):
    return finish(stationarity.pacf(ev_filled(spark, sf), 2))


@query("pacf")
def q_pacf(spark, sf):
    return finish(stationarity.pacf(ev_filled(spark, sf), 40))


@query("pacf_significant_lags")
def q_pacf_significant_lags(spark, sf):
    return finish(stationarity.pacf_significant(ev_filled(spark, sf), 40))


@query("kpss")
def q_kpss(spark, sf):
    return finish(stationarity.kpss(ship_grid(spark, sf), "c").drop("critical_values"))


@query("kpss_ct")
def q_kpss_ct(spark, sf):
    return finish(stationarity.kpss(ev_filled(spark, sf), "ct").drop("critical_values"))


# ------------------------------------------------------------------ J: relationships


def complete_cases(df):
    """Positions where every variable of the series is present."""
    vars_ = relations.variables(df)
    ok = relations.wide(df, vars_).dropna(subset=vars_).select("series_id", "pos")
    return df.join(ok, on=["series_id", "pos"], how="left_semi")


def daily_wide(spark, sf):
    """orders (revenue, n_orders) and line items (4 averages) as one 6-variable
    daily series, linearly filled, complete cases."""
    raw = tb.ord_daily(spark, sf).unionByName(tb.ship_daily(spark, sf)).withColumn("series_id", F.lit("daily"))
    return cut(complete_cases(cut(fill.linear(calendar.regularize(raw, "D")))))


def ord_wide(spark, sf):
    return cut(fill.linear(ord_grid(spark, sf)))


@query("corr_pearson")
def q_corr_pearson(spark, sf):
    return finish(relations.correlation(daily_wide(spark, sf)))


@query("corr_spearman")
def q_corr_spearman(spark, sf):
    return finish(relations.correlation(daily_wide(spark, sf), "spearman"))


@query("strong_pairs")
def q_strong_pairs(spark, sf):
    return finish(relations.strong_pairs(relations.correlation(daily_wide(spark, sf)), 0.7))


@query("ccf")
def q_ccf(spark, sf):
    return finish(relations.ccf(ord_wide(spark, sf), "revenue", "n_orders", 20))


@query("ccf_significant")
def q_ccf_significant(spark, sf):
    return finish(relations.ccf_significant(relations.ccf(ord_wide(spark, sf), "revenue", "n_orders", 20)))


@query("pca_variance_2")
def q_pca_variance_2(spark, sf):
    comps, _ = relations.pca(ord_wide(spark, sf))
    return finish(comps)


@query("pca_variance")
def q_pca_variance(spark, sf):
    comps, _ = relations.pca(daily_wide(spark, sf))
    return finish(comps)


@query("pca_loadings")
def q_pca_loadings(spark, sf):
    _, loads = relations.pca(daily_wide(spark, sf))
    return finish(loads)


@query("pca_scores")
def q_pca_scores(spark, sf):
    d = daily_wide(spark, sf)
    _, loads = relations.pca(d)
    return finish(relations.pca_scores(d, loads))


@query("pca_n80")
def q_pca_n80(spark, sf):
    comps, _ = relations.pca(daily_wide(spark, sf))
    return finish(relations.n_components_for(comps, 0.8))


@query("pca_top_features")
def q_pca_top_features(spark, sf):
    _, loads = relations.pca(daily_wide(spark, sf))
    return finish(relations.top_features(loads, 3))


def _pairs(spark, sf):
    d = daily_wide(spark, sf)
    corr = cut(relations.correlation(d))
    return d, corr, cut(relations.strong_pairs(corr, 0.7))


@query("collinear_strength")
def q_collinear_strength(spark, sf):
    _, corr, _ = _pairs(spark, sf)
    return finish(collinear.strength(corr))


@query("collinear_combine_avg")
def q_collinear_combine_avg(spark, sf):
    d, _, p = _pairs(spark, sf)
    return finish(collinear.combine(d, p, "average"))


@query("collinear_combine_weighted")
def q_collinear_combine_weighted(spark, sf):
    d, _, p = _pairs(spark, sf)
    return finish(collinear.combine(d, p, "weighted"))


@query("collinear_drop")
def q_collinear_drop(spark, sf):
    d, corr, p = _pairs(spark, sf)
    return finish(collinear.drop(d, corr, p)[1])


@query("collinear_select")
def q_collinear_select(spark, sf):
    d, _, p = _pairs(spark, sf)
    return finish(collinear.select(d, p)[1])


@query("collinear_auto_choice")
def q_collinear_auto_choice(spark, sf):
    d, _, p = _pairs(spark, sf)
    return finish(collinear.auto_choice(d, p))


@query("collinear_pca")
def q_collinear_pca(spark, sf):
    return finish(collinear.reduce_pca(daily_wide(spark, sf), 3))


@query("collinear_effect")
def q_collinear_effect(spark, sf):
    d, corr, p = _pairs(spark, sf)
    after = relations.correlation(collinear.combine(d, p, "average"))
    return finish(collinear.effect(corr, after))


@query("collinear_effect_pairs")
def q_collinear_effect_pairs(spark, sf):
    d, corr, p = _pairs(spark, sf)
    after = relations.correlation(collinear.combine(d, p, "average"))
    return finish(collinear.effect_pairs(corr, after))


# ------------------------------------------------------------------ H/J: tests on the moments pass


@query("adf")
def q_adf(spark, sf):
    return finish(unitroot.adf(ship_grid(spark, sf)))


@query("adf_bic")
def q_adf_bic(spark, sf):
    return finish(unitroot.adf(ship_grid(spark, sf), autolag="BIC"))


@query("adf_lag0")
def q_adf_lag0(spark, sf):
    r = unitroot.adf(ship_grid(spark, sf), autolag=None, maxlag=0)
    return finish(r.select("series_id", "var", "statistic", "used_lag", "nobs"))


@query("phillips_perron")
def q_phillips_perron(spark, sf):
    return finish(unitroot.phillips_perron(ship_grid(spark, sf)).select("series_id", "var", "n", "lags", "statistic"))


@query("phillips_perron_p")
def q_phillips_perron_p(spark, sf):
    return finish(unitroot.phillips_perron(ship_grid(spark, sf)))


def _verdicts(g):
    return cut(unitroot.stationarity_verdict(unitroot.adf(g), stationarity.kpss(g)))


@query("stationarity_verdict")
def q_stationarity_verdict(spark, sf):
    return finish(_verdicts(ship_grid(spark, sf)))


@query("stationarity_report")
def q_stationarity_report(spark, sf):
    """ADF, PP and KPSS p-values with the summary wording per variable."""
    g = ship_grid(spark, sf)
    v = _verdicts(g).join(unitroot.phillips_perron(g).select("series_id", "var", F.col("p_value").alias("pp_p")),
                          on=["series_id", "var"])
    a, k, p = F.col("adf_p") <= 0.05, F.col("kpss_p") > 0.05, F.col("pp_p") <= 0.05
    summary = (F.when(a & p & k, "stationary").when(~a & ~p & ~k, "non_stationary")
               .when(~k, "non_stationary_difference_and_retest").otherwise("mixed"))
    return finish(v.withColumn("summary", summary))


@query("granger")
def q_granger(spark, sf):
    return finish(unitroot.granger(ord_wide(spark, sf), "revenue", "n_orders", 4))


@query("cointegration_eg")
def q_cointegration_eg(spark, sf):
    return finish(unitroot.engle_granger(ord_wide(spark, sf), "revenue", "n_orders"))


@query("auto_transform")
def q_auto_transform(spark, sf):
    g = ship_grid(spark, sf)
    data, _ = transform.auto(g, _verdicts(g), stationarity.seasonality(g, 12))
    return finish(data)


@query("auto_transform_ledger")
def q_auto_transform_ledger(spark, sf):
    g = ship_grid(spark, sf)
    _, led = transform.auto(g, _verdicts(g), stationarity.seasonality(g, 12))
    return finish(led)


@query("transform_report")
def q_transform_report(spark, sf):
    """Verdict before (original) and after (transformed), success when the
    transformed variable is strictly stationary."""
    g = ship_grid(spark, sf)
    before = _verdicts(g)
    data, led = transform.auto(g, before, stationarity.seasonality(g, 12))
    after = _verdicts(fill.linear(data))
    j = (led.join(before.select("series_id", "var", F.col("conclusion").alias("before")), on=["series_id", "var"])
         .join(after.select("series_id", "var", F.col("conclusion").alias("after")), on=["series_id", "var"]))
    return finish(j.withColumn("success", F.col("after") == "strictly_stationary"))


# ------------------------------------------------------------------ K: spectral


def emb_long(spark, sf):
    e = tb.emb(spark, sf)
    return cut(e).select("series_id", F.lit("x").alias("var"), F.lit(None).cast("timestamp_ntz").alias("ts"),
                    F.col("step").alias("pos"), F.col("x").alias("value"))


@query("fft_spectrum")
def q_fft_spectrum(spark, sf):
    return finish(spectral.dft(emb_long(spark, sf)))


@query("fft_spectrum_long")
def q_fft_spectrum_long(spark, sf):
    """Whole-series spectrum of the hourly event series by the path of long series."""
    return finish(spectral.four_step(ev_filled(spark, sf)))


@query("fft_frequency")
def q_fft_frequency(spark, sf):
    return finish(spectral.frequencies(spectral.dft(emb_long(spark, sf), keep_n=True)).select("series_id", "var", "k", "n", "freq"))


@query("fft_amplitude")
def q_fft_amplitude(spark, sf):
    return finish(spectral.amplitude(spectral.dft(emb_long(spark, sf), keep_n=True)))


@query("ifft_roundtrip")
def q_ifft_roundtrip(spark, sf):
    return finish(spectral.roundtrip_error(emb_long(spark, sf)))


@query("ifft_values")
def q_ifft_values(spark, sf):
    """The inverse transform of the spectrum: the input values come back."""
    spec = cut(spectral.dft(emb_long(spark, sf))).withColumnRenamed("k", "pos")
    back = spectral.dft(spec, inverse=True, value="re", imag="im")
    return finish(back.select("series_id", "var", F.col("k").alias("pos"), F.col("re").alias("value")))


# ------------------------------------------------------------------ D6/D7/D9, C4, E8, J10, A6, L2, J23


def _dec(spark, sf, period):
    src = ev_filled(spark, sf) if period == 24 else ord_wide(spark, sf)
    return fill.decompose(src, period)


@query("decompose_trend")
def q_decompose_trend(spark, sf):
    # even period (2x24 filter) on exact-decimal daily sums
    return finish(fill.decompose(ord_grid(spark, sf), 24).select("series_id", "var", "ts", "pos", "value", "trend"))


@query("decompose_seasonal")
def q_decompose_seasonal(spark, sf):
    return finish(_dec(spark, sf, 24).select("series_id", "var", "ts", "pos", "seasonal"))


@query("decompose_resid")
def q_decompose_resid(spark, sf):
    return finish(_dec(spark, sf, 7).select("series_id", "var", "ts", "pos", "trend", "seasonal", "resid"))


@query("fill_seasonal")
def q_fill_seasonal(spark, sf):
    return finish(fill.seasonal(ev_grid(spark, sf), period=7))


@query("fill_spline")
def q_fill_spline(spark, sf):
    return finish(fill.spline(ev_grid(spark, sf), degree=3))


@query("upsample_quadratic")
def q_upsample_quadratic(spark, sf):
    """To 3 decimals: hourly points of parabolas through daily cents are multiples of 1/57600
    where no day is missing, many of them half-way between two roundings; with this offset (1/pi) none is."""
    hourly = calendar.upsample(tb.ord_daily(spark, sf), "H", 2)
    return finish(hourly.withColumn("value", F.floor(F.col("value") * 1e3 + 0.318309886) / 1e3))


@query("outlier_iforest")
def q_outlier_iforest(spark, sf):
    return finish(detect.outliers(tb.ev_raw(spark, sf), method=3, contamination=0.05))


@query("cointegration_johansen")
def q_cointegration_johansen(spark, sf):
    return finish(unitroot.johansen(daily_wide(spark, sf)))


@query("ds_series_matrix")
def q_ds_series_matrix(spark, sf):
    """One row per sample with its ordered step vector (length and checksum kept)."""
    e = tb.emb(spark, sf)
    m = e.groupBy("series_id", "label").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("step", "x"))), lambda s: s["x"]).alias("_m"))
    return finish(m.select("series_id", "label", F.size("_m").cast("bigint").alias("n_steps"),
                           F.aggregate("_m", F.lit(0.0), lambda a, x: a + x).alias("checksum"),
                           F.element_at("_m", 1).alias("first"), F.element_at("_m", -1).alias("last")))


@query("transform_compare")
def q_transform_compare(spark, sf):
    """L2: original vs transformed (log → diff chain) per point."""
    g = ship_grid(spark, sf)
    return finish(report.compare_join(g, transform.chain(g, _CHAIN), how="left"))


@query("relations_report")
def q_relations_report(spark, sf):
    """Tidy summary (section, series_id, key, value) of strong pairs, CCF
    significance, Granger, cointegration and PCA."""
    d = daily_wide(spark, sf)
    o = ord_wide(spark, sf)
    corr = relations.correlation(d)
    sp = relations.strong_pairs(corr, 0.7).select(
        F.lit("strong_pair").alias("section"), "series_id",
        F.concat_ws("~", "var1", "var2").alias("key"), F.col("corr").alias("value"))
    cc = relations.ccf_significant(relations.ccf(o, "revenue", "n_orders", 20)).select(
        F.lit("ccf_significant_lags").alias("section"), "series_id", F.lit("revenue~n_orders").alias("key"),
        F.col("n_significant").cast("double").alias("value"))
    gr = unitroot.granger(o, "revenue", "n_orders", 4).select(
        F.lit("granger_p").alias("section"), "series_id", F.concat(F.lit("lag"), F.col("lag").cast("string")).alias("key"),
        F.col("p_value").alias("value"))
    co = unitroot.engle_granger(o, "revenue", "n_orders").select(
        F.lit("cointegration_p").alias("section"), "series_id", F.lit("revenue~n_orders").alias("key"),
        F.col("p_value").alias("value"))
    comps, _ = relations.pca(d)
    pc = comps.select(F.lit("pca_explained").alias("section"), "series_id",
                      F.concat(F.lit("PC"), F.col("pc").cast("string")).alias("key"),
                      F.col("explained_variance_ratio").alias("value"))
    return finish(sp.unionByName(cc).unionByName(gr).unionByName(co).unionByName(pc))


@query("corr_kendall")
def q_corr_kendall(spark, sf):
    from tsforge.operators.kendall import kendall

    return finish(kendall(ord_wide(spark, sf), ["n_orders", "revenue"]))


# ------------------------------------------------------------------ A1-A3, B8


@query("src_series")
def q_src_series(spark, sf):
    """A wide table (timestamp + value columns) to the long layout."""
    from tsforge.sources.csv import to_long

    o = tb.table(spark, sf, "orders").select("o_orderdate", "o_totalprice", "o_custkey")
    return finish(to_long(o.withColumn("o_custkey", F.col("o_custkey").cast("double")), "o_orderdate",
                          ["o_totalprice", "o_custkey"], series_id="orders"))


@query("src_univariate")
def q_src_univariate(spark, sf):
    """A3: univariate source with an explicit variable name."""
    from tsforge.sources.csv import from_series

    li = tb.table(spark, sf, "lineitem").select("l_shipdate", "l_quantity")
    return finish(from_series(li, "l_shipdate", "l_quantity", name="qty", series_id="lineitem"))


def _align_sides(spark, sf):
    a = tb.ord_daily(spark, sf).filter(F.col("var") == "revenue").withColumn("series_id", F.lit("daily"))
    b = tb.ship_daily(spark, sf).filter(F.col("var") == "quantity").withColumn("series_id", F.lit("daily"))
    return a, b


@query("align_outer")
def q_align_outer(spark, sf):
    a, b = _align_sides(spark, sf)
    return finish(align.align(a, b, "full"))


@query("align_left")
def q_align_left(spark, sf):
    a, b = _align_sides(spark, sf)
    return finish(align.align(a, b, "left"))


@query("collinear_handle_auto")
def q_collinear_handle_auto(spark, sf):
    data, _ = collinear.handle_auto(daily_wide(spark, sf))
    return finish(data)


@query("processing_log")
def q_processing_log(spark, sf):
    """The processing record of every handler: names removed, kept or made, components and variance."""
    from tsforge.sources.sinks import processing_log

    d = daily_wide(spark, sf)
    comps, _ = relations.pca(d)
    comps, logs = cut(comps), []
    for method in (*collinear.METHODS, "auto"):
        record = collinear.handling(d, method)[2]
        logs.append(processing_log(record, comps).withColumn("asked", F.lit(method)))
    return finish(reduce(DataFrame.unionByName, logs))


@query("granger_lag1")
def q_granger_lag1(spark, sf):
    g = unitroot.granger(ord_wide(spark, sf), "revenue", "n_orders", 1)
    return finish(g.select("series_id", "dependent", "independent", "lag", "f_stat", "df_num", "df_denom"))


@query("cointegration_eg_lag0")
def q_cointegration_eg_lag0(spark, sf):
    r = unitroot.engle_granger(ord_wide(spark, sf), "revenue", "n_orders", autolag=None, maxlag=0)
    return finish(r.select("series_id", "var", "statistic", "used_lag", "nobs"))


# ------------------------------------------------------------------ default paths and options


@query("boxcox_ml_lambda")
def q_boxcox_ml_lambda(spark, sf):
    """I4 as it runs by default: the edge of the grid moves on, two refinements to 0.001."""
    return finish(transform.boxcox_lambda(ship_grid(spark, sf)).select("series_id", "var", "lmbda", "llf"))


@query("transform_columns")
def q_transform_columns(spark, sf):
    """A transformation of some variables, the others as they are."""
    return finish(transform.apply(ship_grid(spark, sf), "diff", columns=["price", "tax"]))


@query("smooth_loess_fallback")
def q_smooth_loess_fallback(spark, sf):
    """LOESS over the events of every user; series too short for it get the centred average."""
    return finish(smooth.loess(tb.user_events(spark, sf), frac=0.1, window=3))


@query("src_text_time")
def q_src_text_time(spark, sf):
    """B2: times that arrive as text in a format of their own; text that is no such time is NULL."""
    from tsforge.sources.csv import to_long

    e = tb.table(spark, sf, "events").select(
        "event_type", "value", F.when(F.col("event_id") % 10 == 0, F.date_format("ts", "yyyy-MM-dd"))
        .otherwise(F.date_format("ts", "dd.MM.yyyy HH:mm:ss")).alias("at"))
    return finish(to_long(e, "at", "value", series_cols="event_type", ts_format="dd.MM.yyyy HH:mm:ss"))


@query("upsample_linear_seconds")
def q_upsample_linear_seconds(spark, sf):
    """A rule in seconds."""
    return finish(calendar.upsample(tb.ev_hourly(spark, sf), "1200S", 1))


@query("ds_matrix")
def q_ds_matrix(spark, sf):
    """The T x D matrix of every sample (embedding values as two features), in micro-units."""
    from tsforge.sources.labelled import matrices

    e = tb.emb(spark, sf).select(
        F.lit("train").alias("split"), F.col("label").cast("string").alias("label"), "series_id",
        F.expr("step div 2").alias("step"), F.when(F.col("step") % 2 == 0, "even").otherwise("odd").alias("var"),
        F.col("x").alias("value"))
    row = lambda r: F.array_join(F.transform(r, lambda v: F.floor(v * 1e6 + 0.5).cast("string")), ",")
    return finish(matrices(e).withColumn("matrix", F.array_join(F.transform("matrix", row), ";")))
