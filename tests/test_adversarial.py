"""Adversarial inputs (FIXTURES §3)."""

import math

import numpy as np
import pytest
from series_helpers import collect_series

from tsforge.operators import detect, fill, normalize, relations, smooth, spectral, stationarity, transform, unitroot

SCHEMA = "series_id string, var string, ts timestamp_ntz, pos long, value double"


def mk(spark, vals, sid="s", var="v"):
    return spark.createDataFrame([(sid, var, None, i, None if v is None else float(v)) for i, v in enumerate(vals)],
                                 SCHEMA)


def test_empty_frame(spark):
    e = spark.createDataFrame([], SCHEMA)
    for out in (fill.linear(e), detect.rolling_zscore(e, 3.0, 5), smooth.ewm(e), detect.zscore(e),
                transform.diff(e), stationarity.acf(e, 5)):
        assert out.count() == 0


def test_one_row_and_all_null(spark):
    one = mk(spark, [3.0])
    assert collect_series(fill.linear(one)) == [3.0]
    assert detect.rolling_zscore(one, 3.0, 5).filter("is_outlier").count() == 0
    assert collect_series(smooth.ewm(one)) == [3.0]
    nulls = mk(spark, [None, None, None])
    assert collect_series(fill.linear(nulls)) == [None, None, None]
    assert collect_series(smooth.ewm(nulls)) == [None, None, None]
    assert collect_series(fill.rolling_mean(nulls, 2)) == [None, None, None]


def test_constant_series(spark):
    c = mk(spark, [5.0] * 30)
    assert detect.zscore(c).filter("is_outlier").count() == 0
    assert detect.rolling_zscore(c, 1.0, 5).filter("is_outlier").count() == 0
    assert detect.iqr(c).filter("is_outlier").count() == 0
    assert collect_series(normalize.minmax(c)) == [0.0] * 30
    assert collect_series(normalize.standardize(c)) == [None] * 30
    a = stationarity.autocorr(c, 3).collect()[0]
    assert a["autocorr"] is None
    corr = relations.correlation(c.unionByName(mk(spark, list(range(30)), var="w"))).collect()
    assert any(r["corr"] is None for r in corr)


def test_window_longer_than_series(spark):
    d = mk(spark, [1, 2, 3])
    assert collect_series(smooth.moving_average(d, 7)) == [1, 2, 3]
    assert collect_series(fill.rolling_mean(mk(spark, [1, None, 3]), 50)) == [1, 1, 3]
    assert collect_series(transform.seasonal_diff(d, 12)) == [None, None, None]


def test_non_positive_transforms(spark):
    d = mk(spark, [0.0, -2.0, 3.0])
    logs = collect_series(transform.log(d))
    assert abs(logs[1] - math.log(1e-10)) < 1e-9 and abs(logs[0] - math.log(2 + 1e-10)) < 1e-9
    assert collect_series(transform.sqrt(d)) == [math.sqrt(2.0), 0.0, math.sqrt(5.0)]
    bc = collect_series(transform.boxcox(d, lmbda=1.0))
    assert abs(bc[1] - (1e-10 - 1.0)) < 1e-9


def test_collinear_pair(spark):
    x = np.arange(50, dtype=float) + np.sin(np.arange(50))
    d = mk(spark, list(x), var="a").unionByName(mk(spark, list(2 * x + 1), var="b"))
    c = {(r["var1"], r["var2"]): r["corr"] for r in relations.correlation(d).collect()}
    assert abs(c[("a", "b")] - 1.0) < 1e-12
    comps, _ = relations.pca(d)
    r = [row["explained_variance_ratio"] for row in comps.orderBy("pc").collect()]
    assert abs(r[0] - 1.0) < 1e-9 and abs(r[1]) < 1e-9
    eg = unitroot.engle_granger(d, "b", "a").collect()[0]
    assert eg["slope"] == pytest.approx(2.0) and eg["intercept"] == pytest.approx(1.0)


def test_granger_short_series(spark):
    d = mk(spark, [1, 2, 3, 5, 8], var="y").unionByName(mk(spark, [2, 1, 2, 1, 2], var="x"))
    rows = unitroot.granger(d, "y", "x", 2).collect()
    assert all(r["f_stat"] is None or not math.isfinite(r["f_stat"]) or r["df_denom"] > 0 for r in rows)


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17])
def test_fft_lengths(spark, n):
    x = np.cos(np.arange(n))
    d = mk(spark, list(x))
    got = {r["k"]: complex(r["re"], r["im"]) for r in spectral.dft(d).collect()}
    assert np.allclose([got[k] for k in range(n)], np.fft.fft(x))


def test_out_of_order_input(spark):
    import datetime as dt

    from tsforge.operators import calendar

    rows = [("s", "v", dt.datetime(2024, 1, 1) + dt.timedelta(days=d), float(d)) for d in (5, 0, 3, 1)]
    df = spark.createDataFrame(rows, "series_id string, var string, ts timestamp_ntz, value double")
    g = fill.linear(calendar.regularize(df, "D"))
    assert collect_series(g) == [0, 1, 2, 3, 4, 5]


def test_adf_no_constant_uses_levels(spark):
    """regression='n' must not centre the series (the level matters without a constant)."""
    rng = np.random.default_rng(4)
    x = 50.0 + np.cumsum(rng.normal(size=200)) * 0.1
    d = mk(spark, list(x))
    r = unitroot.adf(d, regression="n", autolag=None, maxlag=0).collect()[0]
    y, xl = np.diff(x), x[:-1]
    b = (xl @ y) / (xl @ xl)
    s2 = ((y - b * xl) ** 2).sum() / (len(y) - 1)
    assert abs(r["statistic"] - b / np.sqrt(s2 / (xl @ xl))) < 1e-8


def loess_definition(y, frac):
    """Weighted least squares over the k nearest positions, point by point (NaN: no neighbour)."""
    n = len(y)
    k = int(n * frac)
    out = np.empty(n)
    for t in range(n):
        left = int(min(max(np.ceil(t - k / 2.0), 0), n - k))
        js = left + np.arange(k)
        dd = np.abs(js - t) / max(t - left, left + k - 1 - t)
        w = np.where(np.isnan(y[js]), 0.0, np.where(dd < 1, (1 - dd ** 3) ** 3, 0.0))
        v = np.nan_to_num(y[js])
        if w.sum() <= 1e-9:
            out[t] = np.nan
            continue
        xm, ym = (w * js).sum() / w.sum(), (w * v).sum() / w.sum()
        sxx = (w * (js - xm) ** 2).sum()
        out[t] = ym + ((w * (js - xm) * (v - ym)).sum() / sxx * (t - xm) if sxx > 1e-12 * max(1.0, xm * xm) else 0.0)
    return out


# chunks smaller than a neighbourhood get power sums for the blocks in between
@pytest.mark.parametrize("n,frac,chunk", [(120, 0.15, 16), (120, 0.15, 5), (301, 0.5, 7), (90, 1.0, 4), (64, 0.04, 8),
                                          (1000, 0.3, 65536)])
def test_loess_matches_definition(spark, n, frac, chunk):
    rng = np.random.default_rng(9)
    y = 1e3 + np.sin(np.arange(n) / 6.0) + 0.1 * rng.normal(size=n)
    got = np.array(collect_series(smooth.loess(mk(spark, list(y)), frac=frac, chunk_rows=chunk)))
    assert np.max(np.abs(got - loess_definition(y, frac))) < 1e-8


def test_loess_with_gaps(spark):
    rng = np.random.default_rng(10)
    y = 5 + rng.normal(size=150)
    y[rng.random(150) < 0.3] = np.nan
    got = np.array([np.nan if v is None else v for v in collect_series(
        smooth.loess(mk(spark, [None if np.isnan(v) else float(v) for v in y]), frac=0.2, chunk_rows=20))], dtype=float)
    exp = loess_definition(y, 0.2)
    assert (np.isnan(got) == np.isnan(exp)).all() and np.nanmax(np.abs(got - exp)) < 1e-8


def test_loess_work_is_linear():
    import time

    from tsforge.operators import loess as kernel

    def seconds(n):
        y = np.sin(np.arange(n) / 50.0)
        i, k = np.arange(n), n // 10
        best = np.inf
        for _ in range(3):
            t0 = time.perf_counter()
            blocks = kernel.Blocks(i, y, max(1, -(-k // 4)))
            lo, r = kernel.neighbourhood(i, n, k)
            kernel.fit(blocks.sums(lo, i, i, r), blocks.sums(i, lo + k, i, r), i, r)
            best = min(best, time.perf_counter() - t0)
        return best

    assert seconds(80_000) < 8 * seconds(20_000)  # four times the points; direct sums would take sixteen times


@pytest.mark.parametrize("parts", [1, 5, 60])
def test_quantiles_and_ranks_exact(spark, parts):
    """Quantiles and average ranks equal numpy/pandas however many ranges the values are cut into."""
    import pandas as pd

    from tsforge.operators.quantile import exact_quantiles

    rng = np.random.default_rng(parts)
    vals = np.round(rng.normal(size=800), 2)
    tied = np.where(rng.random(300) < 0.9, 1.5, rng.normal(size=300))
    series = {"v": vals, "w": np.tile(vals[:100], 3), "t": tied, "one": np.array([4.0])}
    d = mk(spark, list(vals) + [None])
    for var in ("w", "t", "one"):
        d = d.unionByName(mk(spark, list(series[var]), var=var))
    q = {r["var"]: r for r in exact_quantiles(d, [0.0, 0.1, 0.25, 0.75, 1.0], partitions=parts).collect()}
    for var, arr in series.items():
        assert q[var]["n"] == len(arr)
        for p, name in ((0.0, "q0"), (0.1, "q10"), (0.25, "q25"), (0.75, "q75"), (1.0, "q100")):
            assert abs(q[var][name] - np.quantile(arr, p)) < 1e-9
    ranks = collect_series(relations.average_ranks(mk(spark, list(vals)), partitions=parts))
    assert np.allclose(ranks, pd.Series(vals).rank(method="average").to_numpy())


def test_positions_of_a_hot_hour(spark):
    """90 % of the rows share one time: they are spread over ranges, and numbered without gaps."""
    from tsforge.operators import scan

    rows = spark.range(4000).selectExpr(
        "'s' AS series_id", "'v' AS var", "CAST(CASE WHEN id % 10 > 0 THEN 5 WHEN id % 20 = 0 THEN NULL ELSE id END AS BIGINT) AS ts",
        "id AS event_id")
    seen = []

    def hold(df):
        held = df.cache()
        seen.append([r["count"] for r in held.groupBy("_range").count().collect()])
        return held

    out = scan.number_rows(rows, ["series_id", "var"], ["ts"], hold=hold, partitions=16).collect()
    assert sorted(r["pos"] for r in out) == list(range(4000))
    assert max(seen[0]) < 1000 and len(seen[0]) > 8
    times = [r["ts"] for r in sorted(out, key=lambda r: r["pos"])]
    real = [t for t in times if t is not None]
    assert real == sorted(real) and times[len(real):] == [None] * 200


def test_adf_counts_only_complete_rows(spark):
    """With interior gaps, ADF's nobs is the number of complete regression rows."""
    rng = np.random.default_rng(8)
    x = list(np.cumsum(rng.normal(size=120)))
    for i in (30, 31, 77):
        x[i] = None
    r = unitroot.adf(mk(spark, x), autolag=None, maxlag=0).collect()[0]
    # rows t with x_t, x_{t-1} present: 119 pairs minus those touching a gap (30,31 -> 3 pairs; 77 -> 2 pairs)
    assert r["nobs"] == 119 - 3 - 2
