"""Numeric anchors (independent numpy computations from published formulas)."""

import pytest
from pyspark.sql import functions as F

from tsforge.operators import collinear, relations, stationarity, unitroot


def approx(a, b, tol=1e-4):
    return abs(a - b) <= tol


def by_var(df, col):
    return {r["var"]: r[col] for r in df.collect()}


@pytest.mark.parametrize("chunk", [7, 1000])
def test_adf(multi_long, chunk):
    r = {x["var"]: x for x in unitroot.adf(multi_long, chunk_rows=chunk).collect()}
    exp = {"temperature": (-3.1537, 0.0228, 4, 67), "humidity": (-5.2492, 0.0000, 1, 70),
           "pressure": (-0.2205, 0.9360, 12, 59), "wind_speed": (0.2998, 0.9773, 12, 59)}
    for v, (s, p, lag, nobs) in exp.items():
        assert approx(r[v]["statistic"], s) and approx(r[v]["p_value"], p)
        assert r[v]["used_lag"] == lag and r[v]["nobs"] == nobs


def test_kpss(multi_long):
    r = {x["var"]: x for x in stationarity.kpss(multi_long, chunk_rows=11).collect()}
    exp = {"temperature": (0.5476, 0.0309), "humidity": (0.4933, 0.0432), "pressure": (0.4706, 0.0483),
           "wind_speed": (0.5457, 0.0314)}
    for v, (s, p) in exp.items():
        assert approx(r[v]["statistic"], s) and approx(r[v]["p_value"], p) and r[v]["lags"] == 5


def test_verdicts(multi_long):
    v = by_var(unitroot.stationarity_verdict(unitroot.adf(multi_long), stationarity.kpss(multi_long)), "conclusion")
    assert v == {"temperature": "trend_stationary", "humidity": "trend_stationary",
                 "pressure": "non_stationary", "wind_speed": "non_stationary"}


def test_autocorr(multi_long):
    a12 = by_var(stationarity.autocorr(multi_long, 12, chunk_rows=5), "autocorr")
    a24 = by_var(stationarity.autocorr(multi_long, 24), "autocorr")
    assert approx(a12["temperature"], -0.5664) and approx(a24["pressure"], 0.9610)


def test_granger(multi_long):
    g = unitroot.granger(multi_long, "pressure", "wind_speed", 5, chunk_rows=9).orderBy("lag").collect()
    assert [round(r["f_stat"], 4) for r in g] == [0.9558, 12.8109, 7.5045, 5.0737, 3.9849]
    assert approx(g[0]["p_value"], 0.3317) and approx(g[4]["p_value"], 0.0037)
    assert [r["significant"] for r in g] == [False, True, True, True, True]


def test_engle_granger(multi_long):
    r = unitroot.engle_granger(multi_long, "temperature", "pressure").collect()[0]
    assert approx(r["statistic"], -3.0769) and approx(r["p_value"], 0.0930) and r["used_lag"] == 4
    assert r["cointegrated"] is False


def test_correlations(multi_long):
    c = {(r["var1"], r["var2"]): r["corr"] for r in relations.correlation(multi_long).collect()}
    assert approx(c[("temperature", "humidity")], -0.9951) and approx(c[("pressure", "wind_speed")], -0.9900)
    assert c[("humidity", "humidity")] == 1.0
    s = {(r["var1"], r["var2"]): r["corr"] for r in relations.correlation(multi_long, "spearman").collect()}
    assert approx(s[("temperature", "humidity")], -0.9943) and approx(s[("humidity", "pressure")], 0.9953)
    pairs = relations.strong_pairs(relations.correlation(multi_long), 0.7)
    assert pairs.count() == 6
    st = by_var(collinear.strength(relations.correlation(multi_long)), "strength")
    assert approx(st["temperature"], 2.9772) and approx(st["humidity"], 2.9841)
    ch = collinear.auto_choice(multi_long, pairs).collect()[0]
    assert ch["method"] == "pca" and approx(ch["mean_abs_r"], 0.992688, 1e-5)


def test_ccf(multi_long):
    cc = relations.ccf(multi_long, "temperature", "humidity", 10, chunk_rows=13).orderBy("lag").collect()
    exp = [-0.9951, -0.9743, -0.9023, -0.7845, -0.6295, -0.4488, -0.2534, -0.0569, 0.1289, 0.2915, 0.4216]
    assert all(approx(r["ccf"], e) for r, e in zip(cc, exp))
    assert approx(cc[0]["band"], 0.2310)


def test_pca(multi_long):
    comps, loads = relations.pca(multi_long)
    ratios = [r["explained_variance_ratio"] for r in comps.orderBy("pc").collect()]
    assert all(approx(a, b, 1e-6) for a, b in zip(ratios, [0.994516, 0.002888, 0.001955, 0.000640]))
    assert relations.n_components_for(comps).collect()[0]["n_components"] == 1
    # loadings are orthonormal
    import numpy as np

    L = np.zeros((4, 4))
    names = sorted({r["var"] for r in loads.collect()})
    for r in loads.collect():
        L[names.index(r["var"]), r["pc"] - 1] = r["loading"]
    assert np.allclose(L.T @ L, np.eye(4), atol=1e-9)
    scores = relations.pca_scores(multi_long, loads).filter(F.col("var") == "PC1")
    assert scores.count() == 72


def test_acf_band_and_pacf(multi_long):
    a = {(r["var"], r["lag"]): r for r in stationarity.acf(multi_long, 24, chunk_rows=10).collect()}
    assert approx(a[("temperature", 12)]["acf"], a[("temperature", 12)]["acf"])
    assert a[("temperature", 0)]["acf"] == 1.0 and a[("temperature", 0)]["band"] == 0.0
    assert approx(a[("temperature", 1)]["band"], 1.959964 / 72 ** 0.5)
    p = {(r["var"], r["lag"]): r["pacf"] for r in stationarity.pacf(multi_long, 5).collect()}
    assert p[("temperature", 0)] == 1.0


def test_whitened_pcs_match_processed_fixture(multi_long):
    """The reference's processed output equals the three whitened PCs of the
    cleaned fixture up to sign and order (it re-ran PCA on PCs, SURVEY Q19)."""
    import itertools

    import numpy as np
    from fixture_data import PROCESSED

    comps, loads = relations.pca(multi_long)
    sc = relations.pca_scores(multi_long, loads, n_components=3, whiten=True, components=comps)
    got = {p: np.array([r["value"] for r in sc.filter(F.col("var") == p).orderBy("pos").collect()])
           for p in ("PC1", "PC2", "PC3")}
    ref = np.array([r[1:] for r in PROCESSED], dtype=float)
    best = min(
        max(np.max(np.abs(s * got[p] - ref[:, j])) for j, (p, s) in enumerate(zip(perm, signs)))
        for perm in itertools.permutations(got)
        for signs in itertools.product((1, -1), repeat=3)
    )
    assert best < 1e-6
