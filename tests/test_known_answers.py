"""Known answers: inputs whose result is known without a formula of ours."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsforge.functions import dist
from tsforge.operators import calendar, collinear, fill, relations, transform, unitroot
from tsforge.sources.sinks import processing_log

SCHEMA = "series_id string, var string, ts timestamp_ntz, pos long, value double"


def long(spark, series: dict, sid="s"):
    import datetime as dt

    rows = [(sid, v, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), i, None if x is None else float(x))
            for v, xs in series.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, SCHEMA)


def test_seasonal_fill_restores_an_exact_season(spark):
    full = [100 + [0, 5, -3, 8, 1, -6, -5][i % 7] for i in range(84)]
    gaps = {9, 17, 25, 38, 51, 60, 73}
    df = long(spark, {"a": [None if i in gaps else x for i, x in enumerate(full)]})
    got = {r["pos"]: r["value"] for r in fill.seasonal(df, 7).collect()}
    assert max(abs(got[i] - full[i]) for i in range(84)) < 1e-9


def test_seasonal_fill_of_a_short_series_is_linear(spark):
    df = long(spark, {"a": [0, 1, 2, None, 4, 5, 6, 7, 8, 9]})
    assert {r["pos"]: r["value"] for r in fill.seasonal(df, 7).collect()}[3] == 3


def test_downsample_keeps_small_and_large_values(spark):
    for scale in (1e-12, 1e29):
        got = calendar.downsample(long(spark, {"a": [k * scale for k in range(1, 6)]}), "M", "mean").collect()
        assert got[0]["value"] == pytest.approx(3 * scale)


def test_boxcox_lambda_beyond_the_first_grid(spark):
    rng = np.random.default_rng(0)
    y = rng.normal(100, 8, 4000)
    got = transform.boxcox_lambda(long(spark, {"a": (4 * y + 1) ** 0.25}), refine=1).first()["lmbda"]
    assert 3 < got < 5.5
    assert transform.boxcox_lambda(long(spark, {"a": [3.0] * 50}), refine=0).count() == 1  # ends on a flat series


def test_johansen_rank_of_white_noise(spark):
    rng = np.random.default_rng(1)
    for k in (5, 13):
        df = long(spark, {f"v{i:02d}": rng.normal(size=400) for i in range(k)})
        rows = unitroot.johansen(df).collect()
        assert {r["rank"] for r in rows} == ({5} if k == 5 else {None})
    assert all(r["trace_crit_90"] < r["trace_crit_95"] < r["trace_crit_99"] for r in rows if r["r"] > 0)


def test_duplicate_timestamps(spark):
    df = long(spark, {"a": [1, 2, 3]})
    twice = df.unionByName(df.filter("pos = 1").withColumn("value", F.lit(4.0)))
    with pytest.raises(Exception, match="duplicate timestamps"):
        calendar.regularize(twice, "D").collect()
    got = {r["pos"]: r["value"] for r in calendar.regularize(twice, "D", duplicates="mean").collect()}
    assert got == {0: 1, 1: 3, 2: 3}


def test_unknown_variables(spark):
    df = long(spark, {"a": range(30), "b": range(30)})
    for call in (lambda: unitroot.granger(df, "a", "x"), lambda: unitroot.engle_granger(df, "x", "b"),
                 lambda: transform.apply(df, "log", columns=["x"])):
        with pytest.raises(ValueError, match="unknown variable"):
            call()


def test_adf_without_constant_has_its_own_tables(spark):
    assert dist.mackinnon_p(-1.94100, 1, "n") == pytest.approx(0.05, abs=0.002)
    assert dist.mackinnon_p(-2.56574, 1, "n") == pytest.approx(0.01, abs=0.002)
    rng = np.random.default_rng(2)
    r = unitroot.adf(long(spark, {"a": np.cumsum(rng.normal(size=300))}), regression="n", autolag=None, maxlag=0).first()
    assert r["crit_5"] == pytest.approx(-1.94, abs=0.01)


def test_pca_handler_leaves_uncorrelated_series(spark):
    rng = np.random.default_rng(3)
    df = long(spark, {k: rng.normal(size=200) for k in "abc"})
    x = rng.normal(size=200)
    tied = long(spark, {"a": x, "b": x + 0.01 * rng.normal(size=200)}, "t")
    out = collinear.handle(df.unionByName(tied), "pca", n_components=1)
    names = {(r["series_id"], r["var"]) for r in out.select("series_id", "var").distinct().collect()}
    assert {v for s, v in names if s == "s"} == {"a", "b", "c"}
    assert len([v for s, v in names if s == "t"]) == 1 and not {v for s, v in names if s == "t"} & {"a", "b"}


def handler_series(spark):
    """s: nothing correlated; t: b follows a with ten times its variance; u: three of a kind."""
    rng = np.random.default_rng(4)
    x, y = rng.normal(size=300), rng.normal(size=300)
    noise = lambda k: k * rng.normal(size=300)
    parts = [long(spark, {k: rng.normal(size=300) for k in "abc"}, "s"),
             long(spark, {"a": x, "b": 3 * x + noise(2.2), "c": noise(1.0)}, "t"),
             long(spark, {"a": y, "b": y + noise(0.01), "c": y + noise(0.01)}, "u")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@pytest.mark.parametrize("method,want", [
    ("drop", {"s": "abc", "t": "ac", "u": "c"}), ("select", {"s": "abc", "t": "bc", "u": "c"}),
    ("combine", {"s": "abc", "t": ["b", "c", "combined_1"], "u": ["c", "combined_1", "combined_2", "combined_3"]}),
    ("pca", {"s": "abc", "t": ["PC1", "PC2", "PC3"], "u": ["PC1", "PC2", "PC3"]})])
def test_handlers_and_their_log(spark, method, want):
    df = handler_series(spark)
    comps, _ = relations.pca(df)
    weights, choice, record = collinear.handling(df, method)
    got = {}
    for r in relations.linear_map(df, weights).select("series_id", "var").distinct().collect():
        got.setdefault(r["series_id"], set()).add(r["var"])
    if method in ("drop", "select"):  # u: whichever of three alike stays, one does
        assert got["s"] == set(want["s"]) and got["t"] in ({"a", "c"}, {"b", "c"}) and len(got["u"]) <= 2
        if method == "select":
            assert got["t"] == {"b", "c"}
    else:
        assert got == {s: set(v) for s, v in want.items()}
    log = {r["series_id"]: r for r in processing_log(record, comps).collect()}
    assert {s: r["method"] for s, r in log.items()} == {"s": "none", "t": method, "u": method}
    assert log["s"]["details"] == "threshold=0.7" and log["s"]["n_components"] is None
    if method == "drop":
        assert set(log["t"]["details"].removeprefix("threshold=0.7; removed ").split(", ")) == set("abc") - got["t"]
    elif method == "select":
        assert log["t"]["details"] == "threshold=0.7; kept b, c"
    elif method == "combine":
        assert log["t"]["details"] == "threshold=0.7; combined combined_1"
    else:
        assert log["t"]["details"] == "threshold=0.7; PC1, PC2, PC3" and log["t"]["explained_variance"] == pytest.approx(1)


def test_auto_takes_the_given_importance(spark):
    df = handler_series(spark).filter("series_id = 't'")
    rows = [("t", "a", 100.0), ("t", "b", 1.0), ("t", "c", 1.0)]
    imp = spark.createDataFrame(rows, "series_id string, var string, importance double")
    out, choice = collinear.handle_auto(df, threshold=0.7, imp=imp)
    first = choice.first()
    assert first["method"] == "select" and first["cv_importance"] > 0.5
    assert {r["var"] for r in out.select("var").distinct().collect()} == {"a", "c"}


def test_transform_subset(spark):
    df = long(spark, {"a": [1, math.e], "b": [1, 2]})
    got = {(r["var"], r["pos"]): r["value"] for r in transform.apply(df, "log", columns=["a"]).collect()}
    assert got == {("a", 0): 0, ("a", 1): pytest.approx(1), ("b", 0): 1, ("b", 1): 2}


def test_adf_t_stat_lag_choice(spark):
    """autolag='t-stat' against a plain least-squares walk from the longest lag order down."""
    from tsforge.operators import unitroot

    rng = np.random.default_rng(0)
    x = np.zeros(300)
    for i in range(4, 300):
        x[i] = 0.5 * x[i - 1] + 0.35 * x[i - 4] + rng.normal()
    df = spark.createDataFrame([("s", "v", None, i, float(v)) for i, v in enumerate(x)],
                               "series_id string, var string, ts timestamp_ntz, pos long, value double")
    got = unitroot.adf(df, autolag="t-stat", maxlag=8).collect()[0]
    dx = np.diff(x)

    def fit(p, first):
        t = np.arange(first, len(dx))
        z = np.column_stack([np.ones(len(t)), x[t], *[dx[t - j] for j in range(1, p + 1)]])
        b, *_ = np.linalg.lstsq(z, dx[t], rcond=None)
        e = dx[t] - z @ b
        return b / np.sqrt(e @ e / (len(t) - z.shape[1]) * np.diag(np.linalg.inv(z.T @ z)))

    lag = next(p for p in range(8, -1, -1) if abs(fit(p, 8)[-1]) >= 1.6448536269514722 or p == 0)
    assert 0 < lag < 8 and got["used_lag"] == lag
    assert abs(got["icbest"] - abs(fit(lag, 8)[-1])) < 1e-8
    assert abs(got["statistic"] - fit(lag, lag)[1]) < 1e-8
