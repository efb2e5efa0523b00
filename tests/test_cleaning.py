import math

import pytest
from series_helpers import collect_series
from fixture_data import MULTI, MULTI_CLEANED, MULTI_COLUMNS, SINGLE, SINGLE_CLEANED
from pyspark.sql import functions as F

from tsforge.operators import calendar, detect, fill, smooth
from tsforge.plans import cleaning
from tsforge.sources.csv import to_long


def single_raw(spark):
    df = spark.createDataFrame(SINGLE, "date string, temperature double")
    return to_long(df, "date", "temperature", series_id="single")


def test_single_golden(spark):
    """linear fill → rolling z (w=10, t=2.5) → NULL → linear fill reproduces the cleaned fixture."""
    out = cleaning.clean(single_raw(spark), freq="D", fill_method=1, outlier_method=2, detect_method=2,
                         threshold=2.5, window=10, chunk_rows=16)
    got = collect_series(out)
    exp = [v for _, v in SINGLE_CLEANED]
    assert len(got) == 90
    assert max(abs(a - b) for a, b in zip(got, exp)) < 1e-9


def test_single_flags(spark):
    g = fill.linear(calendar.regularize(single_raw(spark), "D"))
    for det in (detect.zscore(g, 3.0), detect.iqr(g), detect.rolling_zscore(g, 2.5, 10, chunk_rows=7)):
        flagged = [str(r["ts"])[:10] for r in det.filter("is_outlier").collect()]
        assert flagged == ["2023-01-10"]
    assert detect.rolling_zscore(g, 3.0, 20).filter("is_outlier").count() == 0


def test_rolling_bound():
    assert abs(detect.rolling_zscore_bound(10) - 2.8460) < 1e-4
    assert abs(detect.rolling_zscore_bound(20) - 4.2485) < 1e-4


def test_multi_fill_golden(spark):
    schema = "timestamp string, " + ", ".join(f"{c} double" for c in MULTI_COLUMNS[1:])
    df = spark.createDataFrame(MULTI, schema)
    g = fill.linear(calendar.regularize(to_long(df, "timestamp", MULTI_COLUMNS[1:], series_id="m"), "H"), chunk_rows=5)
    for j, c in enumerate(MULTI_COLUMNS[1:], 1):
        got = collect_series(g, c)
        exp = [r[j] for r in MULTI_CLEANED]
        assert max(abs(a - b) for a, b in zip(got, exp)) < 1e-9, c


def mk(spark, vals, sid="s"):
    return spark.createDataFrame(
        [(sid, "v", None, i, None if v is None else float(v)) for i, v in enumerate(vals)],
        "series_id string, var string, ts timestamp_ntz, pos long, value double")


@pytest.mark.parametrize("chunk", [1, 2, 3, 100])
def test_linear_anchor(spark, chunk):
    assert collect_series(fill.linear(mk(spark, [None, 1, None, 3, 4, None]), chunk_rows=chunk)) == [None, 1, 2, 3, 4, 4]


@pytest.mark.parametrize("chunk", [1, 2, 5, 100])
def test_ewm_anchor(spark, chunk):
    got = collect_series(smooth.ewm(mk(spark, [1, None, 3, 4, None, None, 7]), 0.2, chunk_rows=chunk))
    exp = [1, 1, 1.476190, 1.980952, 1.980952, 1.980952, 3.390797]
    assert all(abs(a - b) < 1e-6 for a, b in zip(got, exp))


def test_centred_ma_even(spark):
    got = collect_series(smooth.moving_average(mk(spark, list(range(8))), 4, chunk_rows=3))
    # edges keep the original value
    assert got == [0, 1, 1.5, 2.5, 3.5, 4.5, 5.5, 7]


def test_rolling_mean_fill(spark):
    got = collect_series(fill.rolling_mean(mk(spark, [1, None, 3, None, None, None, 9]), window=3, chunk_rows=2))
    assert got == [1, 1, 3, 3, 3, None, 9]


def test_decompose_parts_sum(spark):
    vals = [math.sin(i / 2.0) + (i % 7) * 0.3 for i in range(60)]
    d = fill.decompose(mk(spark, vals), period=7, chunk_rows=9).orderBy("pos").collect()
    for r in d:
        if r["trend"] is not None:
            assert abs(r["trend"] + r["seasonal"] + r["resid"] - r["value"]) < 1e-9
    seas = {r["pos"] % 7: r["seasonal"] for r in d}
    assert abs(sum(seas.values())) < 1e-9


def test_fill_never_alters_observed(spark):
    vals = [1.0, None, 5.0, None, None, 2.0, None]
    base = mk(spark, vals)
    for out in (fill.linear(base, chunk_rows=2), fill.rolling_mean(base, 3, chunk_rows=2),
                fill.seasonal(base, period=2, chunk_rows=3)):
        got = collect_series(out)
        for a, b in zip(vals, got):
            if a is not None:
                assert a == b


def test_unsupported_methods_raise(spark):
    df = mk(spark, [1, 2, 3])
    with pytest.raises(ValueError):
        detect.outliers(df, method=9)
    with pytest.raises(ValueError):
        fill.missing_values(df, method=9)
    with pytest.raises(ValueError):
        fill.handle_outliers(df, method=9)
    with pytest.raises(ValueError):
        calendar.downsample(df.withColumn("ts", F.current_timestamp().cast("timestamp_ntz")), "X")
    with pytest.raises(ValueError):
        calendar.step_micros("5 fortnights")
