"""Plan-shape checks: ordered operators must never collapse a series into a
single partition (no SinglePartition exchange / global window)."""

import pytest

from tsforge.operators import calendar, detect, fill, relations, smooth, stationarity, transform, unitroot


@pytest.fixture(scope="module")
def grid(spark):
    import datetime as dt

    rows = [("s", v, dt.datetime(2024, 1, 1) + dt.timedelta(hours=h), float((h * 7 + len(v)) % 13))
            for h in range(200) if h % 9 for v in ("a", "b")]
    df = spark.createDataFrame(rows, "series_id string, var string, ts timestamp_ntz, value double")
    return calendar.regularize(df, "H", chunk_rows=32)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("op", [
    lambda g: fill.linear(g, chunk_rows=32),
    lambda g: detect.rolling_zscore(g, 3.0, 10, chunk_rows=32),
    lambda g: smooth.moving_average(g, 4, chunk_rows=32),
    lambda g: smooth.ewm(g, 0.2, chunk_rows=32),
    lambda g: transform.diff(g, 2, chunk_rows=32),
    lambda g: fill.decompose(fill.linear(g), 6, chunk_rows=32),
    lambda g: stationarity.acf(fill.linear(g), 10, chunk_rows=32),
    lambda g: unitroot.adf(fill.linear(g), chunk_rows=32),
    lambda g: relations.correlation(g, vars_=["a", "b"]),
])
def test_no_single_partition(grid, op):
    p = plan(op(grid))
    assert "SinglePartition" not in p
    assert "Window [" not in p or "_chunk" in p or "series_id" in p
