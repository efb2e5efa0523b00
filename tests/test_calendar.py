import datetime as dt

from pyspark.sql import functions as F

from tsforge.operators import calendar


def test_weekly_labels(spark):
    days = [(dt.datetime(2023, 1, 1) + dt.timedelta(days=i),) for i in range(40)]
    df = spark.createDataFrame(days, "ts timestamp_ntz").select(
        F.lit("s").alias("series_id"), F.lit("v").alias("var"), "ts", F.lit(1.0).alias("value"))
    out = calendar.downsample(df, "W", 1).orderBy("pos").collect()
    labels = [r["ts"].strftime("%m-%d") for r in out]
    assert labels == ["01-01", "01-08", "01-15", "01-22", "01-29", "02-05", "02-12"]
    assert [r["value"] for r in out][:2] == [1.0, 7.0]


def test_regularize_drops_off_grid_and_fills_null(spark):
    rows = [(dt.datetime(2024, 1, 1, h, m),) for h, m in [(0, 0), (1, 0), (1, 30), (4, 0)]]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select(
        F.lit("s").alias("series_id"), F.lit("v").alias("var"), "ts", F.lit(2.0).alias("value"))
    g = calendar.regularize(df, "H", chunk_rows=2).orderBy("pos").collect()
    assert [r["pos"] for r in g] == [0, 1, 2, 3, 4]
    assert [r["value"] for r in g] == [2.0, 2.0, None, None, 2.0]


def test_month_quarter_year_labels(spark):
    rows = [(dt.datetime(2023, 1, 15),), (dt.datetime(2023, 5, 2),), (dt.datetime(2024, 2, 29),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select(
        F.lit("s").alias("series_id"), F.lit("v").alias("var"), "ts", F.lit(1.0).alias("value"))
    m = calendar.downsample(df, "M", 1).orderBy("pos").collect()
    assert len(m) == 14 and m[0]["ts"].date() == dt.date(2023, 1, 31) and m[-1]["ts"].date() == dt.date(2024, 2, 29)
    q = calendar.downsample(df, "Q", 0).orderBy("pos").collect()
    assert [r["ts"].date() for r in q] == [dt.date(2023, 3, 31), dt.date(2023, 6, 30), dt.date(2023, 9, 30),
                                           dt.date(2023, 12, 31), dt.date(2024, 3, 31)]
    y = calendar.downsample(df, "Y", 2).orderBy("pos").collect()
    assert [r["ts"].date() for r in y] == [dt.date(2023, 12, 31), dt.date(2024, 12, 31)]


def test_upsample_ffill(spark):
    rows = [(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 2),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz").select(
        F.lit("s").alias("series_id"), F.lit("v").alias("var"), "ts", F.dayofmonth("ts").cast("double").alias("value"))
    out = calendar.upsample(df, "H", 0, chunk_rows=5).orderBy("pos").collect()
    assert len(out) == 25 and out[12]["value"] == out[0]["value"] and out[24]["value"] != out[0]["value"]
    lin = calendar.upsample(df, "H", 1, chunk_rows=5).orderBy("pos").collect()
    assert abs(lin[12]["value"] - (lin[0]["value"] + lin[24]["value"]) / 2) < 1e-6
