import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsforge.operators import scan, spectral
from tsforge.sources import labelled


def signal(spark, n=1024):
    rows = [("sig", "x", None, i, math.sin(2 * math.pi * 50 * i / n) + 0.5 * math.sin(2 * math.pi * 120 * i / n))
            for i in range(n)]
    return spark.createDataFrame(rows, "series_id string, var string, ts timestamp_ntz, pos long, value double")


def test_amplitude_peaks(spark):
    amp = spectral.amplitude(spectral.dft(signal(spark)), dt=1.0 / 1024).collect()
    a = {round(r["freq"]): r["amplitude"] for r in amp}
    assert abs(a[50] - 1.0) < 1e-9 and abs(a[120] - 0.5) < 1e-9
    assert max(v for f, v in a.items() if f not in (50, 120)) < 1e-9


@pytest.mark.parametrize("n", [1, 7, 64, 90])
def test_dft_matches_numpy(spark, n):
    rng = np.random.default_rng(n)
    x = rng.normal(size=n)
    df = spark.createDataFrame([("s", "v", None, i, float(v)) for i, v in enumerate(x)],
                               "series_id string, var string, ts timestamp_ntz, pos long, value double")
    exp = np.fft.fft(x)
    for out in (spectral.dft(df), spectral.four_step(df)):
        got = {r["k"]: complex(r["re"], r["im"]) for r in out.collect()}
        assert all(abs(got[k] - exp[k]) < 1e-9 for k in range(n))
    assert spectral.roundtrip_error(df).collect()[0]["max_abs_error"] < 1e-12


@pytest.mark.parametrize("n", [1, 2, 7, 97])
def test_chirp_matches_numpy(spark, n):
    """Lengths without an even split: several series of a length, and inverse of a complex input."""
    rng = np.random.default_rng(n)
    x = rng.normal(size=(2, n)) + 1j * rng.normal(size=(2, n))
    df = spark.createDataFrame([(f"s{s}", "v", i, float(x[s, i].real), float(x[s, i].imag)) for s in range(2)
                                for i in range(n)], "series_id string, var string, pos long, value double, im double")
    for inverse, exp in ((False, np.fft.fft(x)), (True, np.fft.ifft(x))):
        out = spectral.dft(df, inverse, imag="im", short_max=0, uneven=0).collect()
        assert len(out) == 2 * n
        assert all(abs(complex(r["re"], r["im"]) - exp[int(r["series_id"][1]), r["k"]]) < 1e-9 for r in out)


def test_short_series_are_transformed_together(spark):
    """Many short series are rows of arrays; each keeps its own spectrum."""
    n, k = 16, 40
    df = spark.range(n * k).selectExpr(f"CAST(id DIV {n} AS STRING) AS series_id", "'v' AS var", f"id % {n} AS pos",
                                       "CAST(id * 7 % 11 AS DOUBLE) AS value")
    got = {(r["series_id"], r["k"]): complex(r["re"], r["im"]) for r in spectral.dft(df).collect()}
    for s in range(k):
        exp = np.fft.fft([float((s * n + i) * 7 % 11) for i in range(n)])
        assert all(abs(got[str(s), i] - exp[i]) < 1e-9 for i in range(n))


def test_positions_irregular(spark):
    import datetime as dt

    base = dt.datetime(2024, 1, 1)
    rows = [("a", "v", base + dt.timedelta(seconds=s), i, float(i)) for i, s in enumerate([5, 1, 9, 9, 100, 3000, 3001])]
    df = spark.createDataFrame(rows, "series_id string, var string, ts timestamp_ntz, event_id long, value double")
    out = scan.assign_positions(df, order_cols=("ts", "event_id")).orderBy("pos").collect()
    assert [r["pos"] for r in out] == list(range(7))
    assert [r["event_id"] for r in out] == [1, 0, 2, 3, 4, 5, 6]


def write_tree(root):
    files = {
        "train/OK/0001.csv": [(1, 1.0, 2.0), (2, 3.0, 4.0)],
        "train/NG/0001.csv": [(1, 5.0, 5.0), (2, 5.0, 5.0)],
        "val/OK/0001.csv": [(1, 1.0, 2.0), (2, 3.0, 4.0)],
        "misc/OK/0009.csv": [(1, 0.0, 0.0)],
    }
    for rel, rows in files.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as f:
            f.write("ID,X1,X2\n" + "\n".join(",".join(str(v) for v in r) for r in rows))
    with open(os.path.join(root, "train", "notes.txt"), "w") as f:
        f.write("not a csv")


def test_labelled_tree(spark, tmp_path):
    write_tree(str(tmp_path))
    d = labelled.scan_tree(spark, str(tmp_path))
    ok, rejected = labelled.valid_splits(d)
    assert {r["series_id"] for r in rejected.collect()} == {"misc/OK/0009"}
    m = {r["series_id"]: r for r in labelled.matrices(ok).collect()}
    assert m["train/OK/0001"]["matrix"] == [[1.0, 2.0], [3.0, 4.0]]
    norm = {r["series_id"]: r for r in labelled.matrices(labelled.normalise(ok, "minmax")).collect()}
    assert norm["train/OK/0001"]["matrix"] == [[0.0, 1 / 3], [2 / 3, 1.0]]
    assert norm["train/NG/0001"]["matrix"] == [[0.0, 0.0], [0.0, 0.0]]
    z = {r["series_id"]: r for r in labelled.matrices(labelled.normalise(ok, "meanstd")).collect()}
    assert z["train/NG/0001"]["matrix"] == [[0.0, 0.0], [0.0, 0.0]]
    leak = labelled.leakage(ok).collect()
    assert [(r["train_id"], r["val_id"]) for r in leak] == [("train/OK/0001", "val/OK/0001")]


def test_labelled_tree_rejects_another_header(spark, tmp_path):
    write_tree(str(tmp_path))
    (tmp_path / "val" / "OK" / "0002.csv").write_text("ID,X2,X1\n1,2.0,1.0")
    with pytest.raises(Exception, match="(?i)header"):
        labelled.scan_tree(spark, str(tmp_path)).collect()


def test_csv_roundtrip(spark, tmp_path):
    from tsforge.operators import calendar
    from tsforge.sources import csv as csvsrc
    from tsforge.sources import sinks

    p = tmp_path / "s.csv"
    p.write_text("date,temperature\n2023-01-01,1.5\n2023-01-02,NaN\n2023-01-04,3.0")
    raw = csvsrc.read_csv_series(spark, str(p), "date", "temperature")
    g = calendar.regularize(raw, "D")
    assert [r["value"] for r in g.orderBy("pos").collect()] == [1.5, None, None, 3.0]
    out = str(tmp_path / "out")
    sinks.save(g, out, "parquet")
    back = spark.read.parquet(out)
    assert back.count() == 4 and "temperature" in back.columns


def test_workflows_and_exports(spark, tmp_path, multi_long):
    from tsforge.plans import relationships, stationarity as st_flow
    from tsforge.sources import sinks

    res = relationships.analyze(multi_long, ccf_pair=("temperature", "humidity"),
                                granger_pair=("pressure", "wind_speed"), coint_pair=("temperature", "pressure"))
    assert res["choice"].collect()[0]["method"] == "pca"
    assert {r["var"] for r in res["handled"].select("var").distinct().collect()} == {"PC1", "PC2", "PC3"}
    assert res["processing_log"].collect()[0]["n_components"] == 3.0
    out = str(tmp_path / "processed.csv")
    sinks.export_processed(res["handled"], res["processing_log"], out)
    assert spark.read.option("header", True).csv(str(tmp_path / "processed_processing")).count() == 1

    st = st_flow.run(multi_long)
    led = {r["var"]: r["transformation"] for r in st["ledger"].collect()}
    assert led == {"temperature": "log", "humidity": "log", "pressure": "seasonal_diff_12",
                   "wind_speed": "seasonal_diff_12"}
    st_flow.export(st, str(tmp_path / "transformed.csv"))
    t = spark.read.option("header", True).csv(str(tmp_path / "transformed_transformations"))
    assert t.count() == 4 and set(t.columns) >= {"column", "transformation"}


def test_streaming_adapter(spark, tmp_path):
    """foreachBatch adapter: a batch operator applied to each micro-batch of a file stream."""
    from tsforge.operators import detect
    from tsforge.streaming import apply_per_batch

    src = tmp_path / "in"
    rows = [("s", "v", None, i, float(i % 7)) for i in range(40)]
    spark.createDataFrame(rows, "series_id string, var string, ts timestamp_ntz, pos long, value double") \
        .write.parquet(str(src / "part1"))
    schema = spark.read.parquet(str(src / "part1")).schema
    stream = spark.readStream.schema(schema).parquet(str(src / "part1"))
    q = apply_per_batch(stream, lambda b: detect.missing(b, 1), str(tmp_path / "out"), str(tmp_path / "ckpt"),
                        trigger_once=True)
    q.awaitTermination(120)
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == 40 and out.filter("is_missing").count() == 6 and "batch_id" in out.columns
    # a batch that runs again (here with a new checkpoint) replaces its own rows
    apply_per_batch(stream, lambda b: detect.missing(b, 1), str(tmp_path / "out"), str(tmp_path / "ckpt2"),
                    trigger_once=True).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 40
