"""Lag-product sums on the chunked scan — the shared pass behind ACF, PACF,
KPSS / Phillips-Perron long-run variances and cross-correlation.

``lag_sums`` returns one row per ``(series_id, var, lag)`` with
``s = Σ_t x_t · y_{t-lag}`` over pairs where both are non-null and ``n_pairs`` =
number of such pairs, for lags 0..maxlag, from one pass over the data: rows
carry a halo of ``maxlag`` predecessors into their chunk, each chunk returns
its sums of all lags as one array (a correlation by FFT), and the arrays are
added up per series.  Neither the plan nor a task's work per lag grows with
the number of lags.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.operators import scan
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS


def correlation(x: np.ndarray, y: np.ndarray, maxlag: int) -> np.ndarray:
    """Σ_t x_t y_{t-k} for k = 0..maxlag, by FFT."""
    size = 1 << (len(x) + maxlag).bit_length()
    return np.fft.irfft(np.fft.rfft(x, size) * np.conj(np.fft.rfft(y, size)), size)[: maxlag + 1]


def lag_products(x: np.ndarray, y: np.ndarray, home: np.ndarray, maxlag: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums and numbers of the pairs (home row t, row t - k) without NaN, k = 0..maxlag."""
    okx, oky = home & ~np.isnan(x), ~np.isnan(y)
    s = correlation(np.where(okx, x, 0.0), np.where(oky, y, 0.0), maxlag)
    n = np.rint(correlation(okx.astype(float), oky.astype(float), maxlag)).astype(np.int64)
    return s, n


def on_grid(pos: np.ndarray, *columns: np.ndarray) -> list[np.ndarray]:
    """Columns on the positions pos[0]..pos[-1]; absent positions are NaN (False)."""
    at = pos - pos[0]
    out = []
    for c in columns:
        full = np.zeros(at[-1] + 1, bool) if c.dtype == bool else np.full(at[-1] + 1, np.nan)
        full[at] = c
        out.append(full)
    return out


def summed(parts: DataFrame, keys, arrays: dict[str, str]) -> DataFrame:
    """(keys, lag, ..): element-wise sums of the array columns ``arrays`` (name -> output name) per ``keys``."""
    zipped = F.arrays_zip(*arrays)
    rows = parts.select(*keys, F.posexplode(zipped).alias("lag", "_v"))
    return rows.groupBy(*keys, F.col("lag").cast("bigint").alias("lag")).agg(
        *[F.sum(F.col("_v")[a]).alias(out) for a, out in arrays.items()])


def lag_sums(
    df: DataFrame,
    maxlag: int,
    x: str = "value",
    y: str | None = None,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    keys=KEYS,
) -> DataFrame:
    y = y or x
    maxlag, keys = int(maxlag), list(keys)
    h = scan.with_halo(df.select(*keys, "pos", *dict.fromkeys([x, y])), before=maxlag, after=0, chunk_rows=chunk_rows)

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        a, b = (pdf[c].to_numpy(dtype="float64", na_value=np.nan) for c in (x, y))
        a, b, home = on_grid(pdf["pos"].to_numpy(dtype=np.int64), a, b, pdf[scan.HOME].to_numpy(dtype=bool))
        s, n = lag_products(a, b, home, maxlag)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, "_s": [s], "_n": [n]})

    schema = T.StructType([h.schema[k] for k in keys]).add("_s", T.ArrayType(T.DoubleType())).add(
        "_n", T.ArrayType(T.LongType()))
    out = summed(h.groupBy(*keys, scan.CHUNK).applyInPandas(part, schema), keys, {"_s": "s", "_n": "n_pairs"})
    return out.withColumn("s", F.when(F.col("n_pairs") > 0, F.col("s")))


def centred(df: DataFrame, value: str = "value", out: str = "_e", keys=KEYS) -> DataFrame:
    """Add ``out = value - mean(value)`` per series, and ``_n`` = row count, ``_mu`` = mean."""
    st = df.groupBy(*keys).agg(F.avg(value).alias("_mu"), F.count(F.lit(1)).alias("_n"))
    return df.join(st, on=keys, how="inner").withColumn(out, F.col(value) - F.col("_mu"))
