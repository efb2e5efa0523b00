"""Spectral operators (K1-K5): DFT, inverse, frequency axis, amplitude, round trip.

The spectrum of a series of length ``n = n1·n2`` is computed with the
four-step decomposition, as two grouped FFT stages:

1. group by residue ``r = pos mod n1`` → size-``n2`` FFT of ``x[r + n1·j]``;
   multiply by the twiddle ``exp(-2πi·r·k2/n)``;
2. group by ``k2`` → size-``n1`` FFT over ``r``; output index ``k = k2 + n2·k1``.

Every group holds about √n points, so one very long series is spread over
~2√n tasks; short series (e.g. 64-step embeddings) are one row each and are
transformed whole, many rows of a length at once.
``n1`` is the largest divisor of ``n`` not above √n.  Where no divisor is near
√n (prime lengths) the transform is a convolution with a chirp of ``n``
points, padded to a power of two, whose own three transforms split evenly.
Complex values are ``re, im`` columns.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.plans.materialize import cut
from tsforge.spec import KEYS

SPEC_SCHEMA = "series_id string, var string, n long, k long, re double, im double"
STAGE_SCHEMA = "series_id string, var string, n long, n1 long, r long, k2 long, re double, im double"

# Series up to this length are transformed whole, many series per task.
SHORT_MAX = 1 << 16
# Four-step splits with n2 > UNEVEN·n1 go through the chirp convolution.
UNEVEN = 64
# Positions that one row of a generated index range stands for.
RANGE_CHUNK = 1 << 16


def split_factor(n: int) -> int:
    """Largest divisor of n that is <= sqrt(n)."""
    for d in range(int(math.isqrt(n)), 0, -1):
        if n % d == 0:
            return d
    return 1


def padded_length(n: int) -> int:
    """Smallest power of two that holds a linear convolution of n points."""
    return 1 << (2 * n - 2).bit_length()


def _complex(pdf: pd.DataFrame) -> np.ndarray:
    return pdf["re"].to_numpy(dtype="float64") + 1j * pdf["im"].to_numpy(dtype="float64")


def _frame(pdf: pd.DataFrame, X: np.ndarray, **cols) -> pd.DataFrame:
    return pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "var": pdf["var"].iloc[0], **cols, "re": X.real,
                         "im": X.imag})


def _whole(d: DataFrame) -> DataFrame:
    """Series of (series_id, var, n, pos, re, im) transformed whole: a series is one row
    with its points as an array, an Arrow batch of rows is transformed length by length."""
    rows = d.groupBy(*KEYS, "n").agg(F.array_sort(F.collect_list(F.struct("pos", "re", "im"))).alias("p")).select(
        *KEYS, "n", F.col("p.re").alias("re"), F.col("p.im").alias("im"))

    def each(batches):
        import pyarrow as pa

        for b in batches:
            re, im = b.column("re"), b.column("im")
            at, n = re.offsets.to_numpy(), np.diff(re.offsets.to_numpy())
            x = re.flatten().to_numpy(zero_copy_only=False) + 1j * im.flatten().to_numpy(zero_copy_only=False)
            at = at - at[0]
            out = np.empty_like(x)
            for size in np.unique(n):
                place = at[:-1][n == size][:, None] + np.arange(size)
                out[place] = np.fft.fft(x[place], axis=1)
            lists = [pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(part)) for part in (out.real, out.imag)]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in (*KEYS, "n")), *lists], names=[*KEYS, "n", "re", "im"])

    out = rows.mapInArrow(each, "series_id string, var string, n long, re array<double>, im array<double>")
    return out.select(*KEYS, "n", F.posexplode(F.arrays_zip("re", "im")).alias("k", "x")).select(
        *KEYS, "n", F.col("k").cast("bigint").alias("k"), "x.re", "x.im")


def _split(d: DataFrame) -> DataFrame:
    """Four-step transform of (series_id, var, n, n1, pos, re, im); a position without a row is zero."""
    d = d.withColumn("r", F.expr("pos % n1")).withColumn("j", F.expr("pos div n1"))

    def stage1(pdf: pd.DataFrame) -> pd.DataFrame:
        n, n1, r = int(pdf["n"].iloc[0]), int(pdf["n1"].iloc[0]), int(pdf["r"].iloc[0])
        x = np.zeros(n // n1, dtype=complex)
        x[pdf["j"].to_numpy()] = _complex(pdf)
        k2 = np.arange(len(x))
        X = np.fft.fft(x) * np.exp(-2j * np.pi * r * k2 / n)
        return _frame(pdf, X, n=n, n1=n1, r=r, k2=k2)

    def stage2(pdf: pd.DataFrame) -> pd.DataFrame:
        n, n1, k2 = int(pdf["n"].iloc[0]), int(pdf["n1"].iloc[0]), int(pdf["k2"].iloc[0])
        x = np.zeros(n1, dtype=complex)
        x[pdf["r"].to_numpy()] = _complex(pdf)
        X = np.fft.fft(x)
        return _frame(pdf, X, n=n, k=k2 + n // n1 * np.arange(n1))

    columns = d.groupBy(*KEYS, "r").applyInPandas(stage1, STAGE_SCHEMA)
    return columns.groupBy(*KEYS, "k2").applyInPandas(stage2, SPEC_SCHEMA)


def _chirp(index: str, sign: float):
    """re and im of exp(sign·iπ·index²/n), the square taken modulo 2n to stay exact."""
    a = F.expr(f"({index} * {index}) % (2 * n)") * math.pi / F.col("n")
    return F.cos(a), sign * F.sin(a)


def _times(a: tuple, b: tuple):
    return a[0] * b[0] - a[1] * b[1], a[0] * b[1] + a[1] * b[0]


def _convolved(d: DataFrame) -> DataFrame:
    """Transforms of lengths without an even split, by chirp convolution:
    X_k = w_k · Σ_j (x_j·w_j) · conj(w_{k-j}) with w_j = exp(-iπj²/n).  ``d`` is
    (series_id, var, n, m, m1, pos, re, im), m the padded length and m1 its split."""
    length = F.col("m").alias("n"), F.col("m1").alias("n1")
    re, im = _times((F.col("re"), F.col("im")), _chirp("pos", -1.0))
    a = _split(d.select(*KEYS, *length, "pos", re.alias("re"), im.alias("im")))
    # the kernel depends on the length only: one for all series of a length
    lengths = d.select("n", "m", "m1").distinct()
    chunks = lengths.withColumn("c", F.explode(F.expr(f"sequence(0L, (n - 1) div {RANGE_CHUNK})")))
    index = chunks.withColumn("j", F.explode(F.expr(
        f"sequence(c * {RANGE_CHUNK}, least(n, (c + 1) * {RANGE_CHUNK}) - 1)")))
    cre, cim = _chirp("j", 1.0)
    both = index.withColumn("re", cre).withColumn("im", cim).withColumn(
        "pos", F.explode(F.expr("IF(j = 0, array(j), array(j, m - j))")))
    kernel = _split(both.select(F.col("n").cast("string").alias("series_id"), F.lit("").alias("var"), *length, "pos",
                                "re", "im")).select(
        F.col("series_id").cast("long").alias("own"), "k", F.col("re").alias("bre"), F.col("im").alias("bim"))
    own = d.groupBy(*KEYS).agg(F.first("n").alias("own"), F.first("m1").alias("m1"))
    re, im = _times((F.col("re"), F.col("im")), (F.col("bre"), F.col("bim")))
    product = a.withColumnRenamed("n", "m").join(own, on=KEYS).join(kernel, on=["own", "k"])
    # inverse of the product: conj(transform(conj)) / m, cut to n and multiplied by w_k
    back = _split(product.select(*KEYS, F.col("m").alias("n"), F.col("m1").alias("n1"), F.col("k").alias("pos"),
                                 re.alias("re"), (-im).alias("im")))
    back = back.withColumnRenamed("n", "m").join(own.withColumnRenamed("own", "n"), on=KEYS).filter("k < n")
    re, im = _times((F.col("re") / F.col("m"), -F.col("im") / F.col("m")), _chirp("k", -1.0))
    return back.select(*KEYS, "n", "k", re.alias("re"), im.alias("im"))


def dft(df: DataFrame, inverse: bool = False, value: str = "value", imag: str | None = None,
        short_max: int = SHORT_MAX, uneven: int = UNEVEN, keep_n: bool = False) -> DataFrame:
    """K1 (K2 with ``inverse``): DFT of each ``(series_id, var)`` over ``pos``
    (0..n-1).  Input real ``value`` (and optional imaginary column).  The
    inverse is computed by conjugation and divided by n, as the reference does.

    Short series (n <= ``short_max``) are transformed whole; longer series use
    the four-step split, or the chirp convolution where n has no even split.
    Only the ways that some length needs are planned.  ``keep_n`` leaves ``n``."""
    im_col = F.col(imag) if imag else F.lit(0.0)
    sign = -1.0 if inverse else 1.0  # inverse = conj(fft(conj(x))) / n
    d = df.select(*KEYS, "pos", F.col(value).cast("double").alias("re"), (im_col * F.lit(sign)).alias("im"))

    @F.pandas_udf("n1 long, m long, m1 long")
    def lengths(n: pd.Series) -> pd.DataFrame:
        m = n.map(lambda v: padded_length(int(v)))
        return pd.DataFrame({"n1": n.map(lambda v: split_factor(int(v))), "m": m,
                             "m1": m.map(lambda v: split_factor(int(v)))})

    sizes = cut(d.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")))
    long = sizes.filter(F.col("n") > short_max)
    short, even_, uneven_ = sizes.agg(F.max(F.col("n") <= short_max)).first()[0], False, False
    even = F.expr(f"n div n1 <= {uneven} * n1")
    if not long.isEmpty():
        long = cut(long.withColumn("s", lengths("n")).select(*KEYS, "n", "s.*"))
        even_, uneven_ = long.agg(F.max(even), F.max(~even)).first()
    parts = []
    if short or not (even_ or uneven_):
        parts.append(_whole(d.join(sizes.filter(F.col("n") <= short_max), on=KEYS)))
    if even_:
        parts.append(_split(d.join(long.filter(even), on=KEYS)))
    if uneven_:
        parts.append(_convolved(d.join(long.filter(~even), on=KEYS)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if inverse:
        out = out.withColumn("re", F.col("re") / F.col("n")).withColumn("im", -F.col("im") / F.col("n"))
    return out if keep_n else out.drop("n")


def four_step(df: DataFrame, inverse: bool = False, value: str = "value", imag: str | None = None) -> DataFrame:
    """The long-series path on its own (any length)."""
    return dft(df, inverse, value, imag, short_max=0)


def frequencies(spec: DataFrame, dt: float = 1.0) -> DataFrame:
    """K3: ``fftfreq`` axis: k/(n·dt) for k < (n+1)/2, else (k-n)/(n·dt)."""
    s = spec
    if "n" not in spec.columns:  # dft(keep_n=True) leaves it
        s = spec.join(spec.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")), on=KEYS)
    f = F.when(F.col("k") < (F.col("n") + 1) / 2, F.col("k")).otherwise(F.col("k") - F.col("n")) / (F.col("n") * F.lit(dt))
    return s.withColumn("freq", f)


def amplitude(spec: DataFrame, dt: float = 1.0) -> DataFrame:
    """K4: one-sided amplitude ``2/n·|X_k|`` for ``k < n/2`` with its frequency."""
    s = frequencies(spec, dt).filter(F.col("k") < F.col("n") / 2)
    return s.select(*KEYS, "k", "freq", (F.lit(2.0) / F.col("n") * F.sqrt(F.col("re") ** 2 + F.col("im") ** 2)).alias("amplitude"))


def roundtrip_error(df: DataFrame, value: str = "value") -> DataFrame:
    """K5: ``max |x - ifft(fft(x))|`` per series."""
    spec = dft(df, value=value)
    back = dft(spec.withColumnRenamed("k", "pos"), inverse=True, value="re", imag="im")
    j = df.select(*KEYS, "pos", F.col(value).alias("_x")).join(back.withColumnRenamed("k", "pos"), on=[*KEYS, "pos"])
    err = F.sqrt((F.col("_x") - F.col("re")) ** 2 + F.col("im") ** 2)
    return j.groupBy(*KEYS).agg(F.max(err).alias("max_abs_error"))
