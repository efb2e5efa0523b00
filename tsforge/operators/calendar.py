"""Regular calendars (B4) and resampling.

* :func:`regularize` — the ``asfreq`` equivalent: a grid from the first to the
  last timestamp of each series with a fixed step; observations off the grid
  are dropped, grid points without an observation get NULL.  The grid is
  generated in chunks (``sequence`` over chunk ids, then over the positions
  of one chunk), so no row ever holds a whole series.
* :func:`downsample` — bucket aggregation with pandas-style labels
  (D = day start, W = Sunday ending the week, M/Q/Y = period end); empty
  buckets between the first and last are present (NULL, or 0 for sums).
* :func:`upsample` — :func:`regularize` to a finer step, then forward fill or
  linear interpolation.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators import scan
from tsforge.plans.materialize import cut
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS, LONG_COLUMNS

# Fixed step lengths in microseconds for the pandas aliases the reference accepts.
_STEP_MICROS = {"S": 1_000_000, "T": 60_000_000, "MIN": 60_000_000, "H": 3_600_000_000, "D": 86_400_000_000}


def step_micros(freq: str) -> int:
    m = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", freq or "")
    if not m or m.group(2).upper() not in _STEP_MICROS:
        raise ValueError(f"unsupported frequency {freq!r}; use [n]S, [n]T, [n]H or [n]D")
    return int(m.group(1) or 1) * _STEP_MICROS[m.group(2).upper()]


def regularize(
    df: DataFrame,
    freq: str = "D",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    span_keys=("series_id",),
    duplicates: str = "error",
) -> DataFrame:
    """Put every ``(series_id, var)`` on the grid ``t0 + k*step`` (t0/t1 per ``span_keys``).

    Input: long frame ``series_id, var, ts, value`` (``pos`` ignored).
    Output: canonical long frame with dense ``pos`` = k.  Several rows of a
    ``(series_id, var)`` at one timestamp raise when the plan runs, or are
    combined by ``duplicates`` = "mean", "sum", "min" or "max".
    """
    step = step_micros(freq)
    span_keys = list(span_keys)
    span = df.groupBy(*span_keys).agg(F.min("ts").alias("_t0"), F.max("ts").alias("_t1"))
    n = F.timestamp_diff("MICROSECOND", F.col("_t0"), F.col("_t1")) / F.lit(step)
    spec = (
        df.select(*KEYS).distinct()
        .join(span, on=span_keys, how="inner")
        .withColumn("_n", F.floor(n).cast("bigint") + 1)
    )
    c = int(chunk_rows)
    # Chunk ids are few (n / chunk_rows); spread them over the shuffle
    # partitions before generating positions so a long series' grid is
    # produced by many tasks.  The count is explicit so AQE does not coalesce
    # the (byte-wise tiny) chunk table back into one partition.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    grid = (
        spec.withColumn("_c", F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(_n - 1) div {c}"))))
        .repartition(parts, *KEYS, "_c")
        .withColumn(
            "pos",
            F.explode(F.sequence(F.col("_c") * c, F.least((F.col("_c") + 1) * c, F.col("_n")) - 1)),
        )
        .select(*KEYS, "pos", F.timestamp_add("MICROSECOND", F.col("pos") * F.lit(step), F.col("_t0")).alias("ts"))
    )
    d = F.timestamp_diff("MICROSECOND", F.col("_t0"), F.col("ts"))
    data = (
        df.join(span.select(*span_keys, "_t0"), on=span_keys, how="inner")
        .filter(d % F.lit(step) == 0)
        .select(*KEYS, (d / F.lit(step)).cast("bigint").alias("pos"), F.col("value").cast("double").alias("value"))
    )
    if duplicates not in ("error", "mean", "sum", "min", "max"):
        raise ValueError("duplicates must be error, mean, sum, min or max")
    if duplicates == "error":
        one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("duplicate timestamps in a series; pass duplicates=")).cast(
            "double")).otherwise(F.max("value"))
    else:
        one = {"mean": F.avg, "sum": F.sum, "min": F.min, "max": F.max}[duplicates]("value")
    # grouped by the join's own keys: no further exchange
    data = data.groupBy(*KEYS, "pos").agg(one.alias("value"))
    return grid.join(data, on=[*KEYS, "pos"], how="left").select(*LONG_COLUMNS)


# ---------------------------------------------------------------- downsampling

RULES = ("D", "W", "M", "Q", "Y")


def bucket_label(ts_col, rule: str):
    """Date label of the pandas resample bucket holding ``ts`` (as a DATE)."""
    d = F.to_date(ts_col)
    rule = rule.upper()
    if rule == "D":
        return d
    if rule == "W":
        return F.next_day(F.date_sub(d, 1), "Sun")
    if rule == "M":
        return F.last_day(d)
    if rule == "Q":
        return F.last_day(F.add_months(F.trunc(d, "quarter"), 2))
    if rule in ("Y", "A"):
        return F.make_date(F.year(d), F.lit(12), F.lit(31))
    raise ValueError(f"unsupported downsample rule {rule!r}; use one of {RULES}")


def _bucket_index(label, rule: str):
    """Integer index of a bucket label (consecutive buckets differ by 1)."""
    rule = rule.upper()
    if rule == "D":
        return F.datediff(label, F.lit("1970-01-01").cast("date")).cast("bigint")
    if rule == "W":
        return F.floor(F.datediff(label, F.lit("1970-01-04").cast("date")) / 7).cast("bigint")
    months = F.year(label) * 12 + F.month(label) - 1
    if rule == "M":
        return months.cast("bigint")
    if rule == "Q":
        return F.floor(months / 3).cast("bigint")
    return F.year(label).cast("bigint")


def _label_of_index(idx, rule: str):
    rule = rule.upper()
    if rule == "D":
        return F.date_add(F.lit("1970-01-01").cast("date"), idx.cast("int"))
    if rule == "W":
        return F.date_add(F.lit("1970-01-04").cast("date"), (idx * 7).cast("int"))
    if rule == "M":
        return F.last_day(F.make_date((idx / 12).cast("int"), (idx % 12 + 1).cast("int"), F.lit(1)))
    if rule == "Q":
        m = idx * 3 + 2
        return F.last_day(F.make_date((m / 12).cast("int"), (m % 12 + 1).cast("int"), F.lit(1)))
    return F.make_date(idx.cast("int"), F.lit(12), F.lit(31))


_AGGS = {0: "mean", 1: "sum", 2: "max", 3: "min", "mean": "mean", "sum": "sum", "max": "max", "min": "min"}


def downsample(df: DataFrame, rule: str = "D", method=0, exact: bool = False) -> DataFrame:
    """Aggregate into calendar buckets; one output row per bucket between the
    first and last bucket of each ``(series_id, var)``.

    ``method``: 0/mean, 1/sum (empty bucket = 0), 2/max, 3/min.  Sums are
    double sums.  With ``exact`` they accumulate in DECIMAL(38,10) and so don't
    depend on the summation order; that is for values of at most ten decimals
    below 1e28 only (prices and the like): others lose digits or raise.
    """
    if method not in _AGGS:
        raise ValueError(f"unsupported downsample method {method!r}")
    how = _AGGS[method]
    rule = rule.upper()
    label = bucket_label(F.col("ts"), rule)
    x = F.col("value")
    if exact:
        tot = F.sum(x.cast("decimal(38,10)")).cast("double")
        agg = {"mean": tot / F.count(x), "sum": tot, "max": F.max(x), "min": F.min(x)}[how]
    else:
        agg = {"mean": F.avg(x), "sum": F.sum(x), "max": F.max(x), "min": F.min(x)}[how]
    b = (
        df.withColumn("_lab", label)
        .withColumn("_k", _bucket_index(F.col("_lab"), rule))
        .groupBy(*KEYS, "_k")
        .agg(agg.alias("value"))
    )
    rng = b.groupBy(*KEYS).agg(F.min("_k").alias("_k0"), F.max("_k").alias("_k1"))
    # spread the (small) per-series range table before exploding bucket labels
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    grid = rng.repartition(parts, *KEYS).select(*KEYS, "_k0", F.explode(F.sequence("_k0", "_k1")).alias("_k"))
    out = grid.join(b, on=[*KEYS, "_k"], how="left")
    value = F.coalesce("value", F.lit(0.0)) if how == "sum" else F.col("value")
    return out.select(
        *KEYS,
        F.to_timestamp_ntz(_label_of_index(F.col("_k"), rule).cast("string")).alias("ts"),
        (F.col("_k") - F.col("_k0")).cast("bigint").alias("pos"),
        value.cast("double").alias("value"),
    )


# ---------------------------------------------------------------- upsampling

_UP = {0: "ffill", 1: "linear", 2: "quadratic", "ffill": "ffill", "linear": "linear", "quadratic": "quadratic"}


def upsample(df: DataFrame, rule: str = "H", method=0, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Regularise to the finer ``rule`` grid and fill the new points."""
    if method not in _UP:
        raise ValueError(f"unsupported upsample method {method!r}")
    from tsforge.operators import fill

    g = regularize(df, rule, chunk_rows)
    how = _UP[method]
    if how == "ffill":
        return forward_fill(g, chunk_rows)
    if how == "linear":
        return fill.linear(g, chunk_rows=chunk_rows)
    return fill.spline(cut(g), degree=2, chunk_rows=chunk_rows, extrapolate=False, use_ts=True)


def forward_fill(df: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    cols = df.columns
    d = scan.valid_neighbours(df, "value", chunk_rows)
    return d.withColumn("value", F.coalesce(F.col("value"), F.col("_prev.v"))).select(*cols)
