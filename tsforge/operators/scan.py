"""Chunked scan: ordered per-series computation without a single-task window.

``Window.partitionBy(series_id, var).orderBy(pos)`` puts a whole series into
one task; a series that holds a third of all rows would then run on one core.
Every ordered operator in the library is instead evaluated per
``(series_id, var, chunk)`` where ``chunk = pos div chunk_rows``:

* bounded windows (lag, trailing / centred rolling frames) get a *halo*: the
  rows a chunk needs from its neighbours are duplicated into it
  (:func:`with_halo`), the window runs per chunk, halo rows are dropped;
* unbounded carries (previous / next valid value, running sums) combine a tiny
  per-chunk summary over chunks (one row per chunk) and join it back
  (:func:`valid_neighbours`, :func:`running_sum`).

``pos`` must be a dense 0..n-1 index inside ``(series_id, var)``; on a regular
calendar it is arithmetic, otherwise :func:`assign_positions` builds it by a
sample sort (:func:`number_rows`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsforge.plans.materialize import cut
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS

CHUNK = "_chunk"
HOME = "_home"


def chunk_of(pos_col: str = "pos", chunk_rows: int = DEFAULT_CHUNK_ROWS):
    return F.expr(f"{pos_col} div {int(chunk_rows)}")


def chunk_window(keys=KEYS):
    """Window over one scan chunk of one series, ordered by position."""
    return Window.partitionBy(*keys, CHUNK).orderBy("pos")


def with_chunk(df: DataFrame, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    return df.withColumn(CHUNK, chunk_of("pos", chunk_rows))


def with_halo(df: DataFrame, before: int, after: int, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Duplicate each row into every chunk whose frame [-before, +after] needs it.

    A row at ``pos`` is needed by chunks ``(pos-after) div C .. (pos+before) div C``;
    ``_home`` marks the copy in the row's own chunk.  Evaluate windows over
    :func:`chunk_window`, then call :func:`drop_halo`.
    """
    c = int(chunk_rows)
    lo = F.greatest(F.lit(0).cast("bigint"), F.expr(f"(pos - {int(after)}) div {c}"))
    hi = F.expr(f"(pos + {int(before)}) div {c}")
    return (
        df.withColumn(CHUNK, F.explode(F.sequence(lo, hi)))
        .withColumn(HOME, F.col(CHUNK) == chunk_of("pos", c))
    )


def drop_halo(df: DataFrame) -> DataFrame:
    return df.filter(F.col(HOME)).drop(CHUNK, HOME)


def rows_frame(before: int, after: int, keys=KEYS):
    return chunk_window(keys).rowsBetween(-int(before), int(after))


def valid_neighbours(
    df: DataFrame,
    value_col: str = "value",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    keys=KEYS,
    prev: str = "_prev",
    nxt: str = "_next",
) -> DataFrame:
    """Add ``prev``/``nxt`` = struct(p, v) of the nearest non-null value at or
    before / at or after each row (NULL when none exists in the series).

    Within a chunk: ``last``/``first`` ignoring nulls.  Across chunks: the
    last / first valid point of every chunk (one row per chunk) is carried
    with a window over the chunk index and joined back on ``(keys, chunk)``.
    """
    valid = F.when(F.col(value_col).isNotNull(), F.struct(F.col("pos").alias("p"), F.col(value_col).alias("v")))
    df = with_chunk(df, chunk_rows)
    # Both directions use running frames (UNBOUNDED PRECEDING .. CURRENT ROW):
    # Spark evaluates those incrementally, whereas a frame ending at UNBOUNDED
    # FOLLOWING is re-aggregated for every row (quadratic in the chunk size).
    fwd = Window.partitionBy(*keys, CHUNK).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    bwd = Window.partitionBy(*keys, CHUNK).orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_in_prev", F.last(valid, ignorenulls=True).over(fwd)).withColumn(
        "_in_next", F.last(valid, ignorenulls=True).over(bwd)
    )
    summary = df.groupBy(*keys, CHUNK).agg(F.max(valid).alias("_last"), F.min(valid).alias("_first"))
    cf = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    cb = Window.partitionBy(*keys).orderBy(F.col(CHUNK).desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *keys,
        CHUNK,
        F.last("_last", ignorenulls=True).over(cf).alias("_c_prev"),
        F.last("_first", ignorenulls=True).over(cb).alias("_c_next"),
    )
    return (
        df.join(carry, on=[*keys, CHUNK], how="left")
        .withColumn(prev, F.coalesce("_in_prev", "_c_prev"))
        .withColumn(nxt, F.coalesce("_in_next", "_c_next"))
        .drop("_in_prev", "_in_next", "_c_prev", "_c_next", CHUNK)
    )


def running_sum(
    df: DataFrame,
    value_col: str,
    out: str,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    keys=KEYS,
) -> DataFrame:
    """Cumulative sum over pos (NULLs count as 0) via chunk totals + carry."""
    x = F.coalesce(F.col(value_col), F.lit(0.0))
    df = with_chunk(df, chunk_rows)
    df = df.withColumn("_in_sum", F.sum(x).over(chunk_window(keys).rowsBetween(Window.unboundedPreceding, 0)))
    totals = df.groupBy(*keys, CHUNK).agg(F.sum(x).alias("_tot"))
    wc = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, CHUNK, F.coalesce(F.sum("_tot").over(wc), F.lit(0.0)).alias("_carry"))
    return (
        df.join(carry, on=[*keys, CHUNK], how="left")
        .withColumn(out, F.col("_in_sum") + F.col("_carry"))
        .drop("_in_sum", "_carry", CHUNK)
    )


def number_rows(df: DataFrame, keys, order, out: str = "pos", hold=cut, partitions: int | None = None) -> DataFrame:
    """Dense 0-based ``out`` per ``keys`` in the order of ``order`` (names: nulls
    last, or sort-order columns), by sample sort.

    Spark samples cut points over (keys, order, content hash), so a key that
    holds most of the rows, or a time that most rows share, is spread over as
    many ranges as it fills; rows are counted per range and key, numbered inside
    their range, and shifted by the rows of their key in earlier ranges.  Only
    keys that lie in several ranges have a shift, so that table has fewer rows
    than there are ranges.  Rows that are equal in all columns stay together,
    in any order.  ``hold`` materialises the ranges (their cut points are sampled).
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(c).asc_nulls_last() if isinstance(c, str) else c for c in order]
    plain = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    tied = df.withColumn("_tie", F.xxhash64(*plain))
    ranged = hold(tied.repartitionByRange(n, *keys, *by, "_tie").withColumn("_range", F.spark_partition_id()))
    counts = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.withColumn("_shift", before).filter(F.col("_shift").isNotNull()).select(
        *[F.col(k).alias(f"_s_{k}") for k in keys], F.col("_range").alias("_s_range"), "_shift")
    same = F.col("_range") == F.col("_s_range")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_s_{k}"))
    inside = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*by, "_tie")) - 1
    return (
        ranged.withColumn("_inside", inside)
        .join(F.broadcast(shift), same, "left")
        .withColumn(out, (F.col("_inside") + F.coalesce("_shift", F.lit(0))).cast("bigint"))
        .drop("_inside", "_shift", "_s_range", "_range", "_tie", *[f"_s_{k}" for k in keys])
    )


def assign_positions(df: DataFrame, order_cols=("ts",), keys=KEYS) -> DataFrame:
    """Dense ``pos`` (0-based) per ``keys`` ordered by ``order_cols``; rows without a time come last."""
    return number_rows(df, list(keys), list(order_cols))
