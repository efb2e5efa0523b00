"""Kendall tau-b (J3), exact, without emitting pairs of rows.

``S = Σ sign(x_i - x_j)·sign(y_i - y_j)`` over pairs of points.  Points are
first combined to ``(x, y, count)``.  By sample sort and running sums the
values of x (and of y) are cut into chunks of about ``chunk_rows`` rows; a
value with more rows than that is a chunk of its own.  A pair is counted where
its points part:

* in one y-chunk: by merge counting inside that chunk; a chunk of one value has
  nothing to count, so ties of any size cost nothing;
* in one x-chunk but different y-chunks: by merge counting inside the x-chunk;
* in different chunks of both: the chunk numbers are written in base ``FAN``
  and the counts per (x-chunk, y-chunk) cell are summed for each pair of digits
  at which the two numbers first differ; a task sees at most FAN² cells.

``tau_b = S / sqrt((n0 - n1)(n0 - n2))`` with the tie corrections from value
counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.functions.expr import sdiv
from tsforge.operators import relations, scan
from tsforge.plans.materialize import cut

G = ["series_id", "var1", "var2"]
FAN_BITS = 6
CHUNK_ROWS = 65_536


def pair_sign_sum(x: np.ndarray, y: np.ndarray, count: np.ndarray | None = None) -> int:
    """Σ_{i<j} c_i c_j sign(x_i-x_j)·sign(y_i-y_j): merge counting over the binary
    digits of the rank of x.  At each digit the points whose higher digits agree
    are a group in order of y, and each point with a 1 meets the points with a 0
    that have a smaller (and a greater) y."""
    m = len(x)
    if m < 2:
        return 0
    c = np.ones(m, dtype=np.int64) if count is None else np.asarray(count, dtype=np.int64)
    order = np.argsort(y, kind="stable")
    rank, c = np.unique(x, return_inverse=True)[1][order], c[order]
    level = np.unique(y, return_inverse=True)[1][order]
    total = 0
    for bit in range(int(rank.max()).bit_length() - 1, -1, -1):
        # points of a group stand together, in order of y
        place = np.argsort(rank >> (bit + 1), kind="stable")
        group, one = rank[place] >> (bit + 1), (rank[place] >> bit & 1).astype(bool)
        w, lv = c[place], level[place]
        zeros = np.concatenate([[0], np.cumsum(np.where(one, 0, w))])
        new_group = np.concatenate([[True], group[1:] != group[:-1]])
        new_tie = new_group | np.concatenate([[True], lv[1:] != lv[:-1]])
        tie = np.flatnonzero(new_tie)
        tie_no = np.cumsum(new_tie) - 1
        start = np.flatnonzero(new_group)
        group_no = np.cumsum(new_group) - 1
        tie_end, group_end = np.append(tie[1:], m), np.append(start[1:], m)
        below = zeros[tie[tie_no]] - zeros[start[group_no]]
        above = zeros[group_end[group_no]] - zeros[tie_end[tie_no]]
        total += int(((below - above) * w)[one].sum())
    return total


def cell_sign_sum(x: np.ndarray, y: np.ndarray, count: np.ndarray, fan: int) -> int:
    """The same sum from counts of cells (x, y), both in 0..fan-1."""
    h = np.zeros((fan, fan), dtype=np.int64)
    np.add.at(h, (x, y), count)
    before = np.cumsum(h, axis=0) - h  # of smaller x
    below = np.cumsum(before, axis=1) - before
    above = before.sum(axis=1, keepdims=True) - below - before
    return int((h * (below - above)).sum())


def _value_chunks(points: DataFrame, col: str, out: str, chunk_rows: int) -> tuple[DataFrame, DataFrame]:
    """``points`` with the chunk of ``col`` (even: some values, odd: one value with many rows), and the value counts."""
    values = points.groupBy(*G, col).agg(F.count(F.lit(1)).cast("double").alias("_rows"), F.sum("c").alias("t"))
    numbered = cut(scan.number_rows(values, G, [col]))
    placed = scan.running_sum(numbered, "_rows", "_upto", keys=G)
    start = (F.col("_upto") - F.col("_rows")).cast("bigint")
    big = (F.col("_rows") > chunk_rows).cast("bigint")
    chunks = cut(placed.select(*G, col, "t", (F.floor(start / F.lit(chunk_rows)) * 2 + big).cast("bigint").alias(out)))
    return points.join(chunks.drop("t"), on=[*G, col]), chunks


def kendall(df: DataFrame, vars_: list[str] | None = None, chunk_rows: int = CHUNK_ROWS,
            fan_bits: int = FAN_BITS) -> DataFrame:
    """Pairwise-complete Kendall tau-b for every variable pair of each series:
    ``series_id, var1, var2, n, tau``."""
    vars_ = vars_ or relations.variables(df)
    w = relations.wide(df, vars_)
    pairs = [F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), F.col(a).alias("x"), F.col(b).alias("y"))
             for i, a in enumerate(vars_) for b in vars_[i + 1:]]
    points = w.select("series_id", F.explode(F.array(*pairs)).alias("p")).select("series_id", "p.*").dropna(
        subset=["x", "y"]).groupBy(*G, "x", "y").agg(F.count(F.lit(1)).alias("c"))
    points = cut(points)
    both, x_values = _value_chunks(points, "x", "xc", chunk_rows)
    both, y_values = _value_chunks(both, "y", "yc", chunk_rows)
    both = cut(both)

    schema = "series_id string, var1 string, var2 string, s long"

    def counted(x: str, y: str):
        def f(pdf: pd.DataFrame) -> pd.DataFrame:
            s = pair_sign_sum(pdf[x].to_numpy(), pdf[y].to_numpy(), pdf["c"].to_numpy())
            return pd.DataFrame({**{g: [pdf[g].iloc[0]] for g in G}, "s": [s]})
        return f

    some = lambda chunk: both.filter(F.col(chunk) % 2 == 0).groupBy(*G, chunk)
    s = some("yc").applyInPandas(counted("x", "y"), schema).unionByName(
        some("xc").applyInPandas(counted("x", "yc"), schema))

    cells = cut(both.groupBy(*G, "xc", "yc").agg(F.sum("c").alias("c")))
    top = cells.agg(F.max(F.greatest("xc", "yc"))).first()[0] or 0  # digits of the largest chunk number
    fan = 1 << fan_bits

    def in_cells(pdf: pd.DataFrame) -> pd.DataFrame:
        s = cell_sign_sum(pdf["dx"].to_numpy(), pdf["dy"].to_numpy(), pdf["c"].to_numpy(), fan)
        return pd.DataFrame({**{g: [pdf[g].iloc[0]] for g in G}, "s": [s]})

    digits = range(-(-int(top).bit_length() // fan_bits))
    for i in digits:
        for j in digits:
            part = cells.groupBy(*G, F.shiftright("xc", fan_bits * (i + 1)).alias("gx"),
                                 F.shiftright("yc", fan_bits * (j + 1)).alias("gy"),
                                 F.shiftright("xc", fan_bits * i).bitwiseAND(F.lit(fan - 1)).alias("dx"),
                                 F.shiftright("yc", fan_bits * j).bitwiseAND(F.lit(fan - 1)).alias("dy")).agg(
                F.sum("c").alias("c"))
            s = s.unionByName(part.groupBy(*G, "gx", "gy").applyInPandas(in_cells, schema))
    s = s.groupBy(*G).agg(F.sum("s").alias("S"))
    t = F.col("t").cast("double")
    ties = lambda values, out: values.groupBy(*G).agg(
        F.sum("t").alias(f"n_{out}"), F.sum(t * (t - 1) / 2).alias(out))
    r = ties(x_values, "n1").join(ties(y_values, "n2"), on=G).join(s, on=G, how="left").withColumn(
        "n0", F.col("n_n1") * (F.col("n_n1") - 1) / 2)
    tau = sdiv(F.coalesce("S", F.lit(0)).cast("double"), F.sqrt((F.col("n0") - F.col("n1")) * (F.col("n0") - F.col("n2"))))
    return r.select(*G, F.col("n_n1").alias("n"), tau.alias("tau"))
