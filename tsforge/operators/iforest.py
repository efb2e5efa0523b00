"""Isolation forest for univariate series (C4), re-aimed as Spark jobs.

1. Count: valid points and last position of every series (partial aggregation).
2. Pool: the ``n_trees · max_samples`` points of a series with the smallest
   hash of (series, var, pos, seed), one hash a point.  A threshold from the count
   lets about that many points out of the scan, so no task ever sees more of a
   series; the exact bottom is taken where the forest grows.
3. Grow: every tree draws its points from the pool without replacement, so it
   has a uniform sample of the series.  In one dimension a tree is a step
   function (interval → path length), hence the forest too: the trees are
   added up to one sorted list of cut points (≤ trees × leaves) with the score
   ``2^(-mean path / c(ψ))`` between them.
4. Score: blocks of ``SCORE_ROWS`` points meet their series' steps in a
   co-grouped Arrow task and are looked up by ``searchsorted``; all columns of a
   point travel along, so nothing is joined back.
5. Flag: points whose score exceeds the exact ``1 - contamination`` quantile
   of their series' scores (a series has no more distinct scores than steps).
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators import scan
from tsforge.operators.quantile import exact_quantiles
from tsforge.plans.materialize import cut
from tsforge.spec import KEYS

EULER = 0.5772156649015329
#: Points of a scoring group; a series' steps (≤ 16 bytes × trees × leaves) are copied to each.
SCORE_ROWS = 1 << 20


def c_factor(n: float) -> float:
    """Average path length of an unsuccessful BST search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def grow_tree(values: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Cut points (sorted) of one tree and the path lengths of the intervals between them."""
    limit = math.ceil(math.log2(max(len(values), 2)))
    cuts, paths = [], []
    todo = [(np.sort(values), 0)]
    while todo:  # left to right
        v, depth = todo.pop()
        if isinstance(v, float):
            cuts.append(v)
        elif depth >= limit or v[0] == v[-1]:
            paths.append(depth + c_factor(len(v)))
        else:
            u = rng.random()
            s = min(max(v[0] * (1.0 - u) + v[-1] * u, np.nextafter(v[0], np.inf)), v[-1])
            i = int(np.searchsorted(v, s, side="left"))
            todo += [(v[i:], depth + 1), (float(s), 0), (v[:i], depth + 1)]
    return np.array(cuts), np.array(paths)


def grow_forest(pool: np.ndarray, n_trees: int, max_samples: int, rng: np.random.Generator):
    """The trees, and the size of their samples."""
    psi = min(int(max_samples), len(pool))
    return [grow_tree(rng.choice(pool, psi, replace=False), rng) for _ in range(n_trees)], psi


def forest_steps(trees, psi: int) -> tuple[np.ndarray, np.ndarray]:
    """Cut points of the whole forest and the scores of the intervals between them."""
    cuts = np.unique(np.concatenate([c for c, _ in trees]))
    mean = sum(p[np.concatenate([[0], np.searchsorted(c, cuts, side="right")])] for c, p in trees) / len(trees)
    c = c_factor(psi)
    return cuts, np.power(2.0, -mean / c) if c > 0 else np.full(len(mean), 0.5)


def isolation_forest(
    df: DataFrame,
    contamination: float = 0.05,
    n_trees: int = 100,
    max_samples: int = 256,
    seed: int = 42,
    out: str = "is_outlier",
    chunk_rows: int = SCORE_ROWS,
    keep_score: bool = False,
) -> DataFrame:
    if not 0 < contamination < 0.5:
        raise ValueError("contamination must be in (0, 0.5)")
    if n_trees < 1 or max_samples < 1:
        raise ValueError("n_trees and max_samples must be positive")
    cols, pool_rows = df.columns, int(n_trees) * int(max_samples)
    df = cut(df)  # read three times: counts, pool, scores
    finite = F.col("value").isNotNull() & ~F.isnan("value") & (F.abs("value") < F.lit(float("inf")))
    sizes = df.groupBy(*KEYS).agg(F.count(F.when(finite, 1)).alias("_n"), F.max("pos").alias("_last"))
    # six deviations above the wanted number: fewer come out only with probability 1e-9
    share = F.try_divide(F.lit(pool_rows + 6.0 * math.sqrt(pool_rows) + 36.0), F.col("_n"))
    u = F.xxhash64("series_id", "var", "pos", F.lit(seed)).cast("double") / 2.0**64 + 0.5
    pool = df.filter(finite).select(*KEYS, "value", u.alias("_u")).join(sizes, on=KEYS).filter(F.col("_u") < share)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_u", "value"]).head(pool_rows)
        sid, var, last = pdf["series_id"].iloc[0], pdf["var"].iloc[0], int(pdf["_last"].iloc[0])
        rng = np.random.default_rng([seed, zlib.crc32(f"{sid}\x00{var}".encode())])
        cuts, scores = forest_steps(*grow_forest(pdf["value"].to_numpy(dtype="float64"), n_trees, max_samples, rng))
        return pd.DataFrame({"series_id": [sid], "var": [var], "_last": [last], "_cuts": [cuts], "_scores": [scores]})

    steps = pool.groupBy(*KEYS).applyInPandas(
        grow, "series_id string, var string, _last bigint, _cuts array<double>, _scores array<double>")
    blocks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"_last div {int(chunk_rows)}"))
    steps = steps.select(*KEYS, F.explode(blocks).alias(scan.CHUNK), "_cuts", "_scores")

    def score(points: pa.Table, model: pa.Table) -> pa.Table:
        x = points["value"].to_numpy(zero_copy_only=False).astype("float64")
        s = np.full(len(x), np.nan)
        if model.num_rows:
            known = ~np.isnan(x)
            cuts, scores = (model[c].combine_chunks().values.to_numpy() for c in ("_cuts", "_scores"))
            s[known] = scores[np.searchsorted(cuts, x[known], side="right")]
        return points.select(cols).append_column("score", pa.array(s, from_pandas=True))

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    by = [*KEYS, scan.CHUNK]
    scored = cut(scan.with_chunk(df, chunk_rows).groupBy(*by).cogroup(steps.groupBy(*by)).applyInArrow(
        score, f"{fields}, score double"))
    level = 1.0 - contamination
    top = exact_quantiles(scored, [level], value_col="score")
    top = top.select(*KEYS, F.col(f"q{level * 100:g}".replace(".", "_")).alias("_top"))
    flag = F.coalesce(F.col("score") > F.col("_top"), F.lit(False))
    return scored.join(top, on=KEYS, how="left").withColumn(out, flag).select(*cols, out, *(["score"] if keep_score else []))
