"""Moments pass: Gram matrices of lagged regression designs.

ADF, Engle-Granger and Granger all regress on lags of the series.  Instead of
materialising the design, every scan chunk (with a halo of ``maxlag + 1``
predecessors) builds its rows in numpy inside a grouped pandas task and
returns one partial Gram matrix ``Σ z zᵀ`` for the rows of the common sample,
plus the few *head* rows (positions before the common start) individually.
The matrices stay whole: a merge tree adds them up array by array (never
exploded into w² rows), so the per-series solve only ever sees one ``w×w``
matrix and at most ``maxlag`` head rows — whatever the series length.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators import scan
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS

GRAM_SCHEMA = ("series_id string, var string, gram array<double>, rows long, "
               "heads array<struct<pos:long,z:array<double>>>")


def lagged_gram(
    df: DataFrame,
    cols: list[str],
    halo: int,
    width: int,
    build: Callable[[dict[str, np.ndarray], np.ndarray], np.ndarray],
    start_col: str = "_start",
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    needed: Callable[[int], list[int]] | None = None,
) -> DataFrame:
    """Per ``(series_id, var)``: ``gram`` = Σ z zᵀ (row-major, ``width²``) over
    rows with ``pos >= start``, ``rows`` = how many rows that sum holds, and
    ``heads`` = the z rows with ``pos < start``.

    ``build(arrays, pos)`` returns the design matrix (len(pos) × width) for the
    chunk's contiguous rows (NaN where a lag is unavailable); rows with a NaN in
    one of the ``needed(start)`` columns (default: all) are skipped, other NaNs
    count as 0 (columns a series does not use).  ``df`` needs ``series_id, var, pos, <cols>, <start_col>``.
    """
    h = scan.with_halo(df.select(*KEYS, "pos", start_col, *cols), before=halo, after=0, chunk_rows=chunk_rows)

    def part(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        pos = pdf["pos"].to_numpy(dtype=np.int64)
        arrays = {c: pdf[c].to_numpy(dtype="float64", na_value=np.nan) for c in cols}
        # positions must be contiguous for shifts; fill holes with NaN rows
        full = np.arange(pos[0], pos[-1] + 1)
        if len(full) != len(pos):
            idx = pos - pos[0]
            for c in cols:
                a = np.full(len(full), np.nan)
                a[idx] = arrays[c]
                arrays[c] = a
            home = np.zeros(len(full), dtype=bool)
            home[idx] = pdf[scan.HOME].to_numpy(dtype=bool)
            pos = full
        else:
            home = pdf[scan.HOME].to_numpy(dtype=bool)
        z = build(arrays, pos)
        start = int(pdf[start_col].iloc[0])
        cols_needed = needed(start) if needed else list(range(width))
        ok = home & ~np.isnan(z[:, cols_needed]).any(axis=1)
        body = ok & (pos >= start)
        zb = np.nan_to_num(z[body], nan=0.0)
        gram = (zb.T @ zb).ravel() if len(zb) else np.zeros(width * width)
        heads = [{"pos": int(p), "z": list(map(float, r))} for p, r in zip(pos[home & (pos < start)], z[home & (pos < start)])]
        return pd.DataFrame({"series_id": [pdf["series_id"].iloc[0]], "var": [pdf["var"].iloc[0]],
                             "gram": [gram.tolist()], "rows": [int(len(zb))], "heads": [heads],
                             scan.CHUNK: [int(pdf[scan.CHUNK].iloc[0])]})

    parts = h.groupBy(*KEYS, scan.CHUNK).applyInPandas(part, f"{GRAM_SCHEMA}, {scan.CHUNK} long")
    for step in (MERGE_FAN, MERGE_FAN, None):  # a tree: a task adds up at most MERGE_FAN matrices below the root
        keys = [*KEYS] if step is None else [*KEYS, F.expr(f"{scan.CHUNK} div {step}").alias(scan.CHUNK)]
        parts = parts.groupBy(*keys).agg(
            F.collect_list("gram").alias("grams"), F.sum("rows").alias("rows"),
            F.array_sort(F.flatten(F.collect_list("heads"))).alias("heads")).withColumn("gram", _added("grams")).drop("grams")
    return parts.select(*KEYS, "gram", "rows", "heads")


#: Matrices that one task of the merge tree adds up.
MERGE_FAN = 256


def _added(arrays: str):
    """Element-wise sum of an array of equally long arrays."""
    first = F.transform(F.get(F.col(arrays), 0), lambda e: F.lit(0.0))
    return F.aggregate(arrays, first, lambda acc, g: F.zip_with(acc, g, lambda a, b: a + b))


def ols_from_gram(G: np.ndarray, cols: list[int], ycol: int):
    """OLS of column ``ycol`` on ``cols`` from a Gram matrix: (beta, ssr, XtX⁻¹)."""
    xtx = G[np.ix_(cols, cols)]
    xty = G[cols, ycol]
    try:
        inv = np.linalg.inv(xtx)
    except np.linalg.LinAlgError:
        inv = np.linalg.pinv(xtx)
    beta = inv @ xty
    ssr = float(G[ycol, ycol] - beta @ xty)
    return beta, max(ssr, 0.0), inv
