"""Variance / mean stabilising transforms.

Each transform maps the long frame's ``value`` column; ``chain`` folds a list
of steps (each step reads the previous output) and ``ledger`` returns the
transformation record as a DataFrame ``(series_id, var, step_no,
transformation, param)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsforge.operators import relations, scan
from tsforge.plans.materialize import cut
from tsforge.spec import DEFAULT_CHUNK_ROWS, KEYS

# Fixed value: shift used by the reference when a log/Box-Cox input has a value <= 0.
LOG_SHIFT_EPS = 1e-10


def diff(df: DataFrame, order: int = 1, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``order``-th difference by position (differencing repeated ``order``
    times, evaluated over ``order`` lags in one window); the first ``order``
    rows become NULL."""
    if order < 1:
        raise ValueError("order must be >= 1")
    cols = df.columns
    h = scan.with_halo(df, before=order, after=0, chunk_rows=chunk_rows)
    w = scan.chunk_window()
    level = [F.col("value") if j == 0 else F.lag("value", j).over(w) for j in range(order + 1)]
    for _ in range(order):
        level = [level[j] - level[j + 1] for j in range(len(level) - 1)]
    return scan.drop_halo(h.withColumn("value", level[0])).select(*cols)


def seasonal_diff(df: DataFrame, period: int = 12, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """``x_t - x_{t-period}``; the first ``period`` rows become NULL."""
    if period < 1:
        raise ValueError("period must be >= 1")
    cols = df.columns
    h = scan.with_halo(df, before=period, after=0, chunk_rows=chunk_rows)
    return scan.drop_halo(h.withColumn("value", F.col("value") - F.lag("value", period).over(scan.chunk_window()))).select(
        *cols
    )


def _with_min(df: DataFrame) -> DataFrame:
    return df.join(df.groupBy(*KEYS).agg(F.min("value").alias("_mn")), on=KEYS, how="left")


def _pos_shift():
    # x + |min| + eps when any value <= 0, else x
    return F.when(F.col("_mn") <= 0, F.col("value") + F.abs(F.col("_mn")) + F.lit(LOG_SHIFT_EPS)).otherwise(
        F.col("value")
    )


def log(df: DataFrame) -> DataFrame:
    """Natural log, shifting the whole series when any value is <= 0."""
    cols = df.columns
    return _with_min(df).withColumn("value", F.ln(_pos_shift())).select(*cols)


def sqrt(df: DataFrame) -> DataFrame:
    """Square root, shifting by |min| when any value is negative."""
    cols = df.columns
    x = F.when(F.col("_mn") < 0, F.col("value") + F.abs(F.col("_mn"))).otherwise(F.col("value"))
    return _with_min(df).withColumn("value", F.sqrt(x)).select(*cols)


def _bc(x, lam: float):
    return F.ln(x) if lam == 0 else (F.pow(x, F.lit(lam)) - F.lit(1.0)) / F.lit(lam)


def boxcox_lambda(df: DataFrame, grid=None, refine: int = 2) -> DataFrame:
    """ML estimate of the Box-Cox lambda per series: the profile log-likelihood
    ``(l-1)·Σln x - n/2·ln var_pop(y_l)`` is evaluated for a grid of lambdas in
    one aggregate per pass, with x divided by its geometric mean g, where it is
    ``-Σln x - n/2·ln var_pop(((x/g)^l - 1) / l)`` and no power runs out of digits; ``refine`` further passes zoom in around the best.
    Without a given grid the default one, [-2, 2], is moved on for as long as
    some series has its best lambda at an edge.  Returns ``series_id, var,
    lmbda, llf``."""
    moves = grid is None
    grid = list(grid) if grid is not None else [round(-2 + 0.1 * i, 10) for i in range(41)]
    logs = _with_min(df).withColumn("_x", _pos_shift()).filter(F.col("_x").isNotNull()).select(*KEYS, F.ln("_x").alias("_lx"))
    means = logs.groupBy(*KEYS).agg(F.avg("_lx").alias("_ml"))
    # read by every pass
    shifted = cut(logs.join(means, on=KEYS).select(*KEYS, "_ml", (F.col("_lx") - F.col("_ml")).alias("_z")))
    step = grid[1] - grid[0] if len(grid) > 1 else 0.1
    best = _boxcox_pass(shifted, grid)
    lo, hi = grid[0], grid[-1]
    while moves:
        best = cut(best)  # one row per series
        if best.filter((F.col("lmbda") <= lo) | (F.col("lmbda") >= hi)).isEmpty() or hi > MAX_ABS_LAMBDA:
            break
        # re-centre on each series' best; beyond the edge only the outward half can win
        best, lo, hi = _boxcox_pass(shifted, grid, centre=best), lo - 2, hi + 2
    for _ in range(refine):
        # next grid: 21 points over [best - step, best + step] per series
        step = step / 10.0
        offs = [k * step for k in range(-10, 11)]
        best = _boxcox_pass(shifted, offs, centre=best)
    return best


#: Where the search for lambda gives up (a series of nearly equal values has its maximum anywhere).
MAX_ABS_LAMBDA = 64


def _boxcox_pass(shifted: DataFrame, lams, centre: DataFrame | None = None) -> DataFrame:
    if centre is None:
        d = shifted.withColumn("_c", F.lit(0.0))
    else:
        d = shifted.join(centre.select(*KEYS, F.col("lmbda").alias("_c")), on=KEYS, how="inner")
    aggs = [F.first("_ml").alias("_ml"), F.count(F.lit(1)).alias("_n"), F.first("_c").alias("_c")]
    for i, off in enumerate(lams):
        lam = F.col("_c") + F.lit(float(off))
        aggs.append(F.var_pop(F.when(lam == 0, F.col("_z")).otherwise(F.expm1(lam * F.col("_z")) / lam)).alias(f"_v{i}"))
    a = d.groupBy(*KEYS).agg(*aggs)
    cand = F.array(
        *[F.struct((F.col("_c") + F.lit(float(off))).alias("lmbda"), F.col(f"_v{i}").alias("v")) for i, off in enumerate(lams)]
    )
    llf = lambda e: -F.col("_n") * (F.col("_ml") + F.ln(e["v"]) / 2)
    scored = a.select(*KEYS, F.transform(cand, lambda e: F.struct(llf(e).alias("llf"), e["lmbda"].alias("lmbda"))).alias("_s"))
    # argmax llf (ties → smaller lambda): max over (llf, -lambda)
    best = F.aggregate(
        "_s",
        F.struct(F.lit(None).cast("double").alias("llf"), F.lit(None).cast("double").alias("lmbda")),
        lambda acc, e: F.when(
            acc["llf"].isNull() | (e["llf"] > acc["llf"]), F.struct(e["llf"].alias("llf"), e["lmbda"].alias("lmbda"))
        ).otherwise(acc),
    )
    return scored.select(*KEYS, best["lmbda"].alias("lmbda"), best["llf"].alias("llf"))


def boxcox(df: DataFrame, lmbda: DataFrame | float | None = None, grid=None, refine: int = 2) -> DataFrame:
    """I4: Box-Cox with the per-series ML lambda (or a given lambda / table)."""
    cols = df.columns
    d = _with_min(df).withColumn("_x", _pos_shift())
    if isinstance(lmbda, (int, float)):
        return d.withColumn("value", _bc(F.col("_x"), float(lmbda))).select(*cols)
    lam_df = lmbda if lmbda is not None else boxcox_lambda(df, grid, refine)
    d = d.join(lam_df.select(*KEYS, F.col("lmbda").alias("_l")), on=KEYS, how="left")
    y = F.when(F.col("_l") == 0, F.ln("_x")).otherwise((F.pow(F.col("_x"), F.col("_l")) - 1) / F.col("_l"))
    return d.withColumn("value", y).select(*cols)


STEPS = ("diff", "seasonal_diff", "log", "boxcox", "sqrt")


def apply(df: DataFrame, method: str, chunk_rows: int = DEFAULT_CHUNK_ROWS, columns: list[str] | None = None,
          **kw) -> DataFrame:
    """One transformation; with ``columns`` (I6) of these variables only, the others stay as they are."""
    if columns is not None:
        relations.require(df, *columns)
        rest = df.filter(~F.col("var").isin(*columns))
        return apply(df.filter(F.col("var").isin(*columns)), method, chunk_rows, **kw).unionByName(rest)
    if method == "diff":
        return diff(df, kw.get("order", 1), chunk_rows)
    if method == "seasonal_diff":
        return seasonal_diff(df, kw.get("period", 12), chunk_rows)
    if method == "log":
        return log(df)
    if method == "boxcox":
        return boxcox(df, kw.get("lmbda"), kw.get("grid"), kw.get("refine", 2))
    if method == "sqrt":
        return sqrt(df)
    raise ValueError(f"unsupported transformation {method!r}; use one of {STEPS}")


def step_label(method: str, **kw) -> str:
    if method == "diff":
        return f"diff_{kw.get('order', 1)}"
    if method == "seasonal_diff":
        return f"seasonal_diff_{kw.get('period', 12)}"
    return method


def chain(df: DataFrame, steps, chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Apply ``steps`` (``[(method, kwargs), ...]`` or method names) in order."""
    for s in steps:
        m, kw = (s, {}) if isinstance(s, str) else s
        df = apply(df, m, chunk_rows, **kw)
    return df


def ledger(df: DataFrame, steps) -> DataFrame:
    """One row per (series, var, step) recording every transformation."""
    labels = []
    for s in steps:
        m, kw = (s, {}) if isinstance(s, str) else s
        labels.append(step_label(m, **kw))
    arr = F.array(*[F.struct(F.lit(i + 1).cast("bigint").alias("step_no"), F.lit(lab).alias("transformation"))
                    for i, lab in enumerate(labels)])
    return (
        df.select(*KEYS).distinct()
        .select(*KEYS, F.explode(arr).alias("_s"))
        .select(*KEYS, "_s.step_no", "_s.transformation")
    )


def auto(df: DataFrame, verdicts: DataFrame, seasonal: DataFrame, period: int = 12, order: int = 1,
         chunk_rows: int = DEFAULT_CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """I8: per variable, non-stationary & seasonal → seasonal difference;
    non-stationary → difference; trend-stationary → log; otherwise unchanged.

    ``verdicts``: ``series_id, var, conclusion``; ``seasonal``: ``series_id,
    var, seasonal``.  All candidates are evaluated in one halo pass and the
    per-variable decision (a small table) picks one.  Returns (data, ledger)."""
    cols = df.columns
    decide = verdicts.select(*KEYS, "conclusion").join(seasonal.select(*KEYS, "seasonal"), on=KEYS, how="left")
    label = (F.when((F.col("conclusion") == "non_stationary") & F.coalesce(F.col("seasonal"), F.lit(False)),
                    F.lit(f"seasonal_diff_{period}"))
             .when(F.col("conclusion") == "non_stationary", F.lit(f"diff_{order}"))
             .when(F.col("conclusion") == "trend_stationary", F.lit("log"))
             .otherwise(F.lit("none")))
    decide = decide.select(*KEYS, label.alias("transformation"))
    halo = max(period, order)
    h = scan.with_halo(_with_min(df), before=halo, after=0, chunk_rows=chunk_rows)
    w = scan.chunk_window()
    level = [F.col("value") if j == 0 else F.lag("value", j).over(w) for j in range(order + 1)]
    for _ in range(order):
        level = [level[j] - level[j + 1] for j in range(len(level) - 1)]
    h = (h.withColumn("_d", level[0])
         .withColumn("_sd", F.col("value") - F.lag("value", period).over(w))
         .withColumn("_lg", F.ln(_pos_shift())))
    d = scan.drop_halo(h).join(decide, on=KEYS, how="left")
    t = F.col("transformation")
    val = (F.when(t == f"seasonal_diff_{period}", F.col("_sd")).when(t == f"diff_{order}", F.col("_d"))
           .when(t == "log", F.col("_lg")).otherwise(F.col("value")))
    ledger_df = decide.select(*KEYS, F.lit(1).cast("bigint").alias("step_no"), "transformation")
    return d.withColumn("value", val).select(*cols), ledger_df
