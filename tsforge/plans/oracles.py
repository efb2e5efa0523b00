"""DuckDB SQL oracles, written from the operator definitions (not from the
Spark plans).  Tables ``orders lineitem events embeddings …`` are views.

Whole-series windows are fine here: the oracle is a single-node checker.
Doubles are rounded with :func:`R6` exactly like ``tsforge.plans.queries.finish``.
"""

from __future__ import annotations

from tsforge.plans import regression_oracles as ro

ORACLES: dict[str, str] = {}


def R6(e: str) -> str:
    return f"(CASE WHEN abs({e}) < 1e12 THEN floor(({e}) * 1e6 + 0.5) / 1e6 ELSE CAST({e} AS DOUBLE) END)"


def W(order="pos", frame="ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW", part="series_id, var"):
    return f"(PARTITION BY {part} ORDER BY {order} {frame})"


# ----------------------------------------------------------------- base series

ORD_RAW = """
ord_d AS (
  SELECT o_orderdate AS ts,
         CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue,
         CAST(COUNT(*) AS DOUBLE) AS n_orders
  FROM orders GROUP BY o_orderdate),
ord_raw AS (
  SELECT 'orders' AS series_id, 'revenue' AS var, ts, revenue AS value FROM ord_d
  UNION ALL
  SELECT 'orders', 'n_orders', ts, n_orders FROM ord_d)"""

SHIP_RAW = """
ship_d AS (
  SELECT l_shipdate AS ts,
         CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS quantity,
         CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS price,
         CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS discount,
         CAST(SUM(CAST(l_tax AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS tax
  FROM lineitem GROUP BY l_shipdate),
ship_raw AS (
  SELECT 'lineitem' AS series_id, 'quantity' AS var, ts, quantity AS value FROM ship_d
  UNION ALL SELECT 'lineitem', 'price', ts, price FROM ship_d
  UNION ALL SELECT 'lineitem', 'discount', ts, discount FROM ship_d
  UNION ALL SELECT 'lineitem', 'tax', ts, tax FROM ship_d)"""

EV_RAW_H = """
ev_h AS (
  SELECT event_type AS series_id, 'value' AS var, date_trunc('hour', ts) AS ts,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) AS value
  FROM events GROUP BY event_type, date_trunc('hour', ts))"""

EV_WIDE_RAW = EV_RAW_H + """,
evw_raw AS (SELECT 'events' AS series_id, series_id AS var, ts, value FROM ev_h)"""

USER_EV = """
user_ev AS (
  SELECT CAST(user_id AS VARCHAR) AS series_id, 'value' AS var, ts,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS pos,
         CAST(value AS DOUBLE) AS value
  FROM events)"""

EV_TYPE = """
ev_type AS (
  SELECT event_type AS series_id, 'value' AS var, ts,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS pos,
         CAST(value AS DOUBLE) AS value
  FROM events)"""

EMB = """
emb AS (
  SELECT CAST(vec_id AS VARCHAR) AS series_id, label,
         unnest(generate_series(0, len(embedding) - 1)) AS step,
         CAST(unnest(embedding) AS DOUBLE) AS x
  FROM embeddings)"""


def grid(raw: str, name: str, step_us: int) -> str:
    """asfreq: grid t0 + k*step per series_id, left join of on-grid observations."""
    return f"""
{name}_span AS (SELECT series_id, min(ts) AS t0, max(ts) AS t1 FROM {raw} GROUP BY series_id),
{name}_pts AS (
  SELECT v.series_id, v.var, s.t0,
         unnest(generate_series(s.t0, s.t1, to_microseconds(CAST({step_us} AS BIGINT)))) AS ts
  FROM (SELECT DISTINCT series_id, var FROM {raw}) v JOIN {name}_span s ON v.series_id = s.series_id),
{name} AS (
  SELECT p.series_id, p.var, p.ts, datediff('microsecond', p.t0, p.ts) // {step_us} AS pos, r.value
  FROM {name}_pts p LEFT JOIN {raw} r ON r.series_id = p.series_id AND r.var = p.var AND r.ts = p.ts)"""


DAY = 86_400_000_000
HOUR = 3_600_000_000

ORD_GRID = ORD_RAW + "," + grid("ord_raw", "ord_g", DAY)
EV_GRID = EV_RAW_H + "," + grid("ev_h", "ev_g", HOUR)
SHIP_GRID = SHIP_RAW + "," + grid("ship_raw", "ship_g", DAY)
WIDE_GRID = EV_WIDE_RAW + "," + grid("evw_raw", "evw_g", HOUR)


def linfill(src: str, name: str, col: str = "value") -> str:
    """Linear interpolation by position; leading NULL stays, trailing takes last."""
    prev = W()
    nxt = W(frame="ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING")
    return f"""
{name}_nb AS (
  SELECT *,
    last_value(CASE WHEN {col} IS NOT NULL THEN pos END IGNORE NULLS) OVER {prev} AS lf_p0,
    last_value({col} IGNORE NULLS) OVER {prev} AS lf_v0,
    first_value(CASE WHEN {col} IS NOT NULL THEN pos END IGNORE NULLS) OVER {nxt} AS lf_p1,
    first_value({col} IGNORE NULLS) OVER {nxt} AS lf_v1
  FROM {src}),
{name} AS (
  SELECT * EXCLUDE ({col}, lf_p0, lf_v0, lf_p1, lf_v1),
    COALESCE({col},
             lf_v0 + (lf_v1 - lf_v0) * (CAST(pos - lf_p0 AS DOUBLE) / NULLIF(lf_p1 - lf_p0, 0)),
             lf_v0) AS {col}
  FROM {name}_nb)"""


def rollz(src: str, name: str, window: int, threshold: float, flag: str = "is_outlier") -> str:
    w = W(frame=f"ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW")
    return f"""
{name} AS (
  SELECT *, COALESCE(abs(value - avg(value) OVER {w}) / NULLIF(stddev_samp(value) OVER {w}, 0) > {threshold},
                     false) AS {flag}
  FROM {src})"""


def zflag(src: str, name: str, threshold: float, flag: str = "is_outlier") -> str:
    return f"""
{name}_st AS (SELECT series_id, var, avg(value) AS mu, stddev_samp(value) AS sd FROM {src} GROUP BY series_id, var),
{name} AS (
  SELECT s.*, COALESCE(abs(s.value - t.mu) / NULLIF(t.sd, 0) > {threshold}, false) AS {flag}
  FROM {src} s JOIN {name}_st t ON s.series_id = t.series_id AND s.var = t.var)"""


def iqrflag(src: str, name: str, flag: str = "is_outlier") -> str:
    return f"""
{name}_q AS (
  SELECT series_id, var, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3
  FROM {src} GROUP BY series_id, var),
{name} AS (
  SELECT s.*, q.q1 - 1.5 * (q.q3 - q.q1) AS lo, q.q3 + 1.5 * (q.q3 - q.q1) AS hi,
         COALESCE(s.value < q.q1 - 1.5 * (q.q3 - q.q1) OR s.value > q.q3 + 1.5 * (q.q3 - q.q1), false) AS {flag}
  FROM {src} s JOIN {name}_q q ON s.series_id = q.series_id AND s.var = q.var)"""


def sel_long(src: str, extra: str = "") -> str:
    extra = (", " + extra) if extra else ""
    return f"SELECT series_id, var, ts, pos, {R6('value')} AS value{extra} FROM {src}"


# ----------------------------------------------------------------- flagship

ORACLES["clean_compare"] = f"""
WITH {ORD_GRID},
{linfill('ord_g', 'c1')},
{rollz('c1', 'c2', 10, 2.5)},
c3 AS (SELECT series_id, var, ts, pos, CASE WHEN is_outlier THEN NULL ELSE value END AS value FROM c2),
{linfill('c3', 'c4')}
SELECT g.series_id, g.var, g.ts, g.pos, {R6('g.value')} AS original, {R6('c.value')} AS cleaned,
       (g.value IS DISTINCT FROM c.value) AS changed, {R6('c.value - g.value')} AS delta
FROM ord_g g JOIN c4 c ON g.series_id = c.series_id AND g.var = c.var AND g.pos = c.pos
"""

ORACLES["clean_change_counts"] = f"""
WITH {ORD_GRID},
{linfill('ord_g', 'c1')},
{rollz('c1', 'c2', 10, 2.5)},
c3 AS (SELECT series_id, var, ts, pos, CASE WHEN is_outlier THEN NULL ELSE value END AS value FROM c2),
{linfill('c3', 'c4')}
SELECT g.series_id, g.var, count(*) AS n,
       CAST(sum(CAST(g.value IS DISTINCT FROM c.value AS INT)) AS BIGINT) AS n_changed,
       CAST(sum(CAST(g.value IS NULL AS INT)) AS BIGINT) AS n_missing_before,
       CAST(sum(CAST(c.value IS NULL AS INT)) AS BIGINT) AS n_missing_after
FROM ord_g g JOIN c4 c ON g.series_id = c.series_id AND g.var = c.var AND g.pos = c.pos
GROUP BY g.series_id, g.var
"""

# ----------------------------------------------------------------- B

ORACLES["asfreq_daily"] = f"WITH {ORD_GRID} {sel_long('ord_g')}"
ORACLES["asfreq_hourly"] = f"WITH {EV_GRID} {sel_long('ev_g')}"

# ----------------------------------------------------------------- C

ORACLES["missing_mask"] = f"WITH {EV_GRID} {sel_long('ev_g', 'value IS NULL AS is_missing')}"
ORACLES["missing_or_zero_mask"] = f"""
WITH {EV_GRID},
z AS (SELECT series_id, var, ts, pos, CASE WHEN hour(ts) = 0 THEN 0.0 ELSE value END AS value FROM ev_g)
{sel_long('z', '(value IS NULL OR value = 0) AS is_missing')}"""

ORACLES["outlier_zscore"] = f"WITH {USER_EV}, {zflag('user_ev', 'z', 3.0)} {sel_long('z', 'is_outlier')}"
ORACLES["outlier_iqr"] = f"WITH {USER_EV}, {iqrflag('user_ev', 'z')} {sel_long('z', 'is_outlier')}"
ORACLES["outlier_rolling_zscore"] = f"WITH {EV_TYPE}, {rollz('ev_type', 'z', 20, 3.0)} {sel_long('z', 'is_outlier')}"

# ----------------------------------------------------------------- D

ORACLES["outlier_to_null"] = f"""
WITH {USER_EV}, {zflag('user_ev', 'z', 3.0)},
o AS (SELECT series_id, var, ts, pos, CASE WHEN is_outlier THEN NULL ELSE value END AS value FROM z)
{sel_long('o')}"""

ORACLES["outlier_clip"] = f"""
WITH {USER_EV}, {iqrflag('user_ev', 'z')},
o AS (SELECT series_id, var, ts, pos,
             CASE WHEN is_outlier AND value < lo THEN lo WHEN is_outlier AND value > hi THEN hi ELSE value END AS value
      FROM z)
{sel_long('o')}"""

ORACLES["outlier_interpolate"] = f"""
WITH {ORD_GRID}, {zflag('ord_g', 'z', 3.0)},
o AS (SELECT series_id, var, ts, pos, CASE WHEN is_outlier THEN NULL ELSE value END AS value FROM z),
{linfill('o', 'f')}
{sel_long('f')}"""

ORACLES["fill_linear"] = f"WITH {EV_GRID}, {linfill('ev_g', 'f')} {sel_long('f')}"

ORACLES["fill_rolling_mean"] = f"""
WITH {EV_GRID},
f AS (SELECT series_id, var, ts, pos,
             COALESCE(value, avg(value) OVER {W(frame='ROWS BETWEEN 4 PRECEDING AND CURRENT ROW')}) AS value
      FROM ev_g)
{sel_long('f')}"""

ORACLES["auto_window"] = f"""
WITH {EV_GRID}
SELECT series_id, var, greatest(3, least(20, count(*) // 10)) AS window FROM ev_g GROUP BY series_id, var"""

ORACLES["fill_rolling_mean_auto"] = f"""
WITH {EV_GRID},
aw AS (SELECT series_id, var, greatest(3, least(20, count(*) // 10)) AS w FROM ev_g GROUP BY series_id, var),
nulls AS (SELECT g.series_id, g.var, g.pos, a.w FROM ev_g g JOIN aw a USING (series_id, var) WHERE g.value IS NULL),
m AS (SELECT n.series_id, n.var, n.pos,
             list_reduce(list(g.value ORDER BY g.pos) FILTER (WHERE g.value IS NOT NULL), lambda a, b: a + b) / count(g.value) AS mv
      FROM nulls n JOIN ev_g g ON g.series_id = n.series_id AND g.var = n.var
           AND g.pos > n.pos - n.w AND g.pos <= n.pos
      GROUP BY n.series_id, n.var, n.pos),
f AS (SELECT g.series_id, g.var, g.ts, g.pos, COALESCE(g.value, m.mv) AS value
      FROM ev_g g LEFT JOIN m ON g.series_id = m.series_id AND g.var = m.var AND g.pos = m.pos)
{sel_long('f')}"""

# ----------------------------------------------------------------- G

ORACLES["ds_minmax"] = f"""
WITH {EMB},
s AS (SELECT series_id, min(x) AS mn, max(x) AS mx FROM emb GROUP BY series_id)
SELECT e.series_id, CAST(e.label AS BIGINT) AS label, CAST(e.step AS BIGINT) AS step,
       {R6('CASE WHEN s.mx = s.mn THEN 0.0 ELSE (e.x - s.mn) / (s.mx - s.mn) END')} AS x
FROM emb e JOIN s USING (series_id)"""

ORACLES["ds_zscore"] = f"""
WITH {EMB},
s AS (SELECT series_id, avg(x) AS mu, stddev_pop(x) AS sd FROM emb GROUP BY series_id)
SELECT e.series_id, CAST(e.label AS BIGINT) AS label, CAST(e.step AS BIGINT) AS step,
       {R6('CASE WHEN s.sd = 0 THEN e.x - s.mu ELSE (e.x - s.mu) / s.sd END')} AS x
FROM emb e JOIN s USING (series_id)"""

ORACLES["ds_minmax_per_var"] = f"""
WITH {SHIP_GRID},
s AS (SELECT series_id, var, min(value) AS mn, max(value) AS mx FROM ship_g GROUP BY series_id, var),
o AS (SELECT g.series_id, g.var, g.ts, g.pos,
             CASE WHEN s.mx = s.mn THEN 0.0 ELSE (g.value - s.mn) / (s.mx - s.mn) END AS value
      FROM ship_g g JOIN s USING (series_id, var))
{sel_long('o')}"""

ORACLES["standardize"] = f"""
WITH {SHIP_GRID},
s AS (SELECT series_id, var, avg(value) AS mu, stddev_pop(value) AS sd FROM ship_g GROUP BY series_id, var),
o AS (SELECT g.series_id, g.var, g.ts, g.pos, (g.value - s.mu) / NULLIF(s.sd, 0) AS value
      FROM ship_g g JOIN s USING (series_id, var))
{sel_long('o')}"""

# ----------------------------------------------------------------- E

EV_TYPE_RAW = """
ev_t AS (SELECT event_type AS series_id, 'value' AS var, ts, CAST(value AS DOUBLE) AS value FROM events)"""

_LABEL = {
    "D": "CAST(ts AS DATE)",
    "W": "CAST(ts AS DATE) + CAST((7 - isodow(CAST(ts AS DATE))) % 7 AS INTEGER)",
    "M": "last_day(CAST(ts AS DATE))",
    "Q": "last_day(CAST(date_trunc('quarter', ts) AS DATE) + INTERVAL 2 MONTH)",
    "Y": "make_date(year(ts), 12, 31)",
}
# grid of consecutive bucket labels between the first and last label
_SERIES = {
    "D": "generate_series(CAST(l0 AS TIMESTAMP), CAST(l1 AS TIMESTAMP), INTERVAL 1 DAY)",
    "W": "generate_series(CAST(l0 AS TIMESTAMP), CAST(l1 AS TIMESTAMP), INTERVAL 7 DAY)",
    "M": "generate_series(CAST(date_trunc('month', l0) AS TIMESTAMP), CAST(date_trunc('month', l1) AS TIMESTAMP), INTERVAL 1 MONTH)",
    "Q": "generate_series(CAST(date_trunc('month', l0) AS TIMESTAMP), CAST(date_trunc('month', l1) AS TIMESTAMP), INTERVAL 3 MONTH)",
    "Y": "generate_series(CAST(date_trunc('year', l0) AS TIMESTAMP), CAST(date_trunc('year', l1) AS TIMESTAMP), INTERVAL 1 YEAR)",
}
_TO_LABEL = {"D": "g", "W": "g", "M": "last_day(g)", "Q": "last_day(g)", "Y": "make_date(year(g), 12, 31)"}
_AGG = {"mean": "CAST(sum(CAST(value AS DECIMAL(38,10))) AS DOUBLE) / count(value)",
        "sum": "CAST(sum(CAST(value AS DECIMAL(38,10))) AS DOUBLE)", "max": "max(value)", "min": "min(value)"}


def downsample_sql(rule: str, method: str) -> str:
    src = "ev_t" if rule == "D" else "ord_raw"
    base = EV_TYPE_RAW if rule == "D" else ORD_RAW
    val = "COALESCE(b.v, 0.0)" if method == "sum" else "b.v"
    return f"""
WITH {base},
b AS (SELECT series_id, var, {_LABEL[rule]} AS lab, {_AGG[method]} AS v FROM {src} GROUP BY ALL),
rng AS (SELECT series_id, var, min(lab) AS l0, max(lab) AS l1 FROM b GROUP BY series_id, var),
gr AS (SELECT series_id, var, CAST({_TO_LABEL[rule]} AS DATE) AS lab
       FROM (SELECT series_id, var, unnest({_SERIES[rule]}) AS g FROM rng))
SELECT gr.series_id, gr.var, CAST(gr.lab AS TIMESTAMP) AS ts,
       row_number() OVER (PARTITION BY gr.series_id, gr.var ORDER BY gr.lab) - 1 AS pos,
       {R6(val)} AS value
FROM gr LEFT JOIN b ON b.series_id = gr.series_id AND b.var = gr.var AND b.lab = gr.lab"""


for _r, _rn in {"D": "day", "W": "week", "M": "month", "Q": "quarter", "Y": "year"}.items():
    for _m in _AGG:
        ORACLES[f"downsample_{_m}_{_rn}"] = downsample_sql(_r, _m)


def ffill(src: str, name: str) -> str:
    return f"""
{name} AS (SELECT * EXCLUDE (value), COALESCE(value, last_value(value IGNORE NULLS) OVER {W()}) AS value FROM {src})"""


ORACLES["upsample_ffill_hour"] = f"WITH {ORD_RAW}, {grid('ord_raw', 'u', HOUR)}, {ffill('u', 'f')} {sel_long('f')}"
ORACLES["upsample_linear_hour"] = f"WITH {ORD_RAW}, {grid('ord_raw', 'u', HOUR)}, {linfill('u', 'f')} {sel_long('f')}"
ORACLES["upsample_ffill_minute"] = f"WITH {EV_RAW_H}, {grid('ev_h', 'u', 60_000_000)}, {ffill('u', 'f')} {sel_long('f')}"
ORACLES["upsample_linear_minute"] = f"WITH {EV_RAW_H}, {grid('ev_h', 'u', 60_000_000)}, {linfill('u', 'f')} {sel_long('f')}"

# ----------------------------------------------------------------- F


def ma_sql(window: int) -> str:
    after = (window - 1) // 2
    before = window - 1 - after
    f = W(frame=f"ROWS BETWEEN {before} PRECEDING AND {after} FOLLOWING")
    return f"""
WITH {EV_GRID},
s AS (SELECT series_id, var, ts, pos,
             CASE WHEN count(value) OVER {f} = {window} THEN avg(value) OVER {f} ELSE value END AS value
      FROM ev_g)
{sel_long('s')}"""


ORACLES["smooth_ma_odd"] = ma_sql(3)
ORACLES["smooth_ma_even"] = ma_sql(4)

ORACLES["smooth_ewm"] = f"""
WITH RECURSIVE {EV_GRID},
e AS (
  SELECT series_id, var, ts, pos, CASE WHEN value IS NOT NULL THEN pos END AS lp, value AS y
  FROM ev_g WHERE pos = 0
  UNION ALL
  SELECT b.series_id, b.var, b.ts, b.pos,
         CASE WHEN b.value IS NOT NULL THEN b.pos ELSE e.lp END,
         CASE WHEN b.value IS NULL THEN e.y
              WHEN e.y IS NULL THEN b.value
              ELSE (pow(0.8, b.pos - e.lp) * e.y + 0.2 * b.value) / (pow(0.8, b.pos - e.lp) + 0.2) END
  FROM e JOIN ev_g b ON b.series_id = e.series_id AND b.var = e.var AND b.pos = e.pos + 1)
SELECT series_id, var, ts, pos, {R6('y')} AS value FROM e"""

ORACLES["smooth_loess"] = f"""
WITH {EV_GRID}, {linfill('ev_g', 'lf')},
nk AS (SELECT series_id, var, count(*) AS n, CAST(floor(count(*) * 0.1) AS BIGINT) AS k FROM lf GROUP BY series_id, var),
a AS (SELECT l.series_id, l.var, l.ts, l.pos, nk.k,
             least(greatest(CAST(ceil(l.pos - nk.k / 2.0) AS BIGINT), 0), nk.n - nk.k) AS lft
      FROM lf l JOIN nk USING (series_id, var)),
a2 AS (SELECT *, greatest(pos - lft, lft + k - 1 - pos) AS rad FROM a),
pr AS (SELECT a2.series_id, a2.var, a2.ts, a2.pos, CAST(b.pos AS DOUBLE) AS xj, b.value AS yj,
              CASE WHEN abs(b.pos - a2.pos) / a2.rad < 1 THEN pow(1 - pow(abs(b.pos - a2.pos) / a2.rad, 3), 3) ELSE 0 END AS w
       FROM a2 JOIN lf b ON b.series_id = a2.series_id AND b.var = a2.var
            AND b.pos BETWEEN a2.lft AND a2.lft + a2.k - 1
       WHERE b.value IS NOT NULL),
m AS (SELECT series_id, var, ts, pos, sum(w * xj) / sum(w) AS xm, sum(w * yj) / sum(w) AS ym
      FROM pr GROUP BY ALL),
s AS (SELECT pr.series_id, pr.var, pr.ts, pr.pos, m.xm, m.ym,
             sum(pr.w * (pr.xj - m.xm) * (pr.xj - m.xm)) AS sxx,
             sum(pr.w * (pr.xj - m.xm) * (pr.yj - m.ym)) AS sxy
      FROM pr JOIN m USING (series_id, var, pos) GROUP BY ALL),
o AS (SELECT series_id, var, ts, pos,
             CASE WHEN sxx > 1e-12 * greatest(1.0, xm * xm) THEN ym + sxy / sxx * (pos - xm) ELSE ym END AS value
      FROM s)
{sel_long('o')}"""

# ----------------------------------------------------------------- I


def lagx(src: str, name: str, k: int, col: str = "value") -> str:
    return f"{name} AS (SELECT *, lag({col}, {k}) OVER (PARTITION BY series_id, var ORDER BY pos) AS lag{k} FROM {src})"


ORACLES["diff_1"] = f"WITH {SHIP_GRID}, d AS (SELECT series_id, var, ts, pos, value - lag(value) OVER {W(frame='')} AS value FROM ship_g) {sel_long('d')}"
ORACLES["diff_2"] = f"""WITH {SHIP_GRID},
d1 AS (SELECT series_id, var, ts, pos, value - lag(value) OVER {W(frame='')} AS value FROM ship_g),
d AS (SELECT series_id, var, ts, pos, value - lag(value) OVER {W(frame='')} AS value FROM d1)
{sel_long('d')}"""
ORACLES["diff_seasonal"] = f"WITH {SHIP_GRID}, d AS (SELECT series_id, var, ts, pos, value - lag(value, 12) OVER {W(frame='')} AS value FROM ship_g) {sel_long('d')}"

_D1 = f"{SHIP_GRID}, d1 AS (SELECT series_id, var, ts, pos, value - lag(value) OVER {W(frame='')} AS value FROM ship_g), mn AS (SELECT series_id, var, min(value) AS m FROM d1 GROUP BY ALL)"
ORACLES["log_transform"] = f"""WITH {_D1},
t AS (SELECT d1.series_id, d1.var, ts, pos,
             ln(CASE WHEN m <= 0 THEN value + abs(m) + 1e-10 ELSE value END) AS value
      FROM d1 JOIN mn USING (series_id, var))
{sel_long('t')}"""
ORACLES["sqrt_transform"] = f"""WITH {_D1},
t AS (SELECT d1.series_id, d1.var, ts, pos, sqrt(CASE WHEN m < 0 THEN value + abs(m) ELSE value END) AS value
      FROM d1 JOIN mn USING (series_id, var))
{sel_long('t')}"""

_LAMS = ", ".join(f"({-2 + 0.1 * i:.1f})" for i in range(41))
_BC = f"""{SHIP_GRID},
mn AS (SELECT series_id, var, min(value) AS m FROM ship_g GROUP BY ALL),
sx AS (SELECT g.series_id, g.var, g.ts, g.pos, CASE WHEN m <= 0 THEN value + abs(m) + 1e-10 ELSE value END AS x
       FROM ship_g g JOIN mn USING (series_id, var)),
lams AS (SELECT CAST(l AS DOUBLE) AS l FROM (VALUES {_LAMS}) t(l)),
ll AS (SELECT series_id, var, l,
              (l - 1) * sum(ln(x)) - count(x) / 2.0 * ln(var_pop(CASE WHEN l = 0 THEN ln(x) ELSE (pow(x, l) - 1) / l END)) AS llf
       FROM sx, lams WHERE x IS NOT NULL GROUP BY series_id, var, l),
best AS (SELECT series_id, var, arg_max(l, llf) AS lam FROM ll GROUP BY ALL)"""
ORACLES["boxcox_lambda"] = f"WITH {_BC} SELECT series_id, var, {R6('lam')} AS lmbda FROM best"
ORACLES["boxcox"] = f"""WITH {_BC},
t AS (SELECT sx.series_id, sx.var, ts, pos, CASE WHEN lam = 0 THEN ln(x) ELSE (pow(x, lam) - 1) / lam END AS value
      FROM sx JOIN best USING (series_id, var))
{sel_long('t')}"""

ORACLES["transform_chain"] = f"""WITH {SHIP_GRID},
mn AS (SELECT series_id, var, min(value) AS m FROM ship_g GROUP BY ALL),
l1 AS (SELECT g.series_id, g.var, ts, pos, ln(CASE WHEN m <= 0 THEN value + abs(m) + 1e-10 ELSE value END) AS value
       FROM ship_g g JOIN mn USING (series_id, var)),
d AS (SELECT series_id, var, ts, pos, value - lag(value) OVER {W(frame='')} AS value FROM l1)
{sel_long('d')}"""

ORACLES["transform_ledger"] = f"""WITH {SHIP_GRID}
SELECT v.series_id, v.var, s.step_no, s.transformation
FROM (SELECT DISTINCT series_id, var FROM ship_g) v,
     (VALUES (CAST(1 AS BIGINT), 'log'), (CAST(2 AS BIGINT), 'diff_1')) s(step_no, transformation)"""

# ----------------------------------------------------------------- H

EV_F = EV_GRID + "," + linfill("ev_g", "ev_f")

ORACLES["trend_direction"] = f"""WITH {SHIP_GRID}, {ORD_RAW}, {grid('ord_raw', 'og', DAY)},
cum AS (SELECT series_id, 'cum_orders' AS var, pos,
               sum(COALESCE(value, 0.0)) OVER (PARTITION BY series_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS value
        FROM og WHERE var = 'n_orders'),
u AS (SELECT series_id, var, pos, value FROM ship_g UNION ALL SELECT * FROM cum),
l AS (SELECT *, lag(value) OVER {W(frame='')} AS pv FROM u)
SELECT series_id, var,
       CASE WHEN bool_and(COALESCE(value >= pv, true)) THEN 'increasing'
            WHEN bool_and(COALESCE(value <= pv, true)) THEN 'decreasing' ELSE 'unclear' END AS trend
FROM l GROUP BY series_id, var"""


def autocorr_sql(k: int) -> str:
    return f"""{EV_F},
l AS (SELECT *, lag(value, {k}) OVER {W(frame='')} AS y FROM ev_f),
a AS (SELECT series_id, var, count(*) AS n,
             covar_pop(CASE WHEN y IS NOT NULL THEN value END, CASE WHEN value IS NOT NULL THEN y END) /
             NULLIF(sqrt(var_pop(CASE WHEN y IS NOT NULL THEN value END) * var_pop(CASE WHEN value IS NOT NULL THEN y END)), 0) AS r
      FROM l GROUP BY series_id, var)"""


ORACLES["autocorr_lag12"] = f"WITH {autocorr_sql(12)} SELECT series_id, var, n, CAST(12 AS BIGINT) AS lag, {R6('r')} AS autocorr FROM a"
ORACLES["seasonality_flag"] = f"""WITH {autocorr_sql(12)}
SELECT series_id, var, n, CAST(12 AS BIGINT) AS period, {R6('r')} AS autocorr,
       (n >= 24 AND COALESCE(abs(r) > 0.5, false)) AS seasonal FROM a"""

_ACF = f"""{EV_F},
e AS (SELECT series_id, var, pos, value - avg(value) OVER (PARTITION BY series_id, var) AS e,
             count(*) OVER (PARTITION BY series_id, var) AS n FROM ev_f),
ls AS (SELECT a.series_id, a.var, k.lag, any_value(a.n) AS n, sum(a.e * b.e) AS s
       FROM e a CROSS JOIN (SELECT range AS lag FROM range(0, 41)) k
       JOIN e b ON b.series_id = a.series_id AND b.var = a.var AND b.pos = a.pos - k.lag
       GROUP BY a.series_id, a.var, k.lag),
ac AS (SELECT series_id, var, lag, n, s / NULLIF(max(CASE WHEN lag = 0 THEN s END) OVER (PARTITION BY series_id, var), 0) AS acf
       FROM ls),
bd AS (SELECT *, CASE WHEN lag = 0 THEN 0.0 ELSE 1.959963984540054 * sqrt((1 + 2 * COALESCE(
                   sum(CASE WHEN lag >= 1 THEN acf * acf END) OVER (PARTITION BY series_id, var ORDER BY lag
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / n) END AS band
       FROM ac)"""
ORACLES["acf"] = f"WITH {_ACF} SELECT series_id, var, CAST(lag AS BIGINT) AS lag, n, {R6('acf')} AS acf, {R6('band')} AS band FROM bd"
ORACLES["acf_significant_lags"] = f"""WITH {_ACF},
sg AS (SELECT *, COALESCE(abs(acf) > 2 * band, false) AS sig FROM bd),
g AS (SELECT series_id, var,
             list_sort(list(CAST(lag AS BIGINT)) FILTER (WHERE sig)) AS significant_lags,
             CAST(count(*) FILTER (WHERE sig) AS BIGINT) AS n_significant,
             CAST(max(lag) FILTER (WHERE sig) AS BIGINT) AS last_significant
      FROM sg GROUP BY series_id, var)
SELECT *, CASE WHEN n_significant = 0 THEN 'white_noise' WHEN n_significant > 20.0 THEN 'slow_decay'
               ELSE 'cutoff_' || CAST(last_significant AS VARCHAR) END AS verdict FROM g"""

ORACLES["pacf_lag12"] = f"""WITH {EV_F},
e AS (SELECT series_id, var, pos, value - avg(value) OVER (PARTITION BY series_id, var) AS e,
             count(*) OVER (PARTITION BY series_id, var) AS n FROM ev_f),
ls AS (SELECT a.series_id, a.var, k.lag, any_value(a.n) AS n, sum(a.e * b.e) / (any_value(a.n) - k.lag) AS g
       FROM e a CROSS JOIN (SELECT range AS lag FROM range(0, 3)) k
       JOIN e b ON b.series_id = a.series_id AND b.var = a.var AND b.pos = a.pos - k.lag
       GROUP BY a.series_id, a.var, k.lag),
w AS (SELECT series_id, var, any_value(n) AS n,
             max(CASE WHEN lag = 1 THEN g END) / max(CASE WHEN lag = 0 THEN g END) AS r1,
             max(CASE WHEN lag = 2 THEN g END) / max(CASE WHEN lag = 0 THEN g END) AS r2
      FROM ls GROUP BY series_id, var),
p AS (SELECT series_id, var, n, 0 AS lag, 1.0 AS pacf FROM w
      UNION ALL SELECT series_id, var, n, 1, r1 FROM w
      UNION ALL SELECT series_id, var, n, 2, (r2 - r1 * r1) / (1 - r1 * r1) FROM w)
SELECT series_id, var, CAST(lag AS BIGINT) AS lag, n, {R6('pacf')} AS pacf, {R6('1.959963984540054 / sqrt(n)')} AS band FROM p"""


def kpss_ctes(src: str, regression: str) -> str:
    """CTEs up to ``ks_o``: series_id, var, n, lags, st, pv."""
    if regression == "c":
        resid = f"""r AS (SELECT series_id, var, pos, value - avg(value) OVER (PARTITION BY series_id, var) AS e,
                    count(*) OVER (PARTITION BY series_id, var) AS n FROM {src})"""
        crit = [0.347, 0.463, 0.574, 0.739]
    else:
        resid = f"""co AS (SELECT series_id, var, regr_slope(value, pos) AS b, regr_intercept(value, pos) AS a0, count(*) AS n
                     FROM {src} GROUP BY ALL),
r AS (SELECT s.series_id, s.var, s.pos, s.value - co.a0 - co.b * s.pos AS e, co.n FROM {src} s JOIN co USING (series_id, var))"""
        crit = [0.119, 0.146, 0.176, 0.216]
    pv = [0.10, 0.05, 0.025, 0.01]
    interp = f"CASE WHEN st <= {crit[0]} THEN {pv[0]} "
    for i in range(3):
        interp += f"WHEN st <= {crit[i + 1]} THEN {pv[i]} + (st - {crit[i]}) * ({(pv[i + 1] - pv[i]) / (crit[i + 1] - crit[i])!r}) "
    interp += f"ELSE {pv[3]} END"
    return f"""{resid},
cs AS (SELECT *, sum(e) OVER (PARTITION BY series_id, var ORDER BY pos ROWS UNBOUNDED PRECEDING) AS S FROM r),
eta AS (SELECT series_id, var, any_value(n) AS n, sum(S * S) AS ss FROM cs GROUP BY ALL),
ls AS (SELECT a.series_id, a.var, k.lag, sum(a.e * b.e) AS s
       FROM r a CROSS JOIN (SELECT range AS lag FROM range(0, 300)) k
       JOIN r b ON b.series_id = a.series_id AND b.var = a.var AND b.pos = a.pos - k.lag
       GROUP BY a.series_id, a.var, k.lag),
sh AS (SELECT l.series_id, l.var, any_value(eta.n) AS n,
              sum(CASE WHEN lag = 0 THEN s / eta.n ELSE s / (eta.n / 2.0) END) AS s0,
              sum(lag * CASE WHEN lag = 0 THEN s / eta.n ELSE s / (eta.n / 2.0) END) AS s1
       FROM ls l JOIN eta USING (series_id, var) WHERE lag <= floor(pow(eta.n, 2.0 / 9.0)) GROUP BY ALL),
lg AS (SELECT series_id, var, least(CAST(floor(1.1447 * pow(pow(s1 / s0, 2), 1.0 / 3.0) * pow(n, 1.0 / 3.0)) AS BIGINT), n - 1) AS lags
       FROM sh),
lr AS (SELECT ls.series_id, ls.var, lg.lags,
              sum(CASE WHEN lag = 0 THEN s ELSE 2 * (1 - lag / (lags + 1.0)) * s END) AS lrv
       FROM ls JOIN lg USING (series_id, var) WHERE lag <= lags GROUP BY ALL),
o AS (SELECT eta.series_id, eta.var, eta.n, lr.lags, (ss / (eta.n * eta.n)) / (lrv / eta.n) AS st
      FROM eta JOIN lr USING (series_id, var)),
ks_o AS (SELECT *, {interp} AS pv FROM o)"""


for _name, _src_ctes, _src, _regression in (("kpss", SHIP_GRID, "ship_g", "c"), ("kpss_ct", EV_F, "ev_f", "ct")):
    ORACLES[_name] = f"""WITH {_src_ctes}, {kpss_ctes(_src, _regression)}
SELECT series_id, var, n, lags, {R6('st')} AS statistic, {R6('pv')} AS p_value, pv > 0.05 AS stationary FROM ks_o"""

# ----------------------------------------------------------------- J

DAILY = f"""{ORD_RAW}, {SHIP_RAW},
dw_raw AS (SELECT 'daily' AS series_id, var, ts, value FROM ord_raw UNION ALL SELECT 'daily', var, ts, value FROM ship_raw),
{grid('dw_raw', 'dw_g', DAY)},
{linfill('dw_g', 'dw_f')},
dw AS (SELECT * FROM dw_f WHERE (series_id, pos) IN
       (SELECT series_id, pos FROM dw_f GROUP BY series_id, pos HAVING count(value) = 6))"""

ORD_F = ORD_GRID + "," + linfill("ord_g", "ord_f")


def pearson_sql(src: str) -> str:
    return f"""pr AS (SELECT a.series_id, a.var AS var1, b.var AS var2, a.value AS x, b.value AS y
       FROM {src} a JOIN {src} b ON a.series_id = b.series_id AND a.pos = b.pos
       WHERE a.value IS NOT NULL AND b.value IS NOT NULL),
cm AS (SELECT series_id, var1, var2,
              CASE WHEN var1 = var2 THEN (CASE WHEN var_pop(x) > 0 THEN 1.0 END)
                   ELSE covar_pop(x, y) / NULLIF(sqrt(var_pop(x) * var_pop(y)), 0) END AS corr
       FROM pr GROUP BY series_id, var1, var2)"""


ORACLES["corr_pearson"] = f"WITH {DAILY}, {pearson_sql('dw')} SELECT series_id, var1, var2, {R6('corr')} AS corr FROM cm"
ORACLES["corr_spearman"] = f"""WITH {DAILY},
rk AS (SELECT series_id, var, pos,
              rank() OVER (PARTITION BY series_id, var ORDER BY value)
              + (count(*) OVER (PARTITION BY series_id, var, value) - 1) / 2.0 AS value
       FROM dw WHERE value IS NOT NULL),
{pearson_sql('rk')}
SELECT series_id, var1, var2, {R6('corr')} AS corr FROM cm"""
ORACLES["strong_pairs"] = f"""WITH {DAILY}, {pearson_sql('dw')}
SELECT series_id, var1, var2, {R6('corr')} AS corr,
       row_number() OVER (PARTITION BY series_id ORDER BY var1, var2) AS pair_no
FROM cm WHERE var1 < var2 AND abs(corr) > 0.7"""

_CCF = f"""{ORD_F},
w AS (SELECT series_id, pos, max(CASE WHEN var = 'revenue' THEN value END) AS x,
             max(CASE WHEN var = 'n_orders' THEN value END) AS y FROM ord_f GROUP BY series_id, pos),
st AS (SELECT series_id, avg(x) AS mx, avg(y) AS my, stddev_pop(x) AS sx, stddev_pop(y) AS sy, count(*) AS n
       FROM w GROUP BY series_id),
ls AS (SELECT a.series_id, k.lag, sum((a.x - st.mx) * (b.y - st.my)) AS s, any_value(st.n) AS n,
              any_value(st.sx * st.sy) AS sxy
       FROM w a JOIN st ON a.series_id = st.series_id CROSS JOIN (SELECT range AS lag FROM range(0, 21)) k
       JOIN w b ON b.series_id = a.series_id AND b.pos = a.pos - k.lag
       GROUP BY a.series_id, k.lag),
cc AS (SELECT series_id, 'revenue' AS var1, 'n_orders' AS var2, CAST(lag AS BIGINT) AS lag, n,
              s / (n - lag) / NULLIF(sxy, 0) AS ccf, 1.959963984540054 / sqrt(n) AS band FROM ls)"""
ORACLES["ccf"] = f"""WITH {_CCF}
SELECT series_id, var1, var2, lag, n, {R6('ccf')} AS ccf, {R6('band')} AS band,
       COALESCE(abs(ccf) > band, false) AS significant FROM cc"""
ORACLES["ccf_significant"] = f"""WITH {_CCF}
SELECT series_id, var1, var2, list_sort(list(lag) FILTER (WHERE abs(ccf) > band)) AS significant_lags,
       CAST(count(*) FILTER (WHERE abs(ccf) > band) AS BIGINT) AS n_significant
FROM cc GROUP BY series_id, var1, var2"""

ORACLES["pca_variance_2"] = f"""WITH {ORD_F},
w AS (SELECT series_id, pos, max(CASE WHEN var = 'revenue' THEN value END) AS x,
             max(CASE WHEN var = 'n_orders' THEN value END) AS y FROM ord_f GROUP BY series_id, pos),
r AS (SELECT series_id, abs(covar_pop(x, y) / sqrt(var_pop(x) * var_pop(y))) AS r FROM w
      WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY series_id)
SELECT series_id, CAST(1 AS BIGINT) AS pc, {R6('1 + r')} AS eigenvalue, {R6('(1 + r) / 2')} AS explained_variance_ratio,
       {R6('(1 + r) / 2')} AS cumulative FROM r
UNION ALL
SELECT series_id, 2, {R6('1 - r')}, {R6('(1 - r) / 2')}, 1.0 FROM r"""

ORACLES["collinear_strength"] = f"""WITH {DAILY}, {pearson_sql('dw')}
SELECT series_id, var1 AS var, {R6('sum(abs(corr)) - 1')} AS strength FROM cm GROUP BY series_id, var1"""

_SP = f"""{DAILY}, {pearson_sql('dw')},
sp AS (SELECT series_id, var1, var2, corr, row_number() OVER (PARTITION BY series_id ORDER BY var1, var2) AS pair_no
       FROM cm WHERE var1 < var2 AND abs(corr) > 0.7)"""


def combine_sql(weighted: bool) -> str:
    if weighted:
        wts = """vv AS (SELECT series_id, var, var_samp(value) AS v FROM dw GROUP BY ALL),
pw AS (SELECT sp.series_id, pair_no, var1, var2, v2.v / (v1.v + v2.v) AS w1, v1.v / (v1.v + v2.v) AS w2
       FROM sp JOIN vv v1 ON v1.series_id = sp.series_id AND v1.var = sp.var1
               JOIN vv v2 ON v2.series_id = sp.series_id AND v2.var = sp.var2)"""
        expr = "pw.w1 * a.value + pw.w2 * b.value"
    else:
        wts = "pw AS (SELECT series_id, pair_no, var1, var2 FROM sp)"
        expr = "(a.value + b.value) / 2"
    return f"""WITH {_SP}, {wts},
cb AS (SELECT a.series_id, 'combined_' || CAST(pw.pair_no AS VARCHAR) AS var, a.ts, a.pos, {expr} AS value
       FROM pw JOIN dw a ON a.series_id = pw.series_id AND a.var = pw.var1
               JOIN dw b ON b.series_id = pw.series_id AND b.var = pw.var2 AND b.pos = a.pos),
kept AS (SELECT series_id, var, ts, pos, value FROM dw
         WHERE (series_id, var) NOT IN (SELECT series_id, var1 FROM sp)),
o AS (SELECT * FROM kept UNION ALL SELECT * FROM cb)
{sel_long('o')}"""


ORACLES["collinear_combine_avg"] = combine_sql(False)
ORACLES["collinear_combine_weighted"] = combine_sql(True)

ORACLES["collinear_auto_choice"] = f"""WITH {_SP},
ps AS (SELECT series_id, avg(abs(corr)) AS m, stddev_pop(abs(corr)) AS s, count(*) AS n FROM sp GROUP BY series_id),
vv AS (SELECT series_id, var, var_samp(value) AS v FROM dw GROUP BY ALL),
cv AS (SELECT series_id, stddev_pop(v) / avg(v) AS cv FROM vv GROUP BY series_id),
j AS (SELECT d.series_id, COALESCE(ps.n, 0) AS n_pairs, ps.m, ps.s, cv.cv
      FROM (SELECT DISTINCT series_id FROM dw) d LEFT JOIN ps USING (series_id) LEFT JOIN cv USING (series_id))
SELECT series_id, n_pairs, {R6('m')} AS mean_abs_r, {R6('s')} AS std_abs_r, {R6('cv')} AS cv_importance,
       CASE WHEN n_pairs = 0 THEN 'none' WHEN m > 0.85 THEN 'pca' WHEN s > 0.2 THEN 'pca'
            WHEN cv > 0.5 THEN 'select' ELSE 'combine' END AS method
FROM j"""

# ----------------------------------------------------------------- H9 (lag 0), H11 statistic

ORACLES["adf_lag0"] = f"""WITH {SHIP_GRID},
c AS (SELECT series_id, var, pos, value - avg(value) OVER (PARTITION BY series_id, var) AS x FROM ship_g),
l AS (SELECT series_id, var, lag(x) OVER {W(frame='')} AS xl, x - lag(x) OVER {W(frame='')} AS dx FROM c),
r AS (SELECT series_id, var, regr_count(dx, xl) AS m, regr_slope(dx, xl) AS b, regr_sxx(dx, xl) AS sxx,
             regr_syy(dx, xl) AS syy, regr_sxy(dx, xl) AS sxy FROM l GROUP BY series_id, var)
SELECT series_id, var, {R6('b / sqrt(((syy - sxy * sxy / sxx) / (m - 2)) / sxx)')} AS statistic,
       CAST(0 AS BIGINT) AS used_lag, m AS nobs FROM r"""

def pp_ctes(src: str) -> str:
    """CTEs up to ``pp_o``: series_id, var, n, lags, stat."""
    return f"""pp_l AS (SELECT series_id, var, pos, value AS y, lag(value) OVER {W(frame='')} AS yl FROM {src}),
pp_r AS (SELECT series_id, var, regr_count(y, yl) AS m, regr_slope(y, yl) AS b, regr_intercept(y, yl) AS a,
             var_pop(CASE WHEN y IS NOT NULL THEN yl END) AS vy
      FROM pp_l WHERE yl IS NOT NULL AND y IS NOT NULL GROUP BY series_id, var),
pp_n AS (SELECT series_id, var, count(value) AS n FROM {src} GROUP BY ALL),
pp_u AS (SELECT l.series_id, l.var, l.pos, l.y - r.a - r.b * l.yl AS u FROM pp_l l JOIN pp_r r USING (series_id, var)
      WHERE l.yl IS NOT NULL AND l.y IS NOT NULL),
pp_lg AS (SELECT r.*, nn.n, CAST(ceil(12 * pow(nn.n / 100.0, 0.25)) AS BIGINT) AS lags
          FROM pp_r r JOIN pp_n nn USING (series_id, var)),
pp_ls AS (SELECT a.series_id, a.var, k.lag, sum(a.u * b.u) AS s
       FROM pp_u a CROSS JOIN (SELECT range AS lag FROM range(0, 60)) k
       JOIN pp_u b ON b.series_id = a.series_id AND b.var = a.var AND b.pos = a.pos - k.lag
       GROUP BY a.series_id, a.var, k.lag),
pp_lr AS (SELECT ls.series_id, ls.var, sum(CASE WHEN lag = 0 THEN s END) AS uu,
              sum(CASE WHEN lag = 0 THEN s ELSE 2 * (1 - lag / (lags + 1.0)) * s END) AS lrs
       FROM pp_ls ls JOIN pp_lg lg USING (series_id, var) WHERE lag <= lags GROUP BY ALL),
pp_t AS (SELECT lg.series_id, lg.var, lg.n, lg.lags, lg.m, lg.b, uu / lg.m AS g0, lrs / lg.m AS lam2, uu / (lg.m - 2) AS s2,
             sqrt((uu / (lg.m - 2)) / (lg.m * lg.vy)) AS se
      FROM pp_lg lg JOIN pp_lr lr USING (series_id, var)),
pp_o AS (SELECT series_id, var, n, lags,
                sqrt(g0 / lam2) * ((b - 1) / se) - 0.5 * ((lam2 - g0) / sqrt(lam2)) * (m * se / sqrt(s2)) AS stat FROM pp_t)"""


ORACLES["phillips_perron"] = f"""WITH {SHIP_GRID}, {pp_ctes('ship_g')}
SELECT series_id, var, n, lags, {R6('stat')} AS statistic FROM pp_o"""

# ----------------------------------------------------------------- K


def dft_sql(src_ctes: str, src: str) -> str:
    return f"""WITH {src_ctes},
nn AS (SELECT series_id, var, count(*) AS n FROM {src} GROUP BY ALL),
sp AS (SELECT s.series_id, s.var, k.k, any_value(nn.n) AS n,
              sum(s.value * cos(2 * pi() * ((k.k * s.pos) % nn.n) / nn.n)) AS re,
              sum(-s.value * sin(2 * pi() * ((k.k * s.pos) % nn.n) / nn.n)) AS im
       FROM {src} s JOIN nn USING (series_id, var) JOIN (SELECT range AS k FROM range(0, 10000)) k ON k.k < nn.n
       GROUP BY s.series_id, s.var, k.k)"""


EMB_L = EMB + ", eml AS (SELECT series_id, 'x' AS var, step AS pos, x AS value FROM emb)"

ORACLES["fft_spectrum"] = dft_sql(EMB_L, "eml") + f" SELECT series_id, var, CAST(k AS BIGINT) AS k, {R6('re')} AS re, {R6('im')} AS im FROM sp"
ORACLES["fft_spectrum_long"] = dft_sql(EV_F, "ev_f") + f" SELECT series_id, var, CAST(k AS BIGINT) AS k, {R6('re')} AS re, {R6('im')} AS im FROM sp"
ORACLES["fft_frequency"] = f"""WITH {EMB_L}, nn AS (SELECT series_id, var, count(*) AS n FROM eml GROUP BY ALL)
SELECT series_id, var, CAST(k.k AS BIGINT) AS k, n,
       {R6('CASE WHEN k.k < (n + 1) / 2.0 THEN k.k ELSE k.k - n END / (n * 1.0)')} AS freq
FROM nn JOIN (SELECT range AS k FROM range(0, 10000)) k ON k.k < nn.n"""
ORACLES["fft_amplitude"] = dft_sql(EMB_L, "eml") + f"""
SELECT series_id, var, CAST(k AS BIGINT) AS k, {R6('CASE WHEN k < (n + 1) / 2.0 THEN k ELSE k - n END / (n * 1.0)')} AS freq,
       {R6('2.0 / n * sqrt(re * re + im * im)')} AS amplitude
FROM sp WHERE k < n / 2.0"""
ORACLES["ifft_values"] = f"WITH {EMB_L} SELECT series_id, var, CAST(pos AS BIGINT) AS pos, {R6('value')} AS value FROM eml"
ORACLES["ifft_roundtrip"] = f"WITH {EMB_L} SELECT DISTINCT series_id, var, 0.0 AS max_abs_error FROM eml"

# ----------------------------------------------------------------- D9, A6, L2


def decompose_sql(src_ctes: str, src: str, period: int) -> str:
    half = period // 2
    f = W(frame=f"ROWS BETWEEN {half} PRECEDING AND {half} FOLLOWING")
    if period % 2:
        trend = f"CASE WHEN count(value) OVER {f} = {period} THEN avg(value) OVER {f} END"
    else:
        trend = (f"CASE WHEN count(value) OVER {f} = {period + 1} THEN (sum(value) OVER {f} - 0.5 * "
                 f"(lag(value, {half}) OVER {W(frame='')} + lead(value, {half}) OVER {W(frame='')})) / {period}.0 END")
    return f"""WITH {src_ctes},
tr AS (SELECT series_id, var, ts, pos, value, {trend} AS trend FROM {src}),
ph AS (SELECT series_id, var, pos % {period} AS phase, avg(value - trend) AS pm FROM tr GROUP BY ALL),
sz AS (SELECT series_id, var, phase, pm - avg(pm) OVER (PARTITION BY series_id, var) AS seasonal FROM ph),
dc AS (SELECT tr.*, sz.seasonal, tr.value - tr.trend - sz.seasonal AS resid
       FROM tr JOIN sz ON sz.series_id = tr.series_id AND sz.var = tr.var AND sz.phase = tr.pos % {period})"""


ORACLES["decompose_trend"] = decompose_sql(ORD_GRID, "ord_g", 24) + f" SELECT series_id, var, ts, pos, {R6('value')} AS value, {R6('trend')} AS trend FROM dc"
ORACLES["decompose_seasonal"] = decompose_sql(EV_F, "ev_f", 24) + f" SELECT series_id, var, ts, pos, {R6('seasonal')} AS seasonal FROM dc"
ORACLES["decompose_resid"] = decompose_sql(ORD_F, "ord_f", 7) + f" SELECT series_id, var, ts, pos, {R6('trend')} AS trend, {R6('seasonal')} AS seasonal, {R6('resid')} AS resid FROM dc"

ORACLES["ds_series_matrix"] = f"""WITH {EMB},
m AS (SELECT series_id, any_value(label) AS label, list(x ORDER BY step) AS v FROM emb GROUP BY series_id)
SELECT series_id, CAST(label AS BIGINT) AS label, CAST(len(v) AS BIGINT) AS n_steps,
       {R6('list_reduce(v, lambda a, b: a + b)')} AS checksum, {R6('v[1]')} AS first, {R6('v[len(v)]')} AS last FROM m"""

ORACLES["transform_compare"] = f"""WITH {SHIP_GRID},
mn AS (SELECT series_id, var, min(value) AS m FROM ship_g GROUP BY ALL),
l1 AS (SELECT g.series_id, g.var, ts, pos, ln(CASE WHEN m <= 0 THEN value + abs(m) + 1e-10 ELSE value END) AS value
       FROM ship_g g JOIN mn USING (series_id, var)),
d AS (SELECT series_id, var, ts, pos, value - lag(value) OVER {W(frame='')} AS value FROM l1)
SELECT g.series_id, g.var, g.ts, g.pos, {R6('g.value')} AS original, {R6('d.value')} AS cleaned,
       (g.value IS DISTINCT FROM d.value) AS changed, {R6('d.value - g.value')} AS delta
FROM ship_g g LEFT JOIN d ON d.series_id = g.series_id AND d.var = g.var AND d.pos = g.pos"""

# ----------------------------------------------------------------- J3 (brute force over all pairs: oracle only)

ORACLES["corr_kendall"] = f"""WITH {ORD_F},
w AS (SELECT series_id, pos, max(CASE WHEN var = 'n_orders' THEN value END) AS x,
             max(CASE WHEN var = 'revenue' THEN value END) AS y FROM ord_f GROUP BY series_id, pos),
c AS (SELECT * FROM w WHERE x IS NOT NULL AND y IS NOT NULL),
s AS (SELECT a.series_id, sum(sign(a.x - b.x) * sign(a.y - b.y)) AS S
      FROM c a JOIN c b ON a.series_id = b.series_id AND a.pos < b.pos GROUP BY a.series_id),
n AS (SELECT series_id, count(*) AS n FROM c GROUP BY series_id),
tx AS (SELECT series_id, sum(k * (k - 1) / 2) AS n1 FROM (SELECT series_id, x, count(*) AS k FROM c GROUP BY ALL) GROUP BY series_id),
ty AS (SELECT series_id, sum(k * (k - 1) / 2) AS n2 FROM (SELECT series_id, y, count(*) AS k FROM c GROUP BY ALL) GROUP BY series_id)
SELECT series_id, 'n_orders' AS var1, 'revenue' AS var2, n,
       {R6('S / sqrt((n * (n - 1) / 2 - n1) * (n * (n - 1) / 2 - n2))')} AS tau
FROM n JOIN s USING (series_id) JOIN tx USING (series_id) JOIN ty USING (series_id)"""


# ----------------------------------------------------------------- A1-A3, B8

ORACLES["src_series"] = f"""
SELECT 'orders' AS series_id, 'o_totalprice' AS var, o_orderdate AS ts, {R6('o_totalprice')} AS value FROM orders
UNION ALL
SELECT 'orders', 'o_custkey', o_orderdate, {R6('CAST(o_custkey AS DOUBLE)')} FROM orders"""

ORACLES["src_univariate"] = f"""
SELECT 'lineitem' AS series_id, 'qty' AS var, l_shipdate AS ts, {R6('l_quantity')} AS value FROM lineitem"""

_ALIGN = f"""{ORD_RAW}, {SHIP_RAW},
a AS (SELECT 'daily' AS series_id, ts, value AS revenue FROM ord_raw WHERE var = 'revenue'),
b AS (SELECT 'daily' AS series_id, ts, value AS quantity FROM ship_raw WHERE var = 'quantity')"""

ORACLES["align_outer"] = f"""WITH {_ALIGN}
SELECT COALESCE(a.series_id, b.series_id) AS series_id, COALESCE(a.ts, b.ts) AS ts,
       {R6('a.revenue')} AS revenue, {R6('b.quantity')} AS quantity
FROM a FULL OUTER JOIN b ON a.series_id = b.series_id AND a.ts = b.ts"""

ORACLES["align_left"] = f"""WITH {_ALIGN}
SELECT a.series_id, a.ts, {R6('a.revenue')} AS revenue, {R6('b.quantity')} AS quantity
FROM a LEFT JOIN b ON a.series_id = b.series_id AND a.ts = b.ts"""

# ----------------------------------------------------------------- J7 / J9 restricted forms (closed form)

_OW = f"""{ORD_F},
w AS (SELECT series_id, pos, max(CASE WHEN var = 'revenue' THEN value END) AS y,
             max(CASE WHEN var = 'n_orders' THEN value END) AS x FROM ord_f GROUP BY series_id, pos)"""

ORACLES["granger_lag1"] = f"""WITH {_OW},
l AS (SELECT series_id, y, lag(y) OVER (PARTITION BY series_id ORDER BY pos) AS y1,
             lag(x) OVER (PARTITION BY series_id ORDER BY pos) AS x1 FROM w),
m AS (SELECT series_id, count(*) AS n,
             count(*) * var_pop(y) AS syy, count(*) * var_pop(y1) AS s11, count(*) * var_pop(x1) AS s22,
             count(*) * covar_pop(y1, x1) AS s12, count(*) * covar_pop(y, y1) AS sy1, count(*) * covar_pop(y, x1) AS sy2
      FROM l WHERE y1 IS NOT NULL AND x1 IS NOT NULL GROUP BY series_id),
r AS (SELECT *, syy - sy1 * sy1 / s11 AS ssr_r,
             syy - ((sy1 * s22 - sy2 * s12) * sy1 + (sy2 * s11 - sy1 * s12) * sy2) / (s11 * s22 - s12 * s12) AS ssr_u
      FROM m)
SELECT series_id, 'revenue' AS dependent, 'n_orders' AS independent, CAST(1 AS BIGINT) AS lag,
       {R6('(ssr_r - ssr_u) / (ssr_u / (n - 3))')} AS f_stat, CAST(1 AS BIGINT) AS df_num, n - 3 AS df_denom FROM r"""

ORACLES["cointegration_eg_lag0"] = f"""WITH {_OW},
co AS (SELECT series_id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM w
       WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY series_id),
e AS (SELECT w.series_id, w.pos, w.y - co.a - co.b * w.x AS e FROM w JOIN co USING (series_id)),
d AS (SELECT series_id, e - lag(e) OVER (PARTITION BY series_id ORDER BY pos) AS de,
             lag(e) OVER (PARTITION BY series_id ORDER BY pos) AS e1 FROM e),
s AS (SELECT series_id, count(*) AS m, sum(de * e1) AS sde, sum(e1 * e1) AS see, sum(de * de) AS sdd
      FROM d WHERE e1 IS NOT NULL GROUP BY series_id)
SELECT series_id, 'revenue~n_orders' AS var,
       {R6('(sde / see) / sqrt(((sdd - (sde / see) * sde) / (m - 1)) / see)')} AS statistic,
       CAST(0 AS BIGINT) AS used_lag, m AS nobs FROM s"""

# ----------------------------------------------------------------- D7, J24

_F7 = W(frame="ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING")
ORACLES["fill_seasonal"] = f"""WITH {EV_GRID},
a AS (SELECT *, value AS orig FROM ev_g),
{linfill('a', 'l')},
tr AS (SELECT *, CASE WHEN count(orig) OVER {_F7} = 7 THEN avg(orig) OVER {_F7} END AS trend FROM l),
{linfill('tr', 't1', 'trend')},
ph AS (SELECT series_id, var, pos % 7 AS phase, avg(orig - trend) AS pm FROM t1 GROUP BY ALL),
sz AS (SELECT series_id, var, phase, pm - avg(pm) OVER (PARTITION BY series_id, var) AS seasonal FROM ph),
dc AS (SELECT t1.*, sz.seasonal, t1.orig - t1.trend - sz.seasonal AS resid
       FROM t1 JOIN sz ON sz.series_id = t1.series_id AND sz.var = t1.var AND sz.phase = t1.pos % 7),
{linfill('dc', 't2', 'resid')},
o AS (SELECT series_id, var, ts, pos, COALESCE(orig, trend + seasonal + resid, value) AS value FROM t2)
{sel_long('o')}"""

_EFFECT = f"""{_SP},
pw AS (SELECT series_id, pair_no, var1, var2 FROM sp),
cb AS (SELECT a.series_id, 'combined_' || CAST(pw.pair_no AS VARCHAR) AS var, a.pos, (a.value + b.value) / 2 AS value
       FROM pw JOIN dw a ON a.series_id = pw.series_id AND a.var = pw.var1
               JOIN dw b ON b.series_id = pw.series_id AND b.var = pw.var2 AND b.pos = a.pos),
kept AS (SELECT series_id, var, pos, value FROM dw WHERE (series_id, var) NOT IN (SELECT series_id, var1 FROM sp)),
af AS (SELECT * FROM kept UNION ALL SELECT * FROM cb),
pa AS (SELECT a.series_id, a.var AS var1, b.var AS var2, a.value AS x, b.value AS y
       FROM af a JOIN af b ON a.series_id = b.series_id AND a.pos = b.pos
       WHERE a.value IS NOT NULL AND b.value IS NOT NULL),
ca AS (SELECT series_id, var1, var2,
              CASE WHEN var1 = var2 THEN (CASE WHEN var_pop(x) > 0 THEN 1.0 END)
                   ELSE covar_pop(x, y) / NULLIF(sqrt(var_pop(x) * var_pop(y)), 0) END AS corr
       FROM pa GROUP BY series_id, var1, var2)"""

ORACLES["collinear_effect"] = f"""WITH {_EFFECT},
mb AS (SELECT series_id, sum(CASE WHEN var1 <> var2 THEN abs(corr) ELSE 0.0 END) / count(*) AS b FROM cm GROUP BY series_id),
ma AS (SELECT series_id, sum(CASE WHEN var1 <> var2 THEN abs(corr) ELSE 0.0 END) / count(*) AS a FROM ca GROUP BY series_id)
SELECT series_id, {R6('b')} AS mean_abs_before, {R6('a')} AS mean_abs_after, {R6('(b - a) / NULLIF(b, 0) * 100.0')} AS reduction_pct
FROM mb JOIN ma USING (series_id)"""

ORACLES["collinear_effect_pairs"] = f"""WITH {_EFFECT}
SELECT series_id, var1, var2, {R6('b.corr')} AS corr_before, {R6('a.corr')} AS corr_after
FROM (SELECT * FROM cm WHERE var1 < var2) b FULL JOIN (SELECT * FROM ca WHERE var1 < var2) a USING (series_id, var1, var2)"""

# ------------------------------------------- regression tests, with their own lag choice and p-values

for _name, _ic in (("adf", "AIC"), ("adf_bic", "BIC")):
    ORACLES[_name] = f"""WITH {SHIP_GRID}, {ro.adf_ctes('ship_g', True, _ic, 1)},
o AS (SELECT *, {ro.mackinnon_sql('stat', 1, 'c')} AS pv FROM adf_o)
SELECT series_id, var, {ro.adf_columns(R6, 1, 'c')} FROM o"""

ORACLES["granger"] = f"""WITH {_OW}, w2 AS (SELECT series_id, 'granger' AS var, pos, y, x FROM w),
{ro.granger_ctes('w2', 4)},
o AS (SELECT *, {ro.f_sf_sql('f', 'lag', 'dfd')} AS pv FROM gr_o)
SELECT series_id, 'revenue' AS dependent, 'n_orders' AS independent, CAST(lag AS BIGINT) AS lag, {R6('f')} AS f_stat,
       {R6('pv')} AS p_value, CAST(lag AS BIGINT) AS df_num, dfd AS df_denom, pv < 0.05 AS significant FROM o"""

ORACLES["cointegration_eg"] = f"""WITH {_OW},
co AS (SELECT series_id, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM w
       WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY series_id),
e AS (SELECT w.series_id, 'revenue~n_orders' AS var, w.pos, w.y - co.a - co.b * w.x AS value FROM w JOIN co USING (series_id)),
{ro.adf_ctes('e', False, 'AIC', 2)},
o AS (SELECT *, {ro.mackinnon_sql('stat', 2, 'c')} AS pv FROM adf_o)
SELECT series_id, var, {ro.adf_columns(R6, 2, 'c')}, {R6('b')} AS slope, {R6('a')} AS intercept, pv < 0.05 AS cointegrated
FROM o JOIN co USING (series_id)"""

ORACLES["phillips_perron_p"] = f"""WITH {SHIP_GRID}, {pp_ctes('ship_g')},
q AS (SELECT *, {ro.mackinnon_sql('stat', 1, 'c')} AS pv FROM pp_o)
SELECT series_id, var, n, lags, {R6('stat')} AS statistic, {R6('pv')} AS p_value, pv <= 0.05 AS stationary FROM q"""

_VERDICTS = f"""{SHIP_GRID}, {kpss_ctes('ship_g', 'c')},
{ro.adf_ctes('ship_g', True, 'AIC', 1)},
ap AS (SELECT *, {ro.mackinnon_sql('stat', 1, 'c')} AS adf_p FROM adf_o),
vd AS (SELECT series_id, var, adf_p, adf_p <= 0.05 AS adf_stationary, pv AS kpss_p, pv > 0.05 AS kpss_stationary,
              CASE WHEN adf_p <= 0.05 AND pv > 0.05 THEN 'strictly_stationary'
                   WHEN adf_p > 0.05 AND pv <= 0.05 THEN 'non_stationary'
                   WHEN adf_p <= 0.05 THEN 'trend_stationary' ELSE 'difference_stationary' END AS conclusion
       FROM ap JOIN ks_o USING (series_id, var))"""
_VERDICT_COLUMNS = (f"series_id, var, {R6('adf_p')} AS adf_p, adf_stationary, {R6('kpss_p')} AS kpss_p, kpss_stationary, "
                    "conclusion")
ORACLES["stationarity_verdict"] = f"WITH {_VERDICTS} SELECT {_VERDICT_COLUMNS} FROM vd"
ORACLES["stationarity_report"] = f"""WITH {_VERDICTS}, {pp_ctes('ship_g')},
q AS (SELECT series_id, var, {ro.mackinnon_sql('stat', 1, 'c')} AS pp_p FROM pp_o),
j AS (SELECT vd.*, pp_p FROM vd JOIN q USING (series_id, var))
SELECT {_VERDICT_COLUMNS}, {R6('pp_p')} AS pp_p,
       CASE WHEN adf_stationary AND pp_p <= 0.05 AND kpss_stationary THEN 'stationary'
            WHEN NOT adf_stationary AND pp_p > 0.05 AND NOT kpss_stationary THEN 'non_stationary'
            WHEN NOT kpss_stationary THEN 'non_stationary_difference_and_retest' ELSE 'mixed' END AS summary
FROM j"""

# ------------------------------------------- principal components, by Jacobi rotations

_DAILY_VARS = ["discount", "n_orders", "price", "quantity", "revenue", "tax"]
_PCA = f"{DAILY}, {ro.pca_ctes('dw', _DAILY_VARS)}"
_SCORES = f"SELECT series_id, var, ts, pos, {R6('value')} AS value FROM pc_t"
ORACLES["pca_variance"] = f"""WITH {_PCA}
SELECT series_id, pc, {R6('eigenvalue')} AS eigenvalue, {R6('ratio')} AS explained_variance_ratio,
       {R6('cumulative')} AS cumulative FROM pc_c"""
ORACLES["pca_loadings"] = f"WITH {_PCA} SELECT series_id, var, pc, {R6('loading')} AS loading FROM pc_l"
ORACLES["pca_n80"] = f"""WITH {_PCA} SELECT series_id, min(pc) AS n_components FROM pc_c
WHERE cumulative >= 0.8 - 1e-12 GROUP BY series_id"""
ORACLES["pca_top_features"] = f"""WITH {_PCA},
r AS (SELECT series_id, pc, var, abs(loading) AS a, row_number() OVER (PARTITION BY series_id, pc ORDER BY abs(loading) DESC, var) AS rank
      FROM pc_l)
SELECT series_id, pc, rank, var, {R6('a')} AS abs_loading FROM r WHERE rank <= 3"""
ORACLES["pca_scores"] = f"WITH {_PCA}, {ro.pca_score_ctes('dw', 6)} {_SCORES}"
ORACLES["collinear_pca"] = f"WITH {_PCA}, {ro.pca_score_ctes('dw', 3)} {_SCORES}"


def greedy_ctes(pairs: str, score: str, victim: str, name: str) -> str:
    """``name``: series_id, gone (list) of a walk over ``pairs`` in order of pair_no; ``score``: series_id, var, x."""
    return f"""{name}_p AS (SELECT p.series_id, p.pair_no, p.var1, p.var2, a.x AS x1, b.x AS x2 FROM {pairs} p
     JOIN {score} a ON a.series_id = p.series_id AND a.var = p.var1 JOIN {score} b ON b.series_id = p.series_id AND b.var = p.var2),
{name}_g AS (SELECT DISTINCT series_id, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS gone FROM {name}_p
     UNION ALL
     SELECT g.series_id, p.pair_no, CASE WHEN list_contains(gone, var1) OR list_contains(gone, var2) THEN gone
            ELSE list_append(gone, {victim}) END
     FROM {name}_g g JOIN {name}_p p ON p.series_id = g.series_id AND p.pair_no = g.k + 1),
{name} AS (SELECT series_id, unnest(gone) AS var FROM (SELECT series_id, arg_max(gone, k) AS gone FROM {name}_g GROUP BY series_id))"""


_STRENGTH = "sc AS (SELECT series_id, var1 AS var, sum(abs(corr)) - 1 AS x FROM cm GROUP BY ALL)"
_IMPORTANCE = "im AS (SELECT series_id, var, var_samp(value) AS x FROM dw GROUP BY ALL)"
_DROPPED = f"{_STRENGTH}, {greedy_ctes('sp', 'sc', 'CASE WHEN x1 > x2 THEN var1 ELSE var2 END', 'dr')}"
_SELECTED = f"{_IMPORTANCE}, {greedy_ctes('sp', 'im', 'CASE WHEN x1 > x2 THEN var2 ELSE var1 END', 'sl')}"
ORACLES["collinear_drop"] = f"WITH RECURSIVE {_SP}, {_DROPPED} SELECT series_id, var FROM dr"
ORACLES["collinear_select"] = f"WITH RECURSIVE {_SP}, {_SELECTED} SELECT series_id, var FROM sl"

_CHOICE = ORACLES["collinear_auto_choice"].removeprefix(f"WITH {_SP},")
_HANDLED = f"""{_SP}, {ro.pca_ctes('dw', _DAILY_VARS)}, {ro.pca_score_ctes('dw', 3)}, {_DROPPED}, {_SELECTED},
ch AS (WITH {_CHOICE})"""
ORACLES["collinear_handle_auto"] = f"""WITH RECURSIVE {_HANDLED},
cb AS (SELECT a.series_id, 'combined_' || CAST(sp.pair_no AS VARCHAR) AS var, a.ts, a.pos, (a.value + b.value) / 2 AS value
       FROM sp JOIN dw a ON a.series_id = sp.series_id AND a.var = sp.var1
               JOIN dw b ON b.series_id = sp.series_id AND b.var = sp.var2 AND b.pos = a.pos),
al AS (SELECT 'pca' AS method, series_id, var, ts, pos, value FROM pc_t
       UNION ALL SELECT 'none', series_id, var, ts, pos, value FROM dw
       UNION ALL SELECT 'select', series_id, var, ts, pos, value FROM dw WHERE (series_id, var) NOT IN (SELECT series_id, var FROM sl)
       UNION ALL SELECT 'combine', series_id, var, ts, pos, value FROM dw WHERE (series_id, var) NOT IN (SELECT series_id, var1 FROM sp)
       UNION ALL SELECT 'combine', * FROM cb),
o AS (SELECT al.* FROM al JOIN ch USING (series_id, method))
{sel_long('o')}"""
ORACLES["processing_log"] = f"""WITH RECURSIVE {_HANDLED},
vs AS (SELECT DISTINCT series_id, var FROM dw),
nm AS (SELECT 'drop' AS method, series_id, 'removed ' || string_agg(var, ', ' ORDER BY var) AS names FROM dr GROUP BY series_id
       UNION ALL SELECT 'select', series_id, 'kept ' || string_agg(var, ', ' ORDER BY var) FROM vs
                 WHERE (series_id, var) NOT IN (SELECT series_id, var FROM sl) GROUP BY series_id
       UNION ALL SELECT 'combine', series_id, 'combined ' || string_agg('combined_' || pair_no, ', ' ORDER BY 'combined_' || pair_no)
                 FROM sp GROUP BY series_id
       UNION ALL SELECT 'pca', series_id, string_agg('PC' || pc, ', ' ORDER BY pc) FROM pc_c WHERE pc <= 3 GROUP BY series_id),
asked AS (SELECT m AS asked, ch.series_id, CASE WHEN m = 'auto' THEN ch.method WHEN ch.n_pairs = 0 THEN 'none' ELSE m END AS method
          FROM ch CROSS JOIN (SELECT unnest(['pca', 'drop', 'combine', 'select', 'auto']) AS m)),
ev AS (SELECT series_id, sum(ratio) AS r FROM pc_c WHERE pc <= 3 GROUP BY series_id)
SELECT series_id, 'correlation_handling' AS step, method, 'threshold=0.7' || coalesce('; ' || names, '') AS details,
       CASE WHEN method = 'pca' THEN 3.0 END AS n_components, CASE WHEN method = 'pca' THEN {R6('r')} END AS explained_variance, asked
FROM asked LEFT JOIN nm USING (series_id, method) LEFT JOIN ev USING (series_id)"""

# ------------------------------------------- partial autocorrelations by the Durbin-Levinson recursion

_PACF = f"""{EV_F},
e AS (SELECT series_id, var, pos, value - avg(value) OVER (PARTITION BY series_id, var) AS e,
             count(*) OVER (PARTITION BY series_id, var) AS n FROM ev_f),
ls AS (SELECT a.series_id, a.var, k.lag, any_value(a.n) AS n, sum(a.e * b.e) / (any_value(a.n) - k.lag) AS g
       FROM e a CROSS JOIN (SELECT range AS lag FROM range(0, 41)) k
       JOIN e b ON b.series_id = a.series_id AND b.var = a.var AND b.pos = a.pos - k.lag
       GROUP BY a.series_id, a.var, k.lag),
gs AS (SELECT series_id, var, any_value(n) AS n, list(g ORDER BY lag) AS g FROM ls GROUP BY series_id, var),
dl AS (SELECT series_id, var, n, g, 0 AS lag, CAST([] AS DOUBLE[]) AS phi, g[1] AS v, CAST(1.0 AS DOUBLE) AS pacf FROM gs
       UNION ALL
       SELECT series_id, var, n, g, lag + 1,
              list_append(list_transform(range(1, lag + 1), lambda j: phi[j] - pk * phi[lag + 1 - j]), pk), v * (1 - pk * pk), pk
       FROM (SELECT *, (g[lag + 2] - coalesce(list_sum(list_transform(range(1, lag + 1), lambda j: phi[j] * g[lag + 2 - j])), 0)) / v AS pk
             FROM dl WHERE lag < 40)),
p AS (SELECT series_id, var, CAST(lag AS BIGINT) AS lag, n, pacf, 1.959963984540054 / sqrt(n) AS band FROM dl)"""
ORACLES["pacf"] = f"WITH RECURSIVE {_PACF} SELECT series_id, var, lag, n, {R6('pacf')} AS pacf, {R6('band')} AS band FROM p"
ORACLES["pacf_significant_lags"] = f"""WITH RECURSIVE {_PACF},
q AS (SELECT series_id, var, list_sort(list(lag) FILTER (WHERE abs(pacf) > band)) AS significant_lags,
             CAST(count(*) FILTER (WHERE abs(pacf) > band) AS BIGINT) AS n_significant,
             max(lag) FILTER (WHERE abs(pacf) > band) AS last_significant FROM p GROUP BY series_id, var)
SELECT *, CASE WHEN n_significant = 0 THEN 'white_noise' WHEN n_significant > 20 THEN 'slow_decay'
               ELSE 'cutoff_' || CAST(last_significant AS VARCHAR) END AS verdict FROM q"""


# ----------------------------------------------------------------- splines


def knots_sql(src: str) -> str:
    """kn: knots with number k, count m, spacing h and secant d to the next knot;
    onp: every row with the number i of the piece that it lies on (of the end piece outside)."""
    part = "PARTITION BY series_id, var ORDER BY pos"
    return f"""
kn AS (
  SELECT series_id, var, CAST(pos AS DOUBLE) AS x, value AS y, row_number() OVER ({part}) - 1 AS k,
         count(*) OVER (PARTITION BY series_id, var) AS m, lead(pos) OVER ({part}) - pos AS h,
         (lead(value) OVER ({part}) - value) / (lead(pos) OVER ({part}) - pos) AS d
  FROM {src} WHERE value IS NOT NULL),
onp AS (
  SELECT *, CASE WHEN n < 2 THEN 0 ELSE greatest(0, least(seen - 1, n - 2)) END AS i
  FROM (SELECT *, count(value) OVER {W()} AS seen, count(value) OVER (PARTITION BY series_id, var) AS n FROM {src}) c)"""


# quadratic: slopes s' = 2d - s as an alternating sum, the first from the parabola through three knots
ORACLES["upsample_quadratic"] = f"""WITH {ORD_RAW}, {grid('ord_raw', 'u', HOUR)}, {knots_sql('u')},
s0 AS (
  SELECT a.series_id, a.var, a.d - COALESCE(a.h * (b.d - a.d) / (a.h + b.h), 0) AS s0
  FROM kn a LEFT JOIN kn b ON b.series_id = a.series_id AND b.var = a.var AND b.k = 1 WHERE a.k = 0),
sl AS (
  SELECT kn.*, (1 - 2 * (k % 2)) * (s0 - 2 * COALESCE(sum((1 - 2 * (k % 2)) * d) OVER
    (PARTITION BY kn.series_id, kn.var ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS s
  FROM kn JOIN s0 ON s0.series_id = kn.series_id AND s0.var = kn.var),
o AS (
  SELECT a.series_id, a.var, a.ts, a.pos,
         COALESCE(a.value, CASE WHEN a.seen BETWEEN 1 AND a.n - 1
                                THEN l.y + l.s * (a.pos - l.x) + (l.d - l.s) / l.h * (a.pos - l.x) * (a.pos - l.x) END) AS value
  FROM onp a LEFT JOIN sl l ON l.series_id = a.series_id AND l.var = a.var AND l.k = a.i)
SELECT series_id, var, ts, pos, {R6('value')} AS value
FROM (SELECT * REPLACE (floor(value * 1e3 + 0.318309886) / 1e3 AS value) FROM o) t"""

# cubic: equations of the inner knots with the not-a-knot ends put in, eliminated knot by knot
ORACLES["fill_spline"] = f"""WITH RECURSIVE {EV_GRID}, {knots_sql('ev_g')},
nb AS (
  SELECT *, lag(h) OVER (PARTITION BY series_id, var ORDER BY k) AS hp, lag(d) OVER (PARTITION BY series_id, var ORDER BY k) AS dp
  FROM kn),
eq AS MATERIALIZED (
  SELECT series_id, var, k, m, 6 * (d - dp) AS r,
         CASE WHEN k = 1 THEN 0 WHEN k = m - 2 THEN hp - h * h / hp ELSE hp END AS lo,
         2 * (hp + h) + CASE WHEN k = 1 THEN hp * (1 + hp / h) ELSE 0 END
                      + CASE WHEN k = m - 2 THEN h * (1 + h / hp) ELSE 0 END AS di,
         CASE WHEN k = m - 2 THEN 0 WHEN k = 1 THEN h - hp * hp / h ELSE h END AS up
  FROM nb WHERE m >= 4 AND k BETWEEN 1 AND m - 2),
fw AS (
  SELECT series_id, var, k, m, up / di AS c, r / di AS e FROM eq WHERE k = 1
  UNION ALL
  SELECT q.series_id, q.var, q.k, q.m, q.up / (q.di - q.lo * f.c), (q.r - q.lo * f.e) / (q.di - q.lo * f.c)
  FROM fw f JOIN eq q ON q.series_id = f.series_id AND q.var = f.var AND q.k = f.k + 1),
fwd AS MATERIALIZED (SELECT * FROM fw),
bw AS (
  SELECT series_id, var, k, e AS b FROM fwd WHERE k = m - 2
  UNION ALL
  SELECT f.series_id, f.var, f.k, f.e - f.c * w.b
  FROM bw w JOIN fwd f ON f.series_id = w.series_id AND f.var = w.var AND f.k = w.k - 1),
inn AS (SELECT n.*, bw.b FROM nb n LEFT JOIN bw ON bw.series_id = n.series_id AND bw.var = n.var AND bw.k = n.k),
nx AS (
  SELECT *, lead(b) OVER p AS b1, lead(b, 2) OVER p AS b2, lag(b) OVER p AS p1, lag(b, 2) OVER p AS p2,
         lead(h) OVER p AS h1, lag(h, 2) OVER p AS hpp
  FROM inn WINDOW p AS (PARTITION BY series_id, var ORDER BY k)),
cu AS (
  SELECT series_id, var, k, m, x, y, h, d,
         CASE WHEN k = 0 THEN b1 + h / h1 * (b1 - b2) WHEN k = m - 1 THEN p1 + hp / hpp * (p1 - p2) ELSE b END AS b
  FROM nx),
pc AS (SELECT *, lead(b) OVER (PARTITION BY series_id, var ORDER BY k) AS bn FROM cu),
o AS (
  SELECT a.series_id, a.var, a.ts, a.pos,
         COALESCE(a.value,
                  CASE WHEN p.m = 1 THEN p.y
                       WHEN p.m < 4 THEN p.y + p.d * (a.pos - p.x)
                       ELSE p.y + (p.d - p.h * (2 * p.b + p.bn) / 6) * (a.pos - p.x) + p.b / 2 * (a.pos - p.x) ** 2
                            + (p.bn - p.b) / (6 * p.h) * (a.pos - p.x) ** 3 END) AS value
  FROM onp a LEFT JOIN pc p ON p.series_id = a.series_id AND p.var = a.var AND p.k = a.i)
{sel_long('o')}"""


# ----------------------------------------------------------------- default paths and options


def boxcox_ll(name: str, lams: str) -> str:
    """Profile log-likelihood of every candidate (series_id, var, l), x divided by its geometric mean."""
    return f"""
{name} AS (
  SELECT s.series_id, s.var, l,
         -sum(lx) - count(*) / 2.0 * ln(var_pop(CASE WHEN l = 0 THEN lz ELSE (exp(l * lz) - 1) / l END)) AS llf
  FROM lg s JOIN {lams} c ON c.series_id = s.series_id AND c.var = s.var GROUP BY s.series_id, s.var, l)"""


# tenths over a wide range, then all thousandths around the best tenth
ORACLES["boxcox_ml_lambda"] = f"""WITH {_BC},
lg AS (SELECT series_id, var, ln(x) AS lx, ln(x) - avg(ln(x)) OVER (PARTITION BY series_id, var) AS lz FROM sx WHERE x IS NOT NULL),
tn AS (SELECT series_id, var, i / 10.0::DOUBLE AS l FROM mn, (SELECT unnest(generate_series(-80, 80)) AS i)),{boxcox_ll('l1', 'tn')},
b1 AS (SELECT series_id, var, arg_max(l, llf) AS l FROM l1 GROUP BY ALL),
th AS (SELECT series_id, var, l + i / 1000.0::DOUBLE AS l FROM b1, (SELECT unnest(generate_series(-110, 110)) AS i)),{boxcox_ll('l2', 'th')}
SELECT series_id, var, {R6('arg_max(l, llf)')} AS lmbda, {R6('max(llf)')} AS llf FROM l2 GROUP BY series_id, var"""

ORACLES["transform_columns"] = f"""WITH {SHIP_GRID},
d AS (SELECT series_id, var, ts, pos, CASE WHEN var IN ('price', 'tax') THEN value - lag(value) OVER {W(frame='')} ELSE value END AS value
      FROM ship_g)
{sel_long('d')}"""

_MA3 = W(frame="ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING")
_LOESS_CTES = ORACLES["smooth_loess"].split("nk AS", 1)[1].rsplit("SELECT", 1)[0].replace("FROM lf ", "FROM user_ev ").replace(
    "JOIN lf ", "JOIN user_ev ").replace("JOIN nk USING (series_id, var))", "JOIN nk USING (series_id, var) WHERE k >= 2)")
ORACLES["smooth_loess_fallback"] = f"""WITH {USER_EV},
nk AS{_LOESS_CTES},
ma AS (SELECT u.series_id, u.var, u.ts, u.pos,
              CASE WHEN count(u.value) OVER {_MA3.replace('series_id, var', 'u.series_id, u.var')} = 3
                   THEN avg(u.value) OVER {_MA3.replace('series_id, var', 'u.series_id, u.var')} ELSE u.value END AS value, nk.k
       FROM user_ev u JOIN nk ON nk.series_id = u.series_id AND nk.var = u.var),
al AS (SELECT * FROM o UNION ALL SELECT series_id, var, ts, pos, value FROM ma WHERE k < 2)
{sel_long('al')}"""

ORACLES["src_text_time"] = f"""
SELECT event_type AS series_id, 'value' AS var, CASE WHEN event_id % 10 <> 0 THEN date_trunc('second', ts) END AS ts,
       {R6('CAST(value AS DOUBLE)')} AS value FROM events"""

ORACLES["upsample_linear_seconds"] = f"WITH {EV_RAW_H}, {grid('ev_h', 'u', 1_200_000_000)}, {linfill('u', 'f')} {sel_long('f')}"

ORACLES["ds_matrix"] = f"""WITH {EMB},
r AS (SELECT series_id, label, step // 2 AS t,
             string_agg(CAST(CAST(floor(x * 1e6 + 0.5) AS BIGINT) AS VARCHAR), ',' ORDER BY step) AS row_text
      FROM emb GROUP BY ALL)
SELECT 'train' AS split, CAST(label AS VARCHAR) AS label, series_id, count(*) AS n_steps,
       string_agg(row_text, ';' ORDER BY t) AS matrix FROM r GROUP BY series_id, label"""
