"""DuckDB SQL of the regression tests: least squares by successive projection.

A design is a table with one column per regressor and ``y``; each step takes one
column out of all later ones (modified Gram-Schmidt), so the residual sum of
squares of every nested model and the last column's coefficient appear without
any matrix.  Normal and F probabilities are Simpson sums of their densities.
"""

from __future__ import annotations

import math

from tsforge.functions import dist

PART = "PARTITION BY series_id, var"


def norm_cdf_sql(z: str, steps: int = 400) -> str:
    z = f"greatest(-12, least(12, {z}))"
    weight = f"CASE WHEN k IN (0, {steps}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
    return (f"(0.5 + list_sum(list_transform(range(0, {steps + 1}), lambda k: ({weight}) * exp(-pow({z} * k / {steps}.0, 2) / 2)))"
            f" * ({z}) / {3 * steps}.0 / {math.sqrt(2 * math.pi)!r})")


def f_sf_sql(f: str, d1: str, d2: str, steps: int = 4000) -> str:
    """P(F > f) = 2 / B(d2/2, d1/2) ∫ (1 - u²)^(d2/2 - 1) u^(d1 - 1) du from sqrt(d1 f / (d2 + d1 f)) to 1."""
    lo = f"sqrt({d1} * {f} / ({d2} + {d1} * {f}))"
    # the integrand is below 1e-17 of its peak from there on
    hi = f"least(1.0, {lo} + 14 / sqrt({d2}))"
    u = f"({lo} + ({hi} - {lo}) * k / {steps}.0)"
    weight = f"CASE WHEN k IN (0, {steps}) THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END"
    beta = f"exp(lgamma(({d1} + {d2}) / 2.0) - lgamma({d1} / 2.0) - lgamma({d2} / 2.0))"
    return (f"(2 * {beta} * ({hi} - {lo}) / {3 * steps}.0 * list_sum(list_transform(range(0, {steps + 1}), "
            f"lambda k: ({weight}) * pow(greatest(0.0, 1 - {u} * {u}), {d2} / 2.0 - 1) * pow({u}, {d1} - 1))))")


def poly(coef, x: str) -> str:
    return "(" + " + ".join(f"({c!r}) * pow({x}, {i})" for i, c in enumerate(coef)) + ")"


def mackinnon_sql(stat: str, n_vars: int, case: str) -> str:
    star, lo, hi, small, large = (dist.MACKINNON_C if case == "c" else dist.MACKINNON_N)[n_vars]
    top = "" if math.isinf(hi) else f"WHEN {stat} > {hi} THEN 1.0 "
    z = f"(CASE WHEN {stat} <= {star} THEN {poly(small, stat)} ELSE {poly(large, stat)} END)"
    return f"(CASE {top}WHEN {stat} < {lo} THEN 0.0 ELSE {norm_cdf_sql(z)} END)"


def project(src: str, name: str, cols: list[str], rest: list[str], keep: str = "pos") -> tuple[str, list[str]]:
    """CTEs ``name``_1.. that take ``cols`` out of ``rest`` and each other in turn; also their names."""
    out, names, at = [], [], src
    for k, c in enumerate(cols):
        later = [*cols[k + 1 :], *rest]
        names.append(f"{name}_{k + 1}")
        coef = [f"{x} - coalesce(sum({x} * {c}) OVER ({PART}) / nullif(sum({c} * {c}) OVER ({PART}), 0), 0) * {c} AS {x}"
                for x in later]
        out.append(f"{names[-1]} AS MATERIALIZED (SELECT series_id, var, {keep}, {', '.join(coef)} FROM {at})")
        at = names[-1]
    return ",\n".join(out), names


def adf_ctes(src: str, trend: bool, ic: str, n_vars: int, maxlag: int = 30) -> str:
    """CTEs up to ``adf_o``: series_id, var, stat, p, nobs, icbest.  ``maxlag`` bounds the automatic one."""
    nt = int(trend)
    lags = [f"d{j}" for j in range(1, maxlag + 1)]
    one = ["one"] if trend else []
    base = "value - avg(value) OVER (PARTITION BY series_id, var)" if trend else "value"
    lagged = ", ".join(f"lag(dx, {j}) OVER ({PART} ORDER BY pos) AS d{j}" for j in range(1, maxlag + 1))
    chosen = ", ".join(f"CASE WHEN {j} <= ml THEN d{j} ELSE 0 END AS d{j}" for j in range(1, maxlag + 1))
    final = ", ".join(f"CASE WHEN {j} <= best THEN d{j} ELSE 0 END AS d{j}" for j in range(1, maxlag + 1))
    select, steps = project("adf_s", "adf_a", [*one, "xl", *lags], ["y"])
    last, ends = project("adf_t", "adf_b", [*one, *lags], ["xl", "y"], keep="pos, best, icbest")
    scores = "\nUNION ALL ".join(f"SELECT series_id, var, {p} AS p, sum(y * y) AS ssr, count(*) AS nob FROM {s} GROUP BY ALL"
                                 for p, s in enumerate(steps[nt:]))
    penalty = f"2 * (p + {nt + 1})" if ic == "AIC" else f"ln(nob) * (p + {nt + 1})"
    return f"""adf_x AS (SELECT series_id, var, pos, {base} AS x FROM {src}),
adf_n AS (SELECT series_id, var, CAST(least(floor(count(x) / 2.0) - {nt + 1}, ceil(12 * pow(count(x) / 100.0, 0.25))) AS BIGINT) AS ml
          FROM adf_x GROUP BY ALL),
adf_d AS (SELECT *, x - lag(x) OVER ({PART} ORDER BY pos) AS dx, lag(x) OVER ({PART} ORDER BY pos) AS xl FROM adf_x),
adf_l AS MATERIALIZED (SELECT series_id, var, pos, dx AS y, xl, 1.0 AS one, {lagged} FROM adf_d),
adf_s AS MATERIALIZED (SELECT series_id, var, pos, one, xl, y, {chosen} FROM adf_l JOIN adf_n USING (series_id, var) WHERE pos > ml),
{select},
adf_c AS ({scores}),
adf_i AS (SELECT c.series_id, c.var, p, nob * (ln(2 * pi()) + ln(ssr / nob) + 1) + {penalty} AS ic
          FROM adf_c c JOIN adf_n USING (series_id, var) WHERE p <= ml),
adf_p AS (SELECT series_id, var, arg_min(p, ic) AS best, min(ic) AS icbest FROM adf_i GROUP BY ALL),
adf_t AS MATERIALIZED (SELECT series_id, var, pos, best, icbest, one, xl, y, {final} FROM adf_l JOIN adf_p USING (series_id, var)
          WHERE pos > best),
{last},
adf_r AS (SELECT series_id, var, any_value(best) AS best, any_value(icbest) AS icbest, count(*) AS nobs,
                 sum(xl * y) AS sxy, sum(xl * xl) AS sxx, sum(y * y) AS syy FROM {ends[-1]} GROUP BY ALL),
adf_o AS (SELECT series_id, var, best, icbest, nobs,
                 sxy / sxx / sqrt((syy - sxy * sxy / sxx) / (nobs - {nt + 1} - best) / sxx) AS stat FROM adf_r)"""


def adf_columns(r6, n_vars: int, case: str) -> str:
    crit = (dist.MACKINNON_CRIT_C if case == "c" else dist.MACKINNON_CRIT_N)[n_vars]
    values = ", ".join(f"{r6(poly(crit[k], '(1.0 / nobs)'))} AS crit_{k[:-1]}" for k in ("1%", "5%", "10%"))
    return (f"{r6('stat')} AS statistic, {r6('pv')} AS p_value, CAST(best AS BIGINT) AS used_lag, nobs, "
            f"{r6('icbest')} AS icbest, {values}, pv <= 0.05 AS stationary")


def granger_ctes(src: str, maxlag: int) -> str:
    """CTEs up to ``gr_o``: series_id, lag, f, dfd; ``src``: series_id, var, pos, y, x."""
    out, rows = [], []
    for n in range(1, maxlag + 1):
        ys, xs = [f"y{j}" for j in range(1, n + 1)], [f"x{j}" for j in range(1, n + 1)]
        lagged = ", ".join(f"lag({c[0]}, {c[1:]}) OVER ({PART} ORDER BY pos) AS {c}" for c in (*ys, *xs))
        full = " AND ".join(f"{c} IS NOT NULL" for c in (*ys, *xs, "y"))
        out.append(f"gr_l{n} AS (SELECT series_id, var, pos, 1.0 AS one, y, {lagged} FROM gr_c)")
        out.append(f"gr_s{n} AS MATERIALIZED (SELECT * FROM gr_l{n} WHERE {full})")
        ctes, names = project(f"gr_s{n}", f"gr_q{n}", ["one", *ys, *xs], ["y"])
        out.append(ctes)
        rows.append(f"""SELECT u.series_id, {n} AS lag, u.n - {2 * n + 1} AS dfd, ((r.s - u.s) / {n}) / (u.s / (u.n - {2 * n + 1})) AS f
FROM (SELECT series_id, sum(y * y) AS s FROM {names[n]} GROUP BY ALL) r
JOIN (SELECT series_id, sum(y * y) AS s, count(*) AS n FROM {names[-1]} GROUP BY ALL) u USING (series_id)""")
    centred = f"gr_c AS (SELECT series_id, var, pos, y - avg(y) OVER ({PART}) AS y, x - avg(x) OVER ({PART}) AS x FROM {src})"
    union = "\nUNION ALL ".join(rows)
    return ",\n".join([centred, *out, f"gr_o AS ({union})"])


def jacobi(src: str, k: int, sweeps: int = 9, name: str = "jac") -> tuple[str, str]:
    """CTEs that diagonalise the symmetric k×k matrix in the columns ``a_i_j`` (i <= j) of ``src``
    (series_id, ..) by cyclic Jacobi rotations, and the name of the last: a_i_i are the
    eigenvalues, v_i_j the i-th coordinate of the j-th eigenvector."""
    def a(i, j):
        return f"a_{min(i, j)}_{max(i, j)}"

    unit = ", ".join(f"CAST({int(i == j)} AS DOUBLE) AS v_{i}_{j}" for i in range(k) for j in range(k))
    out = [f"{name}_0 AS MATERIALIZED (SELECT *, {unit} FROM {src})"]
    at = f"{name}_0"
    for step, (p, q) in enumerate([(p, q) for _ in range(sweeps) for p in range(k) for q in range(p + 1, k)], 1):
        app, aqq, apq = a(p, p), a(q, q), a(p, q)
        theta = f"(({aqq} - {app}) / (2 * {apq}))"
        t = (f"CASE WHEN abs({apq}) < 1e-300 THEN 0.0 ELSE (CASE WHEN {theta} >= 0 THEN 1.0 ELSE -1.0 END) / "
             f"(abs({theta}) + sqrt({theta} * {theta} + 1)) END")
        cols = []
        for i in range(k):
            for j in range(i, k):
                c = a(i, j)
                if (i, j) == (p, q):
                    e = "0.0"
                elif (i, j) == (p, p):
                    e = f"{app} - t * {apq}"
                elif (i, j) == (q, q):
                    e = f"{aqq} + t * {apq}"
                elif p in (i, j):
                    o = j if i == p else i
                    e = f"c * {a(o, p)} - s * {a(o, q)}"
                elif q in (i, j):
                    o = j if i == q else i
                    e = f"s * {a(o, p)} + c * {a(o, q)}"
                else:
                    e = c
                cols.append(f"{e} AS {c}")
        for i in range(k):
            for j in range(k):
                e = (f"c * v_{i}_{p} - s * v_{i}_{q}" if j == p else f"s * v_{i}_{p} + c * v_{i}_{q}" if j == q else f"v_{i}_{j}")
                cols.append(f"{e} AS v_{i}_{j}")
        now = f"{name}_{step}"
        out.append(f"{now} AS MATERIALIZED (SELECT series_id, {', '.join(cols)} FROM "
                   f"(SELECT *, 1 / sqrt(t * t + 1) AS c, t / sqrt(t * t + 1) AS s FROM (SELECT *, {t} AS t FROM {at})))")
        at = now
    return ",\n".join(out), at


def pca_ctes(src: str, vars_: list[str]) -> str:
    """CTEs up to ``pc_c`` (series_id, pc, eigenvalue, ratio, cumulative) and ``pc_l``
    (series_id, var, pc, loading) of the standardised variables of ``src`` (long, complete)."""
    k = len(vars_)
    wide = ", ".join(f"max(CASE WHEN var = '{v}' THEN value END) AS x{i}" for i, v in enumerate(vars_))
    full = " AND ".join(f"x{i} IS NOT NULL" for i in range(k))
    corr = ", ".join(f"covar_pop(x{i}, x{j}) / sqrt(var_pop(x{i}) * var_pop(x{j})) AS a_{i}_{j}" for i in range(k) for j in range(i, k))
    ctes, last = jacobi("pc_a", k)
    each = "\nUNION ALL ".join(
        f"SELECT series_id, a_{j}_{j} AS eigenvalue, [{', '.join(f'v_{i}_{j}' for i in range(k))}] AS v FROM {last}" for j in range(k))
    names = "[" + ", ".join(f"'{v}'" for v in vars_) + "]"
    return f"""pc_w AS (SELECT series_id, pos, {wide} FROM {src} GROUP BY series_id, pos),
pc_a AS MATERIALIZED (SELECT series_id, {corr} FROM pc_w WHERE {full} GROUP BY series_id),
{ctes},
pc_e AS ({each}),
pc_s AS (SELECT *, list_max(list_transform(v, lambda x: abs(x))) AS top FROM pc_e),
pc_r AS (SELECT series_id, eigenvalue, row_number() OVER (PARTITION BY series_id ORDER BY eigenvalue DESC) AS pc,
                CASE WHEN list_contains(v, top) THEN v ELSE list_transform(v, lambda x: -x) END AS v FROM pc_s),
pc_c AS (SELECT series_id, pc, eigenvalue, eigenvalue / sum(eigenvalue) OVER (PARTITION BY series_id) AS ratio,
                sum(eigenvalue) OVER (PARTITION BY series_id ORDER BY pc) / sum(eigenvalue) OVER (PARTITION BY series_id) AS cumulative
         FROM pc_r),
pc_l AS (SELECT series_id, pc, unnest({names}) AS var, unnest(v) AS loading FROM pc_r)"""


def pca_score_ctes(src: str, n_components: int) -> str:
    """``pc_t``: series_id, var, ts, pos, value of the scores (after :func:`pca_ctes`)."""
    return f"""pc_z AS (SELECT series_id, var, ts, pos, (value - avg(value) OVER (PARTITION BY series_id, var))
                / stddev_pop(value) OVER (PARTITION BY series_id, var) AS z FROM {src}),
pc_t AS (SELECT z.series_id, 'PC' || l.pc AS var, any_value(z.ts) AS ts, z.pos, sum(z.z * l.loading) AS value
         FROM pc_z z JOIN pc_l l USING (series_id, var) WHERE l.pc <= {n_components} GROUP BY z.series_id, l.pc, z.pos)"""
