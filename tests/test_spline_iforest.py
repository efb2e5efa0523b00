import numpy as np
import pytest

from tsforge.operators import fill, iforest
from tsforge.operators.spline import cubic_second_derivatives, solve_tridiagonal


def notaknot_dense(x, y, xq):
    """Brute force: solve the full not-a-knot system densely, evaluate at xq."""
    n = len(x)
    h = np.diff(x)
    A = np.zeros((n, n))
    b = np.zeros(n)
    A[0, 0], A[0, 1], A[0, 2] = -1 / h[0], 1 / h[0] + 1 / h[1], -1 / h[1]
    A[-1, -3], A[-1, -2], A[-1, -1] = -1 / h[-2], 1 / h[-2] + 1 / h[-1], -1 / h[-1]
    for i in range(1, n - 1):
        A[i, i - 1], A[i, i], A[i, i + 1] = h[i - 1], 2 * (h[i - 1] + h[i]), h[i]
        b[i] = 6 * ((y[i + 1] - y[i]) / h[i] - (y[i] - y[i - 1]) / h[i - 1])
    M = np.linalg.solve(A, b)
    out = []
    for q in xq:
        i = min(max(np.searchsorted(x, q, side="right") - 1, 0), n - 2)
        hh = h[i]
        out.append(M[i] * (x[i + 1] - q) ** 3 / (6 * hh) + M[i + 1] * (q - x[i]) ** 3 / (6 * hh)
                   + (y[i] / hh - M[i] * hh / 6) * (x[i + 1] - q) + (y[i + 1] / hh - M[i + 1] * hh / 6) * (q - x[i]))
    return np.array(out)


@pytest.mark.parametrize("n", [1, 2, 3, 17, 300])
def test_tridiagonal_matches_dense(n):
    rng = np.random.default_rng(n)
    sub, sup = rng.normal(size=n), rng.normal(size=n)
    diag = 1.0 + np.abs(sub) + np.abs(sup)
    rhs = rng.normal(size=n)
    dense = np.diag(diag) + np.diag(sub[1:], -1) + np.diag(sup[:-1], 1)
    assert np.max(np.abs(solve_tridiagonal(sub, diag, sup, rhs) - np.linalg.solve(dense, rhs))) < 1e-12


def test_second_derivatives_match_dense():
    rng = np.random.default_rng(3)
    x = np.cumsum(rng.uniform(0.5, 2, 12))
    y = rng.normal(size=12)
    M = cubic_second_derivatives(x, y)
    # not-a-knot: third derivative continuous at x1 and x[-2]
    h = np.diff(x)
    assert abs((M[1] - M[0]) / h[0] - (M[2] - M[1]) / h[1]) < 1e-9
    assert abs((M[-1] - M[-2]) / h[-1] - (M[-2] - M[-3]) / h[-2]) < 1e-9


@pytest.mark.parametrize("chunk", [128, 100000])
def test_spline_fill_matches_brute_force(spark, chunk):
    rng = np.random.default_rng(7)
    n = 400
    vals = np.sin(np.arange(n) / 9.0) + 0.1 * rng.normal(size=n)
    mask = rng.random(n) < 0.25
    mask[:3] = True  # leading gap (extrapolated)
    mask[-2:] = True  # trailing gap
    data = [("s", "v", None, i, None if m else float(v)) for i, (v, m) in enumerate(zip(vals, mask))]
    df = spark.createDataFrame(data, "series_id string, var string, ts timestamp_ntz, pos long, value double")
    got = np.array([r["value"] for r in fill.spline(df, 3, chunk_rows=chunk).orderBy("pos").collect()])
    x = np.arange(n)[~mask].astype(float)
    exp = notaknot_dense(x, vals[~mask], np.arange(n).astype(float))
    assert np.all(got[~mask] == vals[~mask])
    assert np.max(np.abs(got - exp)) < 1e-8


@pytest.mark.parametrize("degree", [2, 3])
def test_spline_of_few_knots(spark, degree):
    """No knot stays NULL, one is a constant, two a line; three are a parabola (degree 2) or lines (degree 3)."""
    data = []
    for m, at in enumerate([[], [2], [1, 4], [1, 2, 4]]):
        data += [(f"s{m}", "v", None, i, float(i * i) if i in at else None) for i in range(6)]
    df = spark.createDataFrame(data, "series_id string, var string, ts timestamp_ntz, pos long, value double")
    got = {}
    for r in fill.spline(df, degree, chunk_rows=2).orderBy("pos").collect():
        got.setdefault(r["series_id"], []).append(r["value"])
    assert got["s0"] == [None] * 6 and got["s1"] == [4.0] * 6
    assert np.allclose(got["s2"], [1 + 5 * (i - 1) for i in range(6)])
    assert np.allclose(got["s3"], [i * i for i in range(6)] if degree == 2 else [-2, 1, 4, 10, 16, 22])


def walk(values, path_of, x):
    """Score of x by following it through every tree, interval by interval."""
    total = 0.0
    for cuts, paths in values:
        i = 0
        while i < len(cuts) and x >= cuts[i]:
            i += 1
        total += paths[i]
    return 2.0 ** (-(total / len(values)) / path_of)


def test_forest_steps_match_trees():
    rng = np.random.default_rng(4)
    pool = np.round(rng.normal(size=500), 2)
    trees, psi = iforest.grow_forest(pool, 12, 64, rng)
    cuts, scores = iforest.forest_steps(trees, psi)
    for x in [*pool, -1e300, 1e300, *cuts]:
        assert abs(scores[np.searchsorted(cuts, x, side="right")] - walk(trees, iforest.c_factor(psi), x)) < 1e-12


def test_tree_paths_are_those_of_its_points():
    """Every point of a tree's sample lies in one interval, whose path is its depth plus c(points in it)."""
    values = np.array([0.0, 0.0, 1.0, 5.0, 5.0, 5.0, 9.0, 100.0])
    for seed in range(50):
        cuts, paths = iforest.grow_tree(values, np.random.default_rng(seed))
        assert list(cuts) == sorted(cuts) and len(paths) == len(cuts) + 1
        inside = np.bincount(np.searchsorted(cuts, values, side="right"), minlength=len(paths))
        assert inside.sum() == len(values) and (inside > 0).all()
        depth = paths - [iforest.c_factor(n) for n in inside]
        assert np.allclose(depth, np.round(depth)) and depth.max() <= 3
        # leaves of a binary tree
        assert abs(sum(0.5 ** d for d in depth) - 1.0) < 1e-12


def test_iforest_odd_series(spark):
    """Nulls, infinities, one point, constant and empty series; columns of the caller stay as they are."""
    rows = [("null", "v", None, i, None, i) for i in range(3)] + [("one", "v", None, 0, 7.0, None)]
    rows += [("const", "v", None, i, 5.0, 2**53 + 1) for i in range(50)]
    rows += [("inf", "v", None, i, float("inf") if i == 9 else float(i % 4), i) for i in range(40)]
    schema = "series_id string, var string, ts timestamp_ntz, pos long, value double, tag long"
    df = spark.createDataFrame(rows, schema)
    out = iforest.isolation_forest(df, chunk_rows=16, keep_score=True)
    assert out.columns == [*df.columns, "is_outlier", "score"]
    got = {(r["series_id"], r["pos"]): r for r in out.collect()}
    assert len(got) == len(rows)
    assert {tuple(r[c] for c in df.columns) for r in got.values()} == set(rows)
    assert all(got["null", i]["score"] is None and not got["null", i]["is_outlier"] for i in range(3))
    assert not got["one", 0]["is_outlier"] and not any(got["const", i]["is_outlier"] for i in range(50))
    assert got["inf", 9]["score"] == got["inf", 3]["score"]  # beyond the largest value that trees saw
    empty = iforest.isolation_forest(spark.createDataFrame([], schema))
    assert empty.count() == 0


def test_iforest_flags_extremes(spark):
    rng = np.random.default_rng(0)
    vals = rng.normal(size=1000)
    vals[[10, 500, 900]] = [12.0, -15.0, 20.0]
    df = spark.createDataFrame([("s", "v", None, i, float(v)) for i, v in enumerate(vals)],
                               "series_id string, var string, ts timestamp_ntz, pos long, value double")
    out = iforest.isolation_forest(df, contamination=0.05, chunk_rows=300, keep_score=True).collect()
    flagged = {r["pos"] for r in out if r["is_outlier"]}
    assert {10, 500, 900} <= flagged
    assert 30 <= len(flagged) <= 70


def kendall_brute(x, y):
    n = len(x)
    s = 0
    for i in range(n):
        for j in range(i + 1, n):
            s += np.sign(x[i] - x[j]) * np.sign(y[i] - y[j])
    n0 = n * (n - 1) / 2
    _, cx = np.unique(x, return_counts=True)
    _, cy = np.unique(y, return_counts=True)
    n1 = (cx * (cx - 1) / 2).sum()
    n2 = (cy * (cy - 1) / 2).sum()
    return s / np.sqrt((n0 - n1) * (n0 - n2))


def test_pair_sign_sum():
    from tsforge.operators.kendall import cell_sign_sum, pair_sign_sum

    rng = np.random.default_rng(12)
    for n in (0, 1, 2, 5, 40):
        for top in (2, 5, 100):
            x, y, c = rng.integers(0, top, n), rng.integers(0, top, n), rng.integers(1, 4, n)
            want = sum(int(c[i] * c[j] * np.sign(x[i] - x[j]) * np.sign(y[i] - y[j])) for i in range(n) for j in range(i))
            assert pair_sign_sum(x, y, c) == want
            if top <= 8:
                assert cell_sign_sum(x, y, c, 8) == want


# chunks of one row up to one chunk; one bit a digit: many levels of cells
@pytest.mark.parametrize("chunk,bits", [(1, 1), (7, 6), (65536, 6)])
def test_kendall_matches_brute_force(spark, chunk, bits):
    from tsforge.operators.kendall import kendall

    rng = np.random.default_rng(11)
    n = 120
    a = np.round(rng.normal(size=n), 1)  # many ties
    b = np.where(rng.random(n) < 0.9, 3.0, np.round(a * 0.5 + rng.normal(size=n), 2))  # 90 % share one value
    c = rng.integers(0, 5, size=n).astype(float)
    rows = [("s", v, None, i, float(arr[i])) for i in range(n) for v, arr in (("a", a), ("b", b), ("c", c))]
    rows[5 * 3] = ("s", "a", None, 5, None)
    df = spark.createDataFrame(rows, "series_id string, var string, ts timestamp_ntz, pos long, value double")
    got = {(r["var1"], r["var2"]): (r["n"], r["tau"]) for r in kendall(df, chunk_rows=chunk, fan_bits=bits).collect()}
    keep = np.arange(n) != 5
    for (u, v), (x, y) in {("a", "b"): (a[keep], b[keep]), ("a", "c"): (a[keep], c[keep]), ("b", "c"): (b, c)}.items():
        assert got[u, v][0] == len(x) and abs(got[u, v][1] - kendall_brute(x, y)) < 1e-12


@pytest.mark.parametrize("chunk", [1, 7, 100000])
def test_quadratic_chunk_invariance(spark, chunk):
    rng = np.random.default_rng(5)
    n = 300
    vals = np.cos(np.arange(n) / 11.0) + 0.05 * rng.normal(size=n)
    mask = rng.random(n) < 0.3
    mask[[0, 1, 2, n - 1]] = False
    data = [("s", "v", None, i, None if m else float(v)) for i, (v, m) in enumerate(zip(vals, mask))]
    df = spark.createDataFrame(data, "series_id string, var string, ts timestamp_ntz, pos long, value double")
    got = np.array([r["value"] for r in fill.spline(df, 2, chunk_rows=chunk, extrapolate=False).orderBy("pos").collect()])
    x = np.arange(n)[~mask].astype(float)
    y = vals[~mask]
    h, d = np.diff(x), np.diff(y) / np.diff(x)
    s = [d[0] - h[0] * (d[1] - d[0]) / (h[0] + h[1])]  # parabola through the first three knots
    for secant in d:
        s.append(2 * secant - s[-1])
    exp = np.empty(n)
    for q in range(n):
        i = min(max(np.searchsorted(x, q, side="right") - 1, 0), len(x) - 2)
        t = q - x[i]
        h = x[i + 1] - x[i]
        exp[q] = y[i] + s[i] * t + (s[i + 1] - s[i]) / (2 * h) * t * t
    assert np.max(np.abs(got - exp)) < 1e-8
