"""Distribution functions for p-values (numpy/math only; scipy is not used).

Used inside the small per-series solves (grouped pandas functions), never on
points.
"""

from __future__ import annotations

import math

# MacKinnon (1994/2010) response-surface coefficients for unit-root
# p-values, regression with constant ('c'), N = 1 and N = 2 variables:
# tau_star, tau_min, tau_max, small-p polynomial, large-p polynomial (ascending powers).
MACKINNON_C = {
    1: (-1.61, -18.83, 2.74, (2.1659, 1.4412, 0.038269), (1.7339, 0.93202, -0.12745, -0.010368)),
    2: (-2.62, -18.86, 0.92, (2.92, 1.5012, 0.039796), (2.1945, 0.64695, -0.29198, -0.042377)),
}

# MacKinnon (2010) finite-sample critical values, 'c', as
# b0 + b1/T + b2/T^2 + b3/T^3 for the 1 %, 5 % and 10 % levels.
MACKINNON_CRIT_C = {
    1: {"1%": (-3.43035, -6.5393, -16.786, -79.433), "5%": (-2.86154, -2.8903, -4.234, -40.040),
        "10%": (-2.56677, -1.5384, -2.809, 0.0)},
    2: {"1%": (-3.89644, -10.9519, -33.527, 0.0), "5%": (-3.33613, -6.1101, -6.823, 0.0),
        "10%": (-3.04445, -4.2412, -2.720, 0.0)},
}


# The same without constant ('n'), N = 1.
MACKINNON_N = {1: (-1.04, -19.04, math.inf, (0.6344, 1.2378, 0.032496), (0.4797, 0.93557, -0.06999, 0.033066))}
MACKINNON_CRIT_N = {
    1: {"1%": (-2.56574, -2.2358, -3.627, 0.0), "5%": (-1.94100, -0.2686, -3.365, 31.223),
        "10%": (-1.61682, 0.2656, -2.714, 25.364)},
}


def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def mackinnon_p(stat: float, n_vars: int = 1, case: str = "c") -> float:
    """Asymptotic p-value of a Dickey-Fuller type t statistic (case 'c': constant, 'n': none)."""
    if stat is None or not math.isfinite(stat):
        return float("nan")
    star, lo, hi, small, large = (MACKINNON_C if case == "c" else MACKINNON_N)[n_vars]
    if stat > hi:
        return 1.0
    if stat < lo:
        return 0.0
    coef = small if stat <= star else large
    return norm_cdf(sum(c * stat**i for i, c in enumerate(coef)))


def mackinnon_crit(nobs: int, n_vars: int = 1, case: str = "c") -> dict[str, float]:
    t = float(nobs)
    tables = MACKINNON_CRIT_C if case == "c" else MACKINNON_CRIT_N
    return {k: b[0] + b[1] / t + b[2] / t**2 + b[3] / t**3 for k, b in tables[n_vars].items()}


def _betacf(a: float, b: float, x: float) -> float:
    # continued fraction for the incomplete beta (modified Lentz)
    tiny = 1e-300
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > tiny else tiny)
    h = d
    for m in range(1, 500):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > tiny else tiny)
        c = 1.0 + aa / c
        c = c if abs(c) > tiny else tiny
        de = d * c
        h *= de
        if abs(de - 1.0) < 1e-15:
            break
    return h


def betainc(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0.0:
        return 0.0
    if x >= 1.0:
        return 1.0
    lbt = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, 1.0 - x) / b


def f_sf(f: float, d1: float, d2: float) -> float:
    """Survival function of the F distribution."""
    if f is None or not math.isfinite(f) or d1 <= 0 or d2 <= 0:
        return float("nan")
    if f <= 0:
        return 1.0
    return betainc(d2 / 2.0, d1 / 2.0, d2 / (d2 + d1 * f))
