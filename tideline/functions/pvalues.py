"""Tail probabilities for one-row-per-column test results.

Small scalar helpers: they run on the handful of statistics a test produces,
never on data rows.
"""

from __future__ import annotations

import math

import numpy as np

#: A series that has not settled after so many steps is an error, not a result.
LAST_STEP = 10_000_000
#: Rows of the larger group up to which the two-sample distribution test is exact, as is usual for it.
EXACT_ROWS = 10_000


def upper_gamma(a: float, x: float) -> float:
    """Regularised upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    log_front = -x + a * math.log(x) - math.lgamma(a)
    if x < a + 1:
        term = total = 1.0 / a
        n = a
        while abs(term) > abs(total) * 1e-16:
            n += 1
            term *= x / n
            total += term
        return max(0.0, 1.0 - total * math.exp(log_front))
    # Lentz continued fraction
    tiny = 1e-300
    b = x + 1 - a
    c = 1 / tiny
    d = 1 / b
    h = d
    i = 0
    while True:
        i += 1
        if i > LAST_STEP:
            raise ArithmeticError(f"the series does not settle for a={a}, x={x}")
        an = -i * (i - a)
        b += 2
        d = 1 / ((an * d + b) or tiny)
        c = (b + an / c) or tiny
        step = d * c
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return math.exp(log_front) * h


def _log_gamma_ratio(a: float, b: float) -> float:
    """lgamma(a + b) - lgamma(a); for a large ``a`` from the difference of the Stirling series, where nothing cancels."""
    if a < 1e5:
        return math.lgamma(a + b) - math.lgamma(a)
    tail = lambda z: 1 / (12 * z) - 1 / (360 * z**3)
    return (a - 0.5) * math.log1p(b / a) + b * math.log(a + b) - b + tail(a + b) - tail(a)


def beta_fraction(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta I_x(a, b)."""
    if x <= 0:
        return 0.0
    if x >= 1:
        return 1.0
    if x > (a + 1) / (a + b + 2):
        return 1.0 - beta_fraction(b, a, 1 - x)
    big, small = max(a, b), min(a, b)
    log_front = _log_gamma_ratio(big, small) - math.lgamma(small) + a * math.log(x) + b * math.log1p(-x)
    tiny = 1e-300
    c = 1.0
    d = 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
    h = d
    m = 0
    while True:
        m += 1
        if m > LAST_STEP:
            raise ArithmeticError(f"the series does not settle for a={a}, b={b}, x={x}")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        d = 1 / ((1 + even * d) or tiny)
        c = (1 + even / c) or tiny
        h *= d * c
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / ((1 + odd * d) or tiny)
        c = (1 + odd / c) or tiny
        step = d * c
        h *= step
        if abs(step - 1) < 1e-15:
            break
    return math.exp(log_front) * h / a


def chi_square_p(statistic: float | None, dof: int | None) -> float | None:
    if statistic is None or not dof:
        return None
    return upper_gamma(dof / 2, statistic / 2)


def student_t_p(t: float | None, dof: float | None) -> float | None:
    """Two-sided."""
    if t is None or dof is None or dof <= 0:
        return None
    if dof > 1e6:
        # The normal tail, corrected for the degrees of freedom to the square of their inverse.
        z = abs(t) * (1 - 1 / (4 * dof)) / math.sqrt(1 + t * t / (2 * dof))
        return math.erfc(z / math.sqrt(2))
    return beta_fraction(dof / 2, 0.5, dof / (dof + t * t))


def f_p(f: float | None, d1: float | None, d2: float | None) -> float | None:
    if f is None or not d1 or not d2 or d2 <= 0:
        return None
    if d1 == 1:
        return student_t_p(math.sqrt(max(0.0, f)), d2)
    return beta_fraction(d2 / 2, d1 / 2, d2 / (d2 + d1 * f)) if f > 0 else 1.0


def kolmogorov_p(d: float | None, n0: int | None, n1: int | None) -> float | None:
    """Two-sided two-sample p-value: exact while both groups have at most ``EXACT_ROWS`` rows, else asymptotic."""
    if d is None or not n0 or not n1:
        return None
    if max(n0, n1) <= EXACT_ROWS:
        return exact_kolmogorov_p(d, n0, n1)
    x = d * math.sqrt(n0 * n1 / (n0 + n1))
    if x < 0.2:
        return 1.0
    total, j, term = 0.0, 1, 1.0
    while term > 1e-18:
        term = math.exp(-2 * j * j * x * x)
        total += term if j % 2 else -term
        j += 1
    return min(1.0, max(0.0, 2 * total))


def exact_kolmogorov_p(d: float, n0: int, n1: int) -> float:
    """Share of the orders of the pooled rows whose largest gap is at least ``d``.

    An order is a path on a grid of n0 by n1 steps; the paths that stay inside
    the gap are counted diagonal by diagonal.
    """
    gap = round(d * n0 * n1)
    if gap <= 0:
        return 1.0
    inside, logs = np.zeros(n0 + 1), 0.0
    inside[0] = 1.0
    i = np.arange(n0 + 1)
    for k in range(1, n0 + n1 + 1):
        inside[1:] += inside[:-1].copy()
        j = k - i
        inside[(j < 0) | (j > n1) | (np.abs(i * n1 - j * n0) >= gap)] = 0.0
        largest = inside.max()
        if largest == 0.0:
            return 1.0
        if largest > 1e200:
            inside /= largest
            logs += math.log(largest)
    all_paths = math.lgamma(n0 + n1 + 1) - math.lgamma(n0 + 1) - math.lgamma(n1 + 1)
    return min(1.0, max(0.0, -math.expm1(math.log(inside[n0]) + logs - all_paths)))
