"""Two-sided tail probabilities of the normal and Student t distributions as column expressions.

The tail is the integral of the density from |t| to infinity.  With
s = |t| + exp(pi/2 sinh u) it becomes a rapidly converging sum over equally
spaced u (exp-sinh quadrature); the sum runs over a fixed sequence inside the
plan, so nothing leaves the JVM.  The t density is

    exp(-(v + 1) / 2 * log1p(s^2 / v)) * G(v / 2) / sqrt(v * pi),  G(x) = gamma(x + 1/2) / gamma(x)

with G from its asymptotic series at x + SHIFT, SHIFT factors divided out;
for v without bound it turns into the normal density by itself.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

STEPS_TO_ONE = 16  # quadrature points per unit of u
REACH = 5  # u runs from -REACH to REACH
SHIFT = 12
SMALL = 1e-3  # below this, log1p by its series: the same steps work in any SQL engine


def _log1p(z: Column) -> Column:
    series = z * (1 - z * (F.lit(1 / 2) - z * (F.lit(1 / 3) - z * (F.lit(1 / 4) - z * (F.lit(1 / 5) - z / 6)))))
    return F.when(z < SMALL, series).otherwise(F.ln(z + 1))


def _integral(log_density) -> Column:
    """Integral over y from 0 to infinity of exp(log_density(y))."""
    def term(k: Column) -> Column:
        u = k / F.lit(float(STEPS_TO_ONE))
        y = F.exp(F.lit(math.pi / 4) * (F.exp(u) - F.exp(-u)))
        weight = y * F.lit(math.pi / 4 / STEPS_TO_ONE) * (F.exp(u) + F.exp(-u))
        return weight * F.exp(log_density(y))

    points = F.sequence(F.lit(-REACH * STEPS_TO_ONE), F.lit(REACH * STEPS_TO_ONE))
    return F.aggregate(F.transform(points, term), F.lit(0.0), lambda a, x: a + x)


def gamma_ratio(x: Column) -> Column:
    """gamma(x + 1/2) / gamma(x) for x > 0."""
    y = x + SHIFT
    i = 1 / (y * y)
    out = F.sqrt(y) * F.exp((F.lit(-1 / 8) + i * (F.lit(1 / 192) - i * (F.lit(1 / 640) - i * F.lit(17 / 14336)))) / y)
    for k in range(SHIFT):
        out = out * (x + k) / (x + (k + 0.5))
    return out


def two_sided_norm(z: Column) -> Column:
    """P(|Z| > |z|) for a standard normal Z; NULL for a NULL z."""
    a = F.abs(z.cast("double"))
    tail = F.lit(2 / math.sqrt(2 * math.pi)) * _integral(lambda y: -(a + y) * (a + y) / 2)
    return F.when(a.isNotNull(), F.least(F.lit(1.0), tail))


def two_sided_t(t: Column, df: Column) -> Column:
    """P(|T| > |t|) for Student's t with df > 0 degrees of freedom, else NULL."""
    a = F.abs(t.cast("double"))
    v = F.when(df > 0, df.cast("double"))
    front = 2 * gamma_ratio(v / 2) / F.sqrt(v * F.lit(math.pi))
    tail = front * _integral(lambda y: -(v + 1) / 2 * _log1p((a + y) * (a + y) / v))
    return F.when(a.isNotNull() & v.isNotNull(), F.least(F.lit(1.0), tail))


#: The U distribution is counted if one sample has at most EXACT_SIZE values and there are at most EXACT_CELLS pairs.
EXACT_SIZE = 8
EXACT_CELLS = 4000


def two_sided_u(n1: Column, n2: Column, u: Column) -> Column:
    """Two-sided p of a Mann-Whitney U (of either sample) without ties, from the counts of all arrangements.

    The arrangements with U = t are the coefficients of the product over i = 1..m of (1 - x^(n + i)) / (1 - x^i), m and n
    the smaller and the larger sample.  Each factor is one step over the array of the coefficients up to the observed U:
    the division adds every i-th coefficient below, the product takes off the one n + i below.
    """
    m, n = F.least(n1, n2).cast("int"), F.greatest(n1, n2).cast("int")
    top = F.floor(F.least(u, n1 * n2 - u)).cast("int")
    upto = F.sequence(F.lit(0), top)

    def divided(a: Column, t: Column, i: Column) -> Column:
        return F.aggregate(F.sequence(t % i, t, i), F.lit(0.0), lambda s, j: s + F.get(a, j))

    def step(a: Column, i: Column) -> Column:
        return F.transform(upto, lambda t: divided(a, t, i) - F.when(t >= n + i, divided(a, t - n - i, i)).otherwise(0.0))

    one = F.transform(upto, lambda t: F.when(t == 0, 1.0).otherwise(0.0))
    below = F.aggregate(F.aggregate(F.sequence(F.lit(1), m), one, step), F.lit(0.0), lambda s, c: s + c)
    all_ = F.aggregate(F.sequence(F.lit(1), m), F.lit(1.0), lambda c, i: c * (n + i) / i)
    return F.when(m >= 1, F.least(F.lit(1.0), 2 * below / all_))
