"""Special functions as column expressions."""

from __future__ import annotations

from math import log, pi

from pyspark.sql import Column
from pyspark.sql import functions as F

_TINY = 1e-300


def log_beta_half(a: Column) -> Column:
    """log B(a, 1/2), from the asymptotic series of the ratio of gamma functions, sixteen steps up where it is exact to a double."""
    z = a + 16
    series = F.log(z) / 2 - 1 / (8 * z) + 1 / (192 * z**3) - 1 / (640 * z**5) + 17 / (14336 * z**7)
    down = F.aggregate(F.sequence(F.lit(0), F.lit(15)), F.lit(0.0), lambda s, k: s + F.log((a + k) / (a + k + 0.5)))
    return log(pi) / 2 - series - down


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, front to back; it converges fast for x below (a + 1) / (a + b + 2)."""
    def away(v: Column) -> Column:
        return F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)

    def advanced(s: Column, numerator: Column) -> Column:
        d, c = 1 / away(1 + numerator * s["d"]), away(1 + numerator / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * c * d).alias("h"))

    def step(s: Column, m: Column) -> Column:
        even = advanced(s, m * (b - m) * x / ((a - 1 + 2 * m) * (a + 2 * m)))
        odd = F.transform(F.array(even), lambda e: advanced(e, -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 1 + 2 * m))))
        return F.element_at(odd, 1)

    first = 1 / away(1 - (a + b) * x / (a + 1))
    steps = F.sequence(F.lit(1), F.greatest(F.lit(60), F.ceil(4 * F.sqrt(F.greatest(a, b)))).cast("int"))
    return F.aggregate(steps, F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h")), step, lambda s: s["h"])


def incomplete_beta_half(a: Column, x: Column) -> Column:
    """The regularised incomplete beta function I_x(a, 1/2); 0 at 0 and below, 1 at 1 and above."""
    b = F.lit(0.5)
    front = F.exp(a * F.log(x) + b * F.log(1 - x) - log_beta_half(a))
    inner = F.when(x < (a + 1) / (a + 2.5), front * _fraction(a, b, x) / a).otherwise(1 - front * _fraction(b, a, 1 - x) / b)
    return F.when(x <= 0, 0.0).when(x >= 1, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), inner)))


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation over n pairs (Student's t with n - 2 degrees of freedom); NULL below three pairs."""
    return F.when(n > 2, incomplete_beta_half((n - 2) / 2, 1 - r * r))
