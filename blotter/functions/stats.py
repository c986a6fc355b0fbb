"""Least-squares statistics from mergeable sums, as column expressions.

``moments`` are plain sums of whole numbers (decimals, so they are exact and
combine in any order); everything else follows from one row of them. Student's
t tail comes from the incomplete beta function: a continued fraction of about the square
root of the degrees of freedom in steps, run by ``aggregate`` over a sequence.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SHIFT = 12  # Stirling's series is used from here on
_TINY = 1e-300


def moments(x: Column, y: Column) -> list[Column]:
    """n, sx, sy, sxx, sxy, syy of two whole-number columns; rows with a NULL in either are left out."""
    both = x.isNotNull() & y.isNotNull()

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(both, value.cast("decimal(28,0)"))), F.lit(0)).cast("decimal(38,0)").alias(name)

    x, y = x.cast("bigint"), y.cast("bigint")
    return [F.count(F.when(both, F.lit(1))).alias("n"), total(x, "sx"), total(y, "sy"),
            total(x * x, "sxx"), total(x * y, "sxy"), total(y * y, "syy")]


def regression(sums: DataFrame) -> DataFrame:
    """Adds corr, slope, intercept, slope_se, t_stat, deg_freedom and p_value (two-sided) of y on x to rows of moments.

    NULL where they are not defined: no spread in x (or y, for corr), or under three
    rows for the error. A perfect fit has no error, so no t_stat, and p_value 0.
    Each step is a projection of its own, so that no expression is written out in another many times.
    """
    def centred(a: str, b: str, ab: str) -> Column:  # whole numbers up to the division
        return (F.col("n").cast("decimal(19,0)") * F.col(ab) - F.col(a) * F.col(b)).cast("double") / F.nullif(F.col("n"), F.lit(0))

    steps = [
        {"__xx": centred("sx", "sx", "sxx"), "__xy": centred("sx", "sy", "sxy"), "__yy": centred("sy", "sy", "syy")},
        {"__xx": F.nullif("__xx", F.lit(0.0)), "__df": F.when(F.col("n") > 2, F.col("n") - 2)},
        {"corr": F.col("__xy") / F.sqrt(F.col("__xx") * F.nullif("__yy", F.lit(0.0))), "slope": F.col("__xy") / F.col("__xx")},
        {"intercept": (F.col("sy").cast("double") - F.col("slope") * F.col("sx").cast("double")) / F.col("n"),
         "slope_se": F.sqrt(F.greatest(F.col("__yy") - F.col("slope") * F.col("__xy"), F.lit(0.0)) / F.col("__df") / F.col("__xx"))},
        {"t_stat": F.col("slope") / F.nullif("slope_se", F.lit(0.0)), "deg_freedom": F.col("__df").cast("bigint")},
    ]
    for step in steps:
        sums = sums.withColumns(step)
    tested = t_test(sums, "t_stat", "deg_freedom", "p_value")
    exact = F.when(F.col("slope") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return (tested.withColumn("p_value", F.when(F.col("slope_se") == 0, exact).otherwise(F.col("p_value")))
            .drop("__xx", "__xy", "__yy", "__df"))


def log_gamma(z: Column) -> Column:
    """Logarithm of the gamma function of a positive column."""
    shift = z
    for k in range(1, _SHIFT):
        shift = shift * (z + k)
    w = z + _SHIFT
    series = 1 / (12 * w) - 1 / (360 * w ** 3) + 1 / (1260 * w ** 5) - 1 / (1680 * w ** 7)
    return (w - 0.5) * F.log(w) - w + 0.5 * math.log(2 * math.pi) + series - F.log(shift)


def _fraction(a: Column, b: Column, x: Column) -> Column:
    """Continued fraction of the incomplete beta function (Lentz's method)."""
    def nonzero(v: Column) -> Column:
        return F.when(F.abs(v) < _TINY, F.lit(_TINY)).otherwise(v)

    def state(c: Column, d: Column, h: Column) -> Column:
        return F.struct(c.cast("double").alias("c"), d.cast("double").alias("d"), h.cast("double").alias("h"))

    first = 1 / nonzero(1 - (a + b) * x / (a + 1))

    def half(s: Column, step: Column) -> Column:
        d, c = 1 / nonzero(1 + step * s["d"]), nonzero(1 + step / s["c"])
        return state(c, d, s["h"] * d * c)

    def advance(s: Column, m: Column) -> Column:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        # each half is bound to a name, so that it is computed once
        return F.element_at(F.transform(F.array(half(s, even)), lambda e: half(e, odd)), 1)

    rounds = F.ceil(20 + 6 * F.sqrt(F.greatest(a, b))).cast("int")
    steps = F.transform(F.sequence(F.lit(1), rounds), lambda m: m.cast("double"))
    return F.aggregate(steps, state(F.lit(1.0), first, first), advance, lambda s: s["h"])


def incomplete_beta(df: DataFrame, a: Column, b: Column, x: Column, name: str) -> DataFrame:
    """Adds the regularised incomplete beta function I_x(a, b), for positive a, b and 0 <= x <= 1."""
    # the fraction converges for small x; I_x(a, b) = 1 - I_1-x(b, a)
    for step in ({"__a": a, "__b": b, "__x": x},
                 {"__far": F.col("__x") >= (F.col("__a") + 1) / (F.col("__a") + F.col("__b") + 2)},
                 {"__p": F.when(F.col("__far"), F.col("__b")).otherwise(F.col("__a")),
                  "__q": F.when(F.col("__far"), F.col("__a")).otherwise(F.col("__b")),
                  "__y": F.when(F.col("__far"), 1 - F.col("__x")).otherwise(F.col("__x"))},
                 {"__tail": _tail(F.col("__p"), F.col("__q"), F.col("__y"))},
                 {name: F.when(F.col("__far"), 1 - F.col("__tail")).otherwise(F.col("__tail"))}):
        df = df.withColumns(step)
    return df.drop("__a", "__b", "__x", "__far", "__p", "__q", "__y", "__tail")


def _tail(a: Column, b: Column, x: Column) -> Column:
    scale = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(1 - x))
    return F.when(x <= 0, F.lit(0.0)).otherwise(scale * _fraction(a, b, x) / a)


def t_test(df: DataFrame, t: str, deg_freedom: str, name: str) -> DataFrame:
    """Adds the chance that Student's t is as far from 0 as column ``t``."""
    n = F.col(deg_freedom).cast("double")
    return incomplete_beta(df, n / 2, F.lit(0.5), n / (n + F.col(t) * F.col(t)), name)
