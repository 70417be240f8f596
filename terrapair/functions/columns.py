"""Scalar helpers as Column expressions, all inside whole-stage code generation."""

from __future__ import annotations

import math
from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_INF = float("inf")


def is_finite(c: Column | str) -> Column:
    """Neither null, NaN nor infinite."""
    c = F.col(c) if isinstance(c, str) else c
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _INF)


def finite(c: Column | str) -> Column:
    """The value, null where it isn't finite."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(is_finite(c), c)


def all_finite(cols: Iterable[str]) -> Column:
    return reduce(and_, (is_finite(F.col(c).cast("double")) for c in cols))


def clean(df: DataFrame) -> DataFrame:
    """NaN and infinities of every floating column become null: missing has one form."""
    return df.withColumns({f.name: finite(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() in ("double", "float")})


def number(c: str) -> Column:
    """A column as a finite double; what doesn't parse is null."""
    return finite(F.col(c).try_cast("double"))


def expect_columns(df: DataFrame, names: Iterable[str], where: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"{where}: missing columns {missing}")


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or null."""
    return F.when(b != 0, a / b)


def t_two_sided(t: Column, dof: Column) -> Column:
    """Two-sided p-value of Student's t for whole degrees of freedom.

    Abramowitz & Stegun 26.7.3 and 26.7.4: a finite series of cosines, summed with a fold over
    a sequence of dof / 2 steps; for the small dof of yearly series.
    """
    steps = F.greatest(F.floor((dof - 2) / 2), F.lit(0)).cast("int")
    odd = dof % 2 == 1

    def series(theta: Column) -> Column:
        # term j of either series comes from term j - 1 by one factor
        def add(s: Column, j: Column) -> Column:
            factor = F.when(odd, F.lit(2) * j / (F.lit(2) * j + 1)).otherwise((F.lit(2) * j - 1) / (F.lit(2) * j))
            term = s["term"] * factor * F.pow(F.cos(theta), F.lit(2))
            return F.struct(term.alias("term"), (s["total"] + term).alias("total"))

        start = F.struct(F.lit(1.0).alias("term"), F.lit(1.0).alias("total"))
        steps_ = F.when(steps > 0, F.sequence(F.lit(1), steps)).otherwise(F.array().cast("array<int>"))
        total = F.aggregate(steps_, start, add)["total"]
        return F.when(dof == 1, theta * (2 / math.pi)).when(odd, (theta + F.sin(theta) * F.cos(theta) * total) * (2 / math.pi)).otherwise(F.sin(theta) * total)

    inside = F.transform(F.array(F.atan(F.abs(t) / F.sqrt(dof))), series)[0]
    return F.greatest(F.lit(0.0), F.lit(1.0) - inside)


def t_sf2(t: float, dof: float) -> float:
    """Two-sided p-value on the driver for any dof: the regularised incomplete beta function by
    its continued fraction (modified Lentz)."""
    if math.isnan(t):
        return math.nan
    x = dof / (dof + t * t)
    a, b = dof / 2, 0.5
    if x in (0.0, 1.0):
        return x
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x > (a + 1) / (a + b + 2):
        return 1 - front * _fraction(1 - x, b, a) / b
    return front * _fraction(x, a, b) / a


def _fraction(x: float, a: float, b: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1 / (1 - (a + b) * x / (a + 1) or tiny)
    h = d
    for m in range(1, 500):
        for num in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / (1 + num * d or tiny)
            c = 1 + num / c or tiny
            h *= c * d
        if abs(c * d - 1) < 1e-15:
            break
    return h
