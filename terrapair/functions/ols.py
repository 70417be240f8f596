"""Least squares: per row over yearly columns (no shuffle), and from grouped sums."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from terrapair.functions.columns import finite, t_two_sided

SXX_FLOOR = 1e-12
SE_FLOOR = 1e-15


def min_valid(n_years: int, share: float = 0.60) -> int:
    return max(3, math.ceil(share * n_years))


def row_ols(columns: Sequence[str], years: Sequence[float], least: int) -> Column:
    """struct(slope, pvalue, n) of one row's series, nulls left out.

    Residuals are summed themselves, so that an exact line has a standard error of 0 and
    p = 1. slope and pvalue are null with fewer than `least` values.
    """
    points = F.array(*[F.struct(F.lit(float(x)).alias("x"), finite(F.col(f"`{c}`").cast("double")).alias("y")) for c, x in zip(columns, years)])
    points = F.filter(points, lambda p: p["y"].isNotNull())

    def total(of: Callable[[Column], Column]) -> Callable[[Column], Column]:
        return lambda v: F.aggregate(v, F.lit(0.0), lambda s, p: s + of(p))

    def fit(v: Column) -> Column:
        n = F.size(v)
        means = F.struct(n.alias("n"), (total(lambda p: p["x"])(v) / n).alias("x"), (total(lambda p: p["y"])(v) / n).alias("y"))
        return _let(means, lambda m: sums(v, m))

    def sums(v: Column, m: Column) -> Column:
        sxx = total(lambda p: (p["x"] - m["x"]) * (p["x"] - m["x"]))(v)
        sxy = total(lambda p: (p["x"] - m["x"]) * (p["y"] - m["y"]))(v)
        return _let(F.struct(sxx.alias("sxx"), sxy.alias("sxy")), lambda s: line(v, m, s))

    def line(v: Column, m: Column, s: Column) -> Column:
        slope = F.when((m["n"] >= least) & (s["sxx"] > SXX_FLOOR), s["sxy"] / s["sxx"])
        return _let(slope, lambda b: test(v, m, s, b))

    def test(v: Column, m: Column, s: Column, slope: Column) -> Column:
        sse = total(lambda p: F.pow(p["y"] - m["y"] - slope * (p["x"] - m["x"]), F.lit(2)))(v)
        dof = F.greatest(m["n"] - 2, F.lit(1))
        se = F.sqrt(sse / dof / s["sxx"])
        t = _let(se, lambda e: F.when(e > SE_FLOOR, slope / e).otherwise(F.lit(0.0)))
        p = _let(t, lambda t: F.when(slope.isNotNull(), t_two_sided(t, dof)))
        return F.struct(slope.alias("slope"), p.alias("pvalue"), m["n"].alias("n"))

    return F.when(F.size(points) > 0, _let(points, fit)).otherwise(F.struct(F.lit(None).cast("double").alias("slope"), F.lit(None).cast("double").alias("pvalue"), F.lit(0).alias("n")))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: a one-element transform binds it to a variable."""
    return F.transform(F.array(value), body)[0]


def grouped_ols(x: str, y: str) -> list[Column]:
    """Aggregates slope, sxx, sxy, syy and n of a group; pairs with a null are left out."""
    pair = f"{y}, {x}"
    return [
        F.expr(f"regr_slope({pair})").alias("slope"),
        F.expr(f"regr_sxx({pair})").alias("sxx"),
        F.expr(f"regr_sxy({pair})").alias("sxy"),
        F.expr(f"regr_syy({pair})").alias("syy"),
        F.expr(f"regr_count({pair})").alias("n"),
    ]


def slope_t(slope: Column, sxx: Column, sxy: Column, syy: Column, n: Column) -> Column:
    """t statistic of a slope from sums, 0 for an exact line."""
    sse = F.greatest(syy - sxy * sxy / sxx, F.lit(0.0))
    se = F.sqrt(sse / F.greatest(n - 2, F.lit(1)) / sxx)
    return F.when(se > SE_FLOOR, slope / se).otherwise(F.lit(0.0))
