"""Exact quantiles of any number of rows, without gathering a column's values anywhere.

An approximate quantile with a bounded sketch brackets each wanted value between two others; the next scan
counts what lies below and between, and looks between them again. A bracket shrinks by
some hundred times a scan, so four scans do for 10**12 rows; at most KEEP values are gathered.

With groups, every group's brackets are rows of a table and shrink at the same time (`grouped_quantiles`).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from terrapair.functions.columns import finite

#: Values of a bracket that are gathered and sorted at last.
KEEP = 100_000
#: A sketch's ranks are off by one in ACCURACY at most; the margin that is taken is wider.
ACCURACY, MARGIN = 2000, 1 / 500
MAX_SCANS = 60
#: Marks that cut a group's bracket in all rounds but the first.
MARKS = 64


@dataclass
class _Bracket:
    """Open interval of values that holds the order statistics first to last; `below` lie at or under lo."""

    column: str
    first: int
    last: int
    size: int
    lo: float | None = None
    hi: float | None = None
    below: int = 0

    def inside(self) -> Column:
        v = finite(F.col(f"`{self.column}`").cast("double"))
        keep = v.isNotNull()
        if self.lo is not None:
            keep &= v > self.lo
        if self.hi is not None:
            keep &= v < self.hi
        return F.when(keep, v)

    def marks(self) -> Column:
        """Values a little below and above the wanted ones, by a sketch."""
        a, b = (self.first - self.below) / self.size, (self.last - self.below) / self.size
        return _marks(self.inside(), a, b)

    def around(self, lo: float, hi: float) -> list[Column]:
        """Numbers of values inside that are below lo, equal to it, between, and equal to hi."""
        v = self.inside()
        return [F.count_if(v < lo), F.count_if(v == lo), F.count_if((v > lo) & (v < hi)), F.count_if((v == hi) & (v > lo))]

    def settle(self, lo: float, hi: float, under: int, at_lo: int, between: int, at_hi: int) -> tuple[dict[int, float], list[_Bracket]]:
        """(order statistics that are lo or hi, brackets of the others)."""
        found, inner = {}, []
        for k in range(self.first, self.last + 1):
            i = k - self.below - under
            if 0 <= i < at_lo:
                found[k] = lo
            elif at_lo <= i < at_lo + between:
                inner.append(k)
            elif at_lo + between <= i < at_lo + between + at_hi:
                found[k] = hi
            else:
                raise ArithmeticError("a sketch left its bounds")
        rest = [_Bracket(self.column, inner[0], inner[-1], between, lo, hi, self.below + under + at_lo)] if inner else []
        return found, rest


def _marks(v: Column, a: float, b: float) -> Column:
    return F.percentile_approx(v, F.array(F.lit(max(0.0, a - MARGIN)), F.lit(min(1.0, b + MARGIN))), ACCURACY)


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], keep: int = KEEP) -> dict[str, list[float] | None]:
    """Quantiles of each column by linear interpolation between its finite values; None without any.

    Jobs run at once, three scans of `df` in most cases: store it first if it is costly.
    """
    return with_quantiles(df, columns, shares, [], keep)[0]


def with_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float], also: Sequence[Column], keep: int = KEEP) -> tuple[dict[str, list[float] | None], Row | None]:
    """`exact_quantiles`, and the row of other aggregates that its first scan takes along."""
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}, None
    value = {c: finite(F.col(f"`{c}`").cast("double")) for c in columns}
    # one scan counts and marks, with one sketch a column: a share's rank is that share of the count, but for one place
    sides = [min(1.0, max(0.0, q + side)) for q in shares for side in (-MARGIN, MARGIN)]
    sketch = lambda c: F.percentile_approx(value[c], F.array(*map(F.lit, sides)), ACCURACY)
    head = df.agg(*[F.count(value[c]).alias(f"n{i}") for i, c in enumerate(columns)], *[sketch(c).alias(f"m{i}") for i, c in enumerate(columns)], *also).first()
    n = {c: head[i] for i, c in enumerate(columns)}
    have: dict[tuple[str, int], float] = {}
    todo, marks = [], []
    for i, c in enumerate(columns):
        for j, q in enumerate(shares):
            if n[c]:
                at = q * (n[c] - 1)
                todo.append(_Bracket(c, math.floor(at), math.ceil(at), n[c]))
                marks.append(head[f"m{i}"][2 * j : 2 * j + 2])
    for _ in range(MAX_SCANS):
        many = [k for k, b in enumerate(todo) if b.size > keep]
        if not many:
            break
        if marks is None:
            row = df.agg(*[todo[k].marks().alias(f"m{k}") for k in many]).first()
            marks = {k: row[f"m{k}"] for k in many}
        counts = df.agg(*[x.alias(f"s{k}_{j}") for k in many for j, x in enumerate(todo[k].around(*marks[k]))]).first()
        rest = [b for b in todo if b.size <= keep]
        for k in many:
            found, inner = todo[k].settle(*marks[k], *[counts[f"s{k}_{j}"] for j in range(4)])
            have |= {(todo[k].column, x): v for x, v in found.items()}
            rest += inner
        todo, marks = rest, None
    else:
        raise ArithmeticError("quantiles did not settle")
    # brackets with the same bounds are gathered once
    same: dict[tuple, list[_Bracket]] = {}
    for b in todo:
        same.setdefault((b.column, b.lo, b.hi), []).append(b)
    if same:
        wanted = [sorted({k - b.below for b in group for k in range(b.first, b.last + 1)}) for group in same.values()]
        lists = df.agg(*[F.array_sort(F.collect_list(group[0].inside())).alias(f"s{g}") for g, group in enumerate(same.values())])
        rows = lists.select(*[F.array(*[F.get(f"s{g}", F.lit(i)) for i in at]).alias(f"v{g}") for g, at in enumerate(wanted)]).first()
        for group, at, got in zip(same.values(), wanted, rows):
            have |= {(group[0].column, i + group[0].below): v for i, v in zip(at, got)}
    out: dict[str, list[float] | None] = {}
    for c in columns:
        values = []
        for q in shares:
            if n[c]:
                at = q * (n[c] - 1)
                a, b = have[c, math.floor(at)], have[c, math.ceil(at)]
                values.append(a + (b - a) * (at - math.floor(at)))
        out[c] = values or None
    return out, head


def grouped_quantiles(df: DataFrame, by: Sequence[str], column: str, shares: dict[str, float], keep: int = KEEP, store: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(by, a column a share) with each group's exact quantiles by linear interpolation; a null key is a group.

    A group without finite values has no row. A bracket is a row (by, bounds, wanted order statistics); in a round
    a sketch of each bracket's values gives marks (close to the shares at first, then MARKS of them), partial counts at and between them tell which of these hold
    something wanted, and those between become the next brackets. So however many rows a group has, no
    task gets more than `keep` distinct values of a bracket to sort, and equal values are one row by then. Jobs run at once,
    two scans of `df` a round: store it first if it is costly. `store` cuts the lineage of the brackets, checkpoint() by default.
    """
    store = store or (lambda x: x.checkpoint())
    keys = list(by)
    rows = df.select(*keys, finite(F.col(f"`{column}`").cast("double")).alias("_v")).where("_v is not null")
    at = [f(F.lit(float(q)) * (F.col("_n") - 1)).cast("long") for q in shares.values() for f in (F.floor, F.ceil)]
    size = store(rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")))
    none = F.lit(None).cast("double")
    brackets = size.select(*keys, none.alias("_lo"), none.alias("_hi"), F.lit(0).cast("long").alias("_below"), F.array_distinct(F.array(*at)).alias("_ks"), "_n")
    parts: list[DataFrame] = []
    at_shares = sorted({min(1.0, max(0.0, q + side)) for q in shares.values() for side in (-MARGIN, MARGIN)})
    for scan in range(MAX_SCANS):
        parts.append(_sorted_statistics(rows, brackets.where(F.col("_n") <= keep), keys))
        large = brackets.where(F.col("_n") > keep)
        if large.isEmpty():
            break
        cut = store(_cut(rows, large, keys, [i / MARKS for i in range(MARKS + 1)] if scan else at_shares, store))
        parts.append(cut.where("_equal").select(*keys, F.explode("_ks").alias("_k"), F.col("_lo").alias("_v")))
        brackets = cut.where("not _equal").drop("_equal")
    else:
        raise ArithmeticError("quantiles did not settle")
    found = reduce(DataFrame.unionByName, parts).groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_k", "_v"))).alias("_at"))  # two values a share
    both = _same_keys(size, found, keys)

    def value(q: float) -> Column:
        place = F.lit(float(q)) * (F.col("_n") - 1)
        a, b = (F.element_at("_at", f(place).cast("long")) for f in (F.floor, F.ceil))
        return a + (b - a) * (place - F.floor(place))

    return both.select(*keys, *[value(q).alias(name) for name, q in shares.items()])


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], *more: Column) -> DataFrame:
    """Inner join on the keys, null equal to null; the right side's keys go."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    same = [F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`")) for k in keys]
    return left.join(other, reduce(and_, [*same, *more])).drop(*[f"_r_{k}" for k in keys])


def _inside(rows: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the groups with the brackets that their values lie in, bounds left out."""
    inside = (F.col("_lo").isNull() | (F.col("_v") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_v") < F.col("_hi")))
    return _same_keys(rows, brackets, keys, inside)


def _sorted_statistics(rows: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(by, _k, _v) of brackets with few values: equal values are counted first, then all are added up in order."""
    counts = _inside(rows, brackets.drop("_n"), keys).groupBy(*keys, "_lo", "_hi", "_below", "_ks", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = F.col("_below") + F.sum("_c").over(Window.partitionBy(*keys, "_lo", "_hi").orderBy("_v"))
    counts = counts.withColumn("_upto", upto)
    return counts.select(*keys, F.explode(F.filter("_ks", lambda k: (k < F.col("_upto")) & (k >= F.col("_upto") - F.col("_c")))).alias("_k"), "_v")


def _cut(rows: DataFrame, brackets: DataFrame, keys: Sequence[str], at: list[float], store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Of each bracket, cut by marks at the shares `at`, the parts with wanted statistics: single values (_equal, then _lo is it) and what lies between."""
    held = [*keys, "_lo", "_hi", "_below", "_ks"]
    sketch = F.percentile_approx("_v", F.array(*map(F.lit, at)), ACCURACY)
    # stored, so that both uses see the same marks: a sketch depends on the order of its merges
    marked = store(_inside(rows, brackets.drop("_n"), keys).groupBy(*held).agg(F.array_sort(F.array_distinct(sketch)).alias("_marks")))
    placed = _inside(rows, marked, keys)
    placed = placed.withColumns({"_i": F.size(F.filter("_marks", lambda m: m < F.col("_v"))), "_equal": F.array_contains("_marks", F.col("_v"))})
    part = placed.groupBy(*held, "_marks", "_i", "_equal").agg(F.count(F.lit(1)).alias("_n"))  # two rows a mark and bracket
    order = Window.partitionBy(*keys, "_lo", "_hi").orderBy("_i", "_equal")
    part = part.withColumn("_below", F.col("_below") + F.sum("_n").over(order) - F.col("_n"))
    part = part.withColumn("_ks", F.filter("_ks", lambda k: (k >= F.col("_below")) & (k < F.col("_below") + F.col("_n")))).where(F.size("_ks") > 0)
    mark = lambda i: F.get("_marks", i)
    lo = F.when(F.col("_equal"), mark(F.col("_i"))).when(F.col("_i") > 0, mark(F.col("_i") - 1)).otherwise(F.col("_lo"))
    hi = F.when(F.col("_i") < F.size("_marks"), mark(F.col("_i"))).otherwise(F.col("_hi"))
    return part.select(*keys, lo.alias("_lo"), hi.alias("_hi"), "_below", "_ks", "_n", "_equal")
