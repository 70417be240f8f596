"""Parallel pre-period trends: slopes of pairs, aggregate tests, selection of pairs."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from terrapair.config import TrendConfig
from terrapair.functions.columns import finite, t_sf2
from terrapair.functions.quantiles import exact_quantiles
from terrapair.functions.ols import grouped_ols, min_valid, row_ols
from terrapair.functions.ranking import global_rank


def attach_series(pairs: DataFrame, project: DataFrame, years: Sequence[int], prefix: str = "NDVI_") -> DataFrame:
    """Donor series become ref_ columns; the project's are joined as proj_ columns by proj_idx.

    Joining by position instead (`attach_by_position`) can repeat pairs where positions repeat.
    """
    pairs = pairs.withColumnsRenamed({f"{prefix}{y}": f"ref_{prefix}{y}" for y in years})
    side = project.select("proj_idx", *[F.col(f"{prefix}{y}").alias(f"proj_{prefix}{y}") for y in years])
    return pairs.join(side, "proj_idx", "left")


def attach_by_position(pairs: DataFrame, project: DataFrame, years: Sequence[int], decimals: int = 7, prefix: str = "NDVI_") -> DataFrame:
    """The same by longitude and latitude rounded to 7 decimals; the first row of a position counts."""
    pairs = pairs.withColumnsRenamed({f"{prefix}{y}": f"ref_{prefix}{y}" for y in years})
    keys = [F.round("lon", decimals).alias("_lon"), F.round("lat", decimals).alias("_lat")]
    cols = [F.col(f"{prefix}{y}").alias(f"proj_{prefix}{y}") for y in years]
    side = project.select(*keys, *cols).dropDuplicates(["_lon", "_lat"])
    left = pairs.withColumns({"_lon": F.round("proj_lon", decimals), "_lat": F.round("proj_lat", decimals)})
    return left.join(side, ["_lon", "_lat"], "left").drop("_lon", "_lat")


def pair_slopes(pairs: DataFrame, years: Sequence[int], cfg: TrendConfig = TrendConfig(), prefix: str = "NDVI_") -> DataFrame:
    """Slopes and p-values of both sides, their difference, and the flags ols_valid and pair_slope_ok.

    No shuffle: a row's series are its own columns.
    """
    least = min_valid(len(years), cfg.min_valid_share)
    for side in ("ref", "proj"):
        pairs = pairs.withColumn(f"_{side}", row_ols([f"{side}_{prefix}{y}" for y in years], years, least))
        pairs = pairs.withColumns({f"{side}_slope": F.col(f"_{side}.slope"), f"{side}_pvalue_slope0": F.col(f"_{side}.pvalue"), f"{side}_valid_n": F.col(f"_{side}.n")}).drop(f"_{side}")
    signed = F.col("ref_slope") - F.col("proj_slope")
    pairs = pairs.withColumns({"slope_diff_signed": signed, "slope_diff": F.abs(signed), "ols_valid": signed.isNotNull()})
    return pairs.withColumn("pair_slope_ok", F.coalesce(F.col("slope_diff") <= cfg.slope_threshold, F.lit(False)))


def to_long(pairs: DataFrame, years: Sequence[int], pair_id: str = "pair_id", prefix: str = "NDVI_") -> DataFrame:
    """[pair_id, year, group (1 project, 0 reference), value] of every finite value."""
    cells = [F.struct(F.lit(float(y)).alias("year"), F.lit(g).alias("group"), finite(F.col(f"{side}_{prefix}{y}").cast("double")).alias("value")) for y in years for g, side in ((1.0, "proj"), (0.0, "ref"))]
    return pairs.select(pair_id, F.explode(F.array(*cells)).alias("c")).select(pair_id, "c.*").where("value is not null")


#: Slope differences are compared at this many decimals, so that equal ones don't depend on the order of additions.
DIGITS = 12
#: Least standard error of an interaction: exact lines have a t of 0 instead of none.
SE_LEAST = 1e-15


def interaction_sums(long: DataFrame) -> DataFrame:
    """One row: the group-by-year interaction of y = b0 + b1 g + b2 year + b3 g year and its t.

    b3 is the difference of the two groups' slopes; all from one grouped aggregate.
    """
    g = long.groupBy("group").agg(*grouped_ols("year", "value"), F.collect_set("year").alias("years"))
    one = lambda k, c: F.max(F.when(F.col("group") == k, F.col(c)))
    wide = g.agg(
        F.count(F.lit(1)).alias("groups"),
        F.size(F.array_distinct(F.flatten(F.collect_list("years")))).alias("n_years"),
        *[one(k, c).alias(f"{c}{int(k)}") for k in (0.0, 1.0) for c in ("slope", "sxx", "sxy", "syy", "n")],
    )
    sse = [F.greatest(F.col(f"syy{k}") - F.col(f"sxy{k}") * F.col(f"sxy{k}") / F.col(f"sxx{k}"), F.lit(0.0)) for k in (0, 1)]
    n = F.col("n0") + F.col("n1")
    se = F.greatest(F.sqrt((sse[0] + sse[1]) / (n - 4) * (F.lit(1.0) / F.col("sxx0") + F.lit(1.0) / F.col("sxx1"))), F.lit(SE_LEAST))
    ok = (F.col("groups") == 2) & (n >= 8) & (F.col("n_years") >= 3) & (F.col("sxx0") > 0) & (F.col("sxx1") > 0)
    diff = F.when(ok, F.col("slope1") - F.col("slope0"))
    return wide.select(n.alias("n"), diff.alias("interaction"), F.when(ok, se).alias("se"), F.when(ok, diff / se).alias("t"))


@dataclass(frozen=True)
class Test:
    n: int
    estimate: float | None
    t: float | None
    pvalue: float | None
    passed: bool


def interaction_test(long: DataFrame, cfg: TrendConfig = TrendConfig()) -> Test:
    r = interaction_sums(long).first()
    if r is None or r["t"] is None:
        return Test(int(r["n"] or 0) if r else 0, r["interaction"] if r else None, None, None, False)
    p = t_sf2(r["t"], r["n"] - 4)
    return Test(r["n"], r["interaction"], r["t"], p, p > cfg.p_threshold)


def paired_sums(pairs: DataFrame) -> DataFrame:
    """One row: n, mean, median |d| and t of the pairs' slope differences d (project - reference).

    The median is searched at once, in two or three scans of `pairs`: store them first if they are costly.
    """
    d = F.when(F.col("ols_valid"), F.col("proj_slope") - F.col("ref_slope"))
    d = pairs.select(d.alias("d")).where("d is not null")
    median = exact_quantiles(d.select(F.abs("d").alias("a")), ["a"], [0.5])["a"]
    s = d.agg(F.count("d").alias("n"), F.avg("d").alias("mean_diff"), F.stddev_samp("d").alias("sd")).withColumn("median_abs_diff", F.lit(median[0] if median else None).cast("double"))
    t = F.when((F.col("n") >= 3) & (F.col("sd") > 0), F.col("mean_diff") / (F.col("sd") / F.sqrt("n")))
    return s.withColumn("t", t)


def _paired(r: Row, cfg: TrendConfig) -> Test:
    n, mean, sd = int(r["n"] or 0), r["mean_diff"], r["sd"]
    if n < 3 or mean is None or not sd:  # without a spread there is no t, and the test fails
        return Test(n, mean, None, None, False)
    t = mean / (sd / math.sqrt(n))
    p = t_sf2(t, n - 1)
    return Test(n, mean, t, p, p > cfg.p_threshold and abs(mean) <= cfg.slope_threshold)


def paired_slope_test(pairs: DataFrame, cfg: TrendConfig = TrendConfig()) -> Test:
    d = F.when(F.col("ols_valid"), F.col("proj_slope") - F.col("ref_slope"))
    return _paired(pairs.agg(F.count(d).alias("n"), F.avg(d).alias("mean_diff"), F.stddev_samp(d).alias("sd")).first(), cfg)


#: Sums of a series' points that an interaction needs; years are counted from a middle one.
_POINTS = ("n", "x", "y", "xx", "xy", "yy")


def _point_sums(columns: Sequence[str], years: Sequence[int], middle: float) -> dict[str, Column]:
    """Sums over the finite values of one row's series."""
    at = [(float(y) - middle, finite(F.col(f"`{c}`").cast("double"))) for c, y in zip(columns, years)]

    def total(of) -> Column:
        return reduce(add, [F.coalesce(of(x, v), F.lit(0.0)) for x, v in at])

    return {
        "n": total(lambda x, v: v * 0 + 1),
        "x": total(lambda x, v: v * 0 + x),
        "y": total(lambda x, v: v),
        "xx": total(lambda x, v: v * 0 + x * x),
        "xy": total(lambda x, v: v * x),
        "yy": total(lambda x, v: v * v),
    }


def _row_sums(years: Sequence[int], prefix: str) -> tuple[dict[str, Column], dict[str, Column]]:
    """What a pair adds to both tests' sums, and the years that it has a value in."""
    middle = sum(years) / len(years)
    sums = {f"{k}{g}": v for g, side in ((1, "proj"), (0, "ref")) for k, v in _point_sums([f"{side}_{prefix}{y}" for y in years], years, middle).items()}
    seen = {f"y{y}": F.coalesce(finite(F.col(f"proj_{prefix}{y}").cast("double")), finite(F.col(f"ref_{prefix}{y}").cast("double"))).isNotNull().cast("int") for y in years}
    return sums, seen


def _summed(sums: Sequence[str], seen: Sequence[str]) -> list[Column]:
    return [F.count("d").alias("c"), F.sum("d").alias("s"), F.sum(F.col("d") * F.col("d")).alias("q"), *[F.sum(k).alias(k) for k in sums], *[F.max(k).alias(k) for k in seen]]


def _statistics(parts: DataFrame, seen: Sequence[str], *keys: str) -> DataFrame:
    """(*keys, n, mean_diff, sd; n_obs, interaction, se, t) from the sums of each set of pairs."""
    c = F.col
    var = F.greatest(c("q") - c("s") * c("s") / c("c"), F.lit(0.0)) / (c("c") - 1)
    sxx, sxy, syy = ([c(f"{a}{b}{g}") - c(f"{a}{g}") * c(f"{b}{g}") / c(f"n{g}") for g in (0, 1)] for a, b in ("xx", "xy", "yy"))
    n = c("n0") + c("n1")
    ok = (c("n0") > 0) & (c("n1") > 0) & (n >= 8) & (reduce(add, [c(k) for k in seen]) >= 3) & (sxx[0] > 1e-9) & (sxx[1] > 1e-9)
    beta = F.when(ok, sxy[1] / sxx[1] - sxy[0] / sxx[0])
    sse = [F.greatest(syy[g] - sxy[g] * sxy[g] / sxx[g], F.lit(0.0)) for g in (0, 1)]
    se = F.when(ok, F.greatest(F.sqrt((sse[0] + sse[1]) / (n - 4) * (F.lit(1.0) / sxx[0] + F.lit(1.0) / sxx[1])), F.lit(SE_LEAST)))
    return parts.select(
        *keys, c("c").alias("n"), F.when(c("c") > 0, c("s") / c("c")).alias("mean_diff"), F.when(c("c") > 1, F.sqrt(var)).alias("sd"), n.cast("long").alias("n_obs"), beta.alias("interaction"), se.alias("se"), (beta / se).alias("t")
    )


def prefix_statistics(pairs: DataFrame, sizes: Sequence[int], years: Sequence[int], pair_id: str = "pair_id", prefix: str = "NDVI_") -> DataFrame:
    """Both tests' statistics of every nested prefix of the valid pairs by slope difference.

    (size, n, mean_diff, sd; n_obs, interaction, se, t). One rank, then one sum for each step from a
    prefix to the next longer one; their running totals are the prefixes.
    """
    sizes = sorted(sizes)
    sums, seen = _row_sums(years, prefix)
    valid = pairs.where("ols_valid").select(F.round("slope_diff", DIGITS).alias("slope_diff"), pair_id, (F.col("proj_slope") - F.col("ref_slope")).alias("d"), *[v.alias(k) for k, v in (sums | seen).items()])
    ranked = global_rank(valid, "slope_diff", pair_id)
    step = F.array_min(F.filter(F.array(*map(F.lit, sizes)), lambda k: k >= F.col("rank")))
    parts = ranked.withColumn("size", step).where("size is not null").groupBy("size").agg(*_summed(sums, seen))
    upto = Window.orderBy("size").rowsBetween(Window.unboundedPreceding, 0)  # a row for each size
    parts = parts.select("size", *[F.sum(c).over(upto).alias(c) for c in ("c", "s", "q", *sums)], *[F.max(c).over(upto).alias(c) for c in seen])
    return _statistics(parts, list(seen), "size")


@dataclass(frozen=True)
class Verdict:
    """Whether a group's pairs are parallel in aggregate, and how many of them are selected."""

    compliant: bool
    n_selected: int


def group_verdicts(pairs: DataFrame, by: str, years: Sequence[int], cfg: TrendConfig = TrendConfig(), pair_id: str = "pair_id", prefix: str = "NDVI_") -> dict[str, Verdict]:
    """`select_parallel`'s verdict on each of a handful of groups of `pairs` (after `pair_slopes`).

    The first set of pairs of every group is tested in one grouped sum; only groups that fail it go
    through their prefixes.
    """
    sums, seen = _row_sums(years, prefix)
    rows = pairs.select(by, pair_id, "ols_valid", F.coalesce(F.col("ols_valid") & F.col("pair_slope_ok"), F.lit(False)).alias("fits"), F.when(F.col("ols_valid"), F.col("proj_slope") - F.col("ref_slope")).alias("d"), *[v.alias(k) for k, v in (sums | seen).items()])
    # both sets that may come first: the pairs within the threshold, and all valid ones
    sets = F.array(F.when(F.col("fits"), F.lit("fits")), F.when(F.col("ols_valid"), F.lit("valid")), F.lit("all"))
    parts = rows.withColumn("_set", F.explode(F.array_compact(sets))).groupBy(by, "_set").agg(F.count(F.lit(1)).alias("rows"), *_summed(sums, seen))
    found = {(r[by], r["_set"]): r for r in _statistics(parts, list(seen), by, "_set", "rows").collect()}  # three rows a group
    out = {}
    for g in {g for g, _ in found}:
        n = found[g, "all"]["rows"]
        fits = found.get((g, "fits"))
        base = fits if fits is not None and fits["rows"] >= least_pairs(n, cfg) else found.get((g, "valid"))
        if base is not None and _paired(base, cfg).passed and _interaction(base, cfg).passed:
            out[g] = Verdict(True, base["n"])
        else:
            s = select_parallel(pairs.where(F.col(by) == g), years, cfg, pair_id, prefix)
            out[g] = Verdict(s.compliant, s.n_selected)
    return out


def _interaction(r: Row, cfg: TrendConfig) -> Test:
    if r["t"] is None:
        return Test(int(r["n_obs"] or 0), r["interaction"], None, None, False)
    p = t_sf2(r["t"], r["n_obs"] - 4)
    return Test(r["n_obs"], r["interaction"], r["t"], p, p > cfg.p_threshold)


def prefix_sizes(n_valid: int, n_pairs: int, cfg: TrendConfig = TrendConfig()) -> dict[float, int]:
    """Prefix length of each fraction of the valid pairs, longest first; those beyond all are left out.

    None is shorter than the least number of pairs, which goes by all pairs.
    """
    least = least_pairs(n_pairs, cfg)
    sizes = {f: max(least, int(n_valid * f)) for f in cfg.fractions}
    return {f: k for f, k in sizes.items() if k <= n_valid}


def least_pairs(n: int, cfg: TrendConfig) -> int:
    return max(cfg.min_pairs, int(cfg.min_fraction * n))


@dataclass(frozen=True)
class Selection:
    """`pairs` have the columns selected and twin_compliant; both tests must pass for that."""

    pairs: DataFrame
    mode: str
    test: Test
    interaction: Test
    compliant: bool
    n_selected: int
    fraction: float


def select_parallel(pairs: DataFrame, years: Sequence[int], cfg: TrendConfig = TrendConfig(), pair_id: str = "pair_id", prefix: str = "NDVI_") -> Selection:
    """Pairs whose trends are parallel in aggregate: the interaction and the paired slope test pass.

    First all valid pairs within the slope threshold (or, if these are too few, all valid
    ones); failing that the longest passing prefix by slope difference; failing that the
    best one (the smallest mean difference, then the largest interaction p), which is selected
    but not compliant. With no prefix to try, the first set stays, not compliant either.
    """
    head = pairs.agg(F.count(F.lit(1)).alias("all"), F.count_if("ols_valid").alias("valid"), F.count_if(F.col("ols_valid") & F.col("pair_slope_ok")).alias("ok")).first()
    n = head["all"]
    keep = F.col("ols_valid") & (F.col("pair_slope_ok") if head["ok"] >= least_pairs(n, cfg) else F.lit(True))
    base = pairs.where(keep)
    test, inter = paired_slope_test(base, cfg), interaction_test(to_long(base, years, pair_id, prefix), cfg)

    def done(mode: str, compliant: bool) -> Selection:
        out = pairs.withColumn("selected", F.coalesce(keep, F.lit(False)))
        return Selection(out.withColumn("twin_compliant", F.col("selected") & F.lit(compliant)), mode, test, inter, compliant, test.n, test.n / max(1, n))

    if test.passed and inter.passed:
        return done("fixed_pair_slope_threshold", True)
    sizes = prefix_sizes(head["valid"], n, cfg)
    if not sizes:
        return done("failed_no_valid_candidate", False)
    rows = {r["size"]: r for r in prefix_statistics(pairs, sorted(set(sizes.values())), years, pair_id, prefix).collect()}  # a row for each size
    tests = [(f, k, _paired(rows[k], cfg), _interaction(rows[k], cfg)) for f, k in sizes.items()]
    won = next((x for x in tests if x[2].passed and x[3].passed), None)
    fraction, size, test, inter = won or min(tests, key=lambda x: (round(abs(x[2].estimate), DIGITS) if x[2].estimate is not None else math.inf, -(x[3].pvalue or 0.0)))
    ranked = global_rank(pairs.where("ols_valid").select(F.round("slope_diff", DIGITS).alias("slope_diff"), pair_id), "slope_diff", pair_id).where(F.col("rank") <= size).select(F.col(pair_id).alias("_pick"))
    marked = pairs.join(ranked, pairs[pair_id] == ranked["_pick"], "left").withColumn("selected", F.col("_pick").isNotNull()).drop("_pick")
    mode = "iterative_smallest_slope_diff" if won else "best_available_failed_or_marginal"
    return Selection(marked.withColumn("twin_compliant", F.col("selected") & F.lit(bool(won))), mode, test, inter, bool(won), size, fraction)


def trend_table(long: DataFrame, sets: Sequence[str] = ()) -> DataFrame:
    """Mean and standard error by (sets, group, year)."""
    se = F.stddev_samp("value") / F.sqrt(F.count("value"))
    return long.groupBy(*sets, "group", "year").agg(F.avg("value").alias("mean"), se.alias("se"), F.count("value").alias("n"))
