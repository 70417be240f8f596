"""Trend queries: yearly order totals of neighbouring customers as paired series."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapair.config import TrendConfig
from terrapair.functions.ols import row_ols
from terrapair.operators import scenes, trend
from terrapair.plans.pipeline import shared_store
from terrapair.plans.registry import query, r6, table

YEARS = tuple(range(1995, 2001))
CFG = TrendConfig(slope_threshold=20000.0)
_TOTALS = "totals as (select o_custkey, year(o_orderdate) as season, sum(o_totalprice) as v from orders where year(o_orderdate) between 1995 and 2000 group by 1, 2)"
_SLOPES = f"""{_TOTALS}, slopes as (select o_custkey, case when regr_count(v, season) >= 4 then regr_slope(v, season) end as slope, regr_count(v, season)::int as n,
  regr_sxx(v, season) as sxx, regr_sxy(v, season) as sxy, regr_syy(v, season) as syy from totals group by 1)"""
_PAIRS = f"""{_SLOPES}, pairs as (select c.c_custkey as pair_id, p.slope as proj_slope, r.slope as ref_slope, coalesce(p.n, 0) as proj_valid_n, coalesce(r.n, 0) as ref_valid_n, r.slope - p.slope as slope_diff_signed, abs(r.slope - p.slope) as slope_diff
  from customer c join customer e on e.c_custkey = c.c_custkey + 1 left join slopes p on p.o_custkey = c.c_custkey left join slopes r on r.o_custkey = c.c_custkey + 1 where c.c_custkey % 2 = 0)"""
_LONG = f"""{_TOTALS}, long as (select c_custkey as pair_id, season::double as year, 1e0 as grp, v from customer join totals on o_custkey = c_custkey where c_custkey % 2 = 0 and exists (select 1 from customer e where e.c_custkey = customer.c_custkey + 1)
  union all select c_custkey - 1, season::double, 0e0, v from customer join totals on o_custkey = c_custkey where c_custkey % 2 = 1)"""


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a customer with a column a year."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("season"), "o_totalprice").where(F.col("season").between(YEARS[0], YEARS[-1]))
    return scenes.wide_years(o.groupBy("o_custkey", "season").agg(F.sum("o_totalprice").alias("v")), ["o_custkey"], YEARS, "v")


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer 2k as a project pixel, 2k + 1 as its reference."""
    s = series(spark, sf_dir)
    c = table(spark, sf_dir, "customer").select("c_custkey")
    name = lambda side: {f"NDVI_{y}": f"{side}_NDVI_{y}" for y in YEARS}
    p = c.where("c_custkey % 2 = 0").join(s, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.col("c_custkey").alias("pair_id"), *name("proj")).withColumnsRenamed(name("proj"))
    r = c.where("c_custkey % 2 = 1").join(s, F.col("c_custkey") == F.col("o_custkey"), "left").select((F.col("c_custkey") - 1).alias("pair_id"), *name("ref")).withColumnsRenamed(name("ref"))
    return p.join(r, "pair_id")


def sloped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.pair_slopes(pairs(spark, sf_dir), YEARS, CFG)


@query(f"with {_TOTALS} select o_custkey, " + ", ".join(f"round(max(v) filter (where season = {y}), 4) as NDVI_{y}" for y in YEARS) + " from totals group by 1")
def annual_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(spark, sf_dir).select("o_custkey", *[r6(f"NDVI_{y}", digits=4) for y in YEARS])


@query(f"with {_LONG} select pair_id, year, grp, round(v, 4) as value from long")
def annual_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trend.to_long(pairs(spark, sf_dir), YEARS).select("pair_id", "year", F.col("group").alias("grp"), r6("value", digits=4))


@query(f"with {_SLOPES} select o_custkey, round(slope, 3) + 0 as slope, n from slopes")
def pixel_ols_slopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = series(spark, sf_dir).select("o_custkey", row_ols([f"NDVI_{y}" for y in YEARS], YEARS, 4).alias("o"))
    return s.select("o_custkey", r6("o.slope", "slope", 3), F.col("o.n").alias("n"))


@query(f"""
with {_SLOPES}, t as (select o_custkey, slope, n, atan(abs(slope) / sqrt(greatest(syy - sxy * sxy / sxx, 0) / (n - 2) / sxx) / sqrt(n - 2)) as th from slopes where slope is not null)
select o_custkey, round(1 - case n - 2 when 1 then 2 / pi() * th when 2 then sin(th) when 3 then 2 / pi() * (th + sin(th) * cos(th)) when 4 then sin(th) * (1 + power(cos(th), 2) / 2) end, 6) as pvalue from t""")
def pixel_ols_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = series(spark, sf_dir).select("o_custkey", row_ols([f"NDVI_{y}" for y in YEARS], YEARS, 4).alias("o")).where("o.slope is not null")
    return s.select("o_custkey", r6("o.pvalue", "pvalue"))


@query(f"""
with {_PAIRS} select pair_id, round(proj_slope, 3) + 0 as proj_slope, round(ref_slope, 3) + 0 as ref_slope, proj_valid_n, ref_valid_n, round(slope_diff, 3) + 0 as slope_diff, slope_diff is not null as ols_valid, coalesce(slope_diff <= 2e4, false) as pair_slope_ok from pairs""")
def pair_slope_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sloped(spark, sf_dir).select("pair_id", r6("proj_slope", digits=3), r6("ref_slope", digits=3), "proj_valid_n", "ref_valid_n", r6("slope_diff", digits=3), "ols_valid", "pair_slope_ok")


@query(f"""
with {_LONG}, g as (select grp, regr_slope(v, year) s, regr_sxx(v, year) sxx, greatest(regr_syy(v, year) - power(regr_sxy(v, year), 2) / regr_sxx(v, year), 0) sse, count(*) n from long group by 1),
w as (select max(s) filter (where grp = 1) - max(s) filter (where grp = 0) d, sum(n)::bigint n, sum(sse) sse, sum(1 / sxx) inv from g)
select n, round(d, 3) as interaction, round(sqrt(sse / (n - 4) * inv), 3) as se, round(d / sqrt(sse / (n - 4) * inv), 6) as t from w""")
def interaction_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = trend.interaction_sums(trend.to_long(pairs(spark, sf_dir), YEARS))
    return out.select("n", r6("interaction", digits=3), r6("se", digits=3), r6("t"))


@query(f"""
with {_PAIRS}, d as (select proj_slope - ref_slope as d from pairs where slope_diff is not null)
select count(d) as n, round(avg(d), 3) as mean_diff, round(quantile_cont(abs(d), 0.5), 3) as median_abs_diff, round(stddev_samp(d), 3) as sd, round(avg(d) / (stddev_samp(d) / sqrt(count(d))), 6) as t from d""")
def paired_slope_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = trend.paired_sums(shared_store(spark, "slopes")(sloped(spark, sf_dir)))
    return out.select("n", r6("mean_diff", digits=3), r6("median_abs_diff", digits=3), r6("sd", digits=3), r6("t"))


_SIZES = "sizes as (select distinct greatest(30, floor(n_all * 3e-1), floor(n_valid * (95 - 5 * i) / 100))::bigint as size, n_valid from (select count(*) n_all, count(slope_diff) n_valid from pairs), generate_series(0, 13) g(i)), k as (select size from sizes where size <= n_valid)"
_PREFIX = f"""{_PAIRS}, {_SIZES}, v as (select pair_id, proj_slope - ref_slope as d, row_number() over (order by slope_diff, pair_id) as r from pairs where slope_diff is not null),
pts as (select v.r, 1 as grp, t.season, t.v from v join totals t on t.o_custkey = v.pair_id union all select v.r, 0, t.season, t.v from v join totals t on t.o_custkey = v.pair_id + 1),
pt as (select size, count(d) as n, avg(d) as mean_diff, stddev_samp(d) as sd from k, v where r <= size group by 1),
g as (select size, grp, regr_slope(v, season) s, regr_sxx(v, season) sxx, greatest(regr_syy(v, season) - power(regr_sxy(v, season), 2) / regr_sxx(v, season), 0) sse, count(*) n from k, pts where r <= size group by 1, 2),
it as (select size, sum(n)::bigint as n_obs, max(s) filter (where grp = 1) - max(s) filter (where grp = 0) as beta, sqrt(sum(sse) / (sum(n) - 4) * sum(1 / sxx)) as se from g group by 1)"""


@query(f"""
with {_PREFIX}
select size, n, round(mean_diff, 3) + 0 as mean_diff, round(sd, 3) as sd, n_obs, round(beta, 3) + 0 as interaction, round(se, 3) as se, round(beta / se, 6) + 0 as t from pt join it using (size)""")
def prefix_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both tests of every prefix; the slopes are stored, since sizes and ranks read them too."""
    s = shared_store(spark, "slopes")(sloped(spark, sf_dir))
    head = s.agg(F.count(F.lit(1)), F.count_if("ols_valid")).first()
    sizes = trend.prefix_sizes(head[1], head[0], CFG)
    out = trend.prefix_statistics(s, sorted(set(sizes.values())), YEARS)
    return out.select(F.col("size").cast("long").alias("size"), "n", r6("mean_diff", digits=3), r6("sd", digits=3), "n_obs", r6("interaction", digits=3), r6("se", digits=3), r6("t"))


#: Two-sided 5 % point of t by Cornish-Fisher terms in 1 / dof: p > 0.05 is |t| below it.
_POINT = "(1.959963984540054 + 2.3722712 / {0} + 2.8225 / ({0} * {0}) + 2.55585 / power({0}, 3) + 1.59 / power({0}, 4))"
_PASSED = f"(abs(mean_diff / (sd / sqrt(n))) < {_POINT.format('(n - 1)')} and abs(mean_diff) <= 2e4 and abs(beta / se) < {_POINT.format('(n_obs - 4)')})"


@query(f"""
with {_PREFIX}, head as (select count(*) n_all, count(slope_diff) n_valid, count(*) filter (where slope_diff <= 2e4) n_ok from pairs),
base as (select pair_id, proj_slope - ref_slope as d from pairs, head where slope_diff is not null and (slope_diff <= 2e4 or n_ok < greatest(30, floor(n_all * 3e-1)))),
bp as (select count(d) as n, avg(d) as mean_diff, stddev_samp(d) as sd from base),
bl as (select 1 as grp, t.season, t.v from base b join totals t on t.o_custkey = b.pair_id union all select 0, t.season, t.v from base b join totals t on t.o_custkey = b.pair_id + 1),
bg as (select grp, regr_slope(v, season) s, regr_sxx(v, season) sxx, greatest(regr_syy(v, season) - power(regr_sxy(v, season), 2) / regr_sxx(v, season), 0) sse, count(*) n from bl group by 1),
bi as (select sum(n) as n_obs, max(s) filter (where grp = 1) - max(s) filter (where grp = 0) as beta, sqrt(sum(sse) / (sum(n) - 4) * sum(1 / sxx)) as se from bg),
first as (select {_PASSED} as passed from bp, bi),
tried as (select size, {_PASSED} as passed, abs(mean_diff) as off, abs(beta / se) as far from pt join it using (size)),
best as (select size, passed from tried order by passed desc, case when passed then -size else off end, far limit 1),
choice as (select case when first.passed then 'fixed_pair_slope_threshold' when best.size is null then 'failed_no_valid_candidate' when best.passed then 'iterative_smallest_slope_diff' else 'best_available_failed_or_marginal' end as mode, size, first.passed or coalesce(best.passed, false) as compliant from first left join best on true)
select p.pair_id, case when mode like 'f%' then b.pair_id is not null else coalesce(v.r <= size, false) end as selected, compliant and (case when mode like 'f%' then b.pair_id is not null else coalesce(v.r <= size, false) end) as twin_compliant, mode
from pairs p left join v on v.pair_id = p.pair_id left join base b on b.pair_id = p.pair_id, choice""")
def parallel_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs that pass both tests."""
    chosen = trend.select_parallel(shared_store(spark, "slopes")(sloped(spark, sf_dir)), YEARS, CFG)
    return chosen.pairs.select("pair_id", "selected", "twin_compliant").withColumn("mode", F.lit(chosen.mode))


@query(f"with {_LONG} select grp, year, round(avg(v), 4) as mean, round(stddev_samp(v) / sqrt(count(v)), 4) as se, count(v) as n from long group by 1, 2")
def parallel_trend_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = trend.trend_table(trend.to_long(pairs(spark, sf_dir), YEARS))
    return out.select(F.col("group").alias("grp"), "year", r6("mean", digits=4), r6("se", digits=4), "n")
