"""Reference area, carbon, interval, baseline and sweep queries on line items as matched cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapair.config import AreaConfig, BaselineConfig, CarbonSpec
from terrapair.operators import area, baseline, carbon, sweep
from terrapair.plans.pipeline import shared_store
from terrapair.plans.registry import CELLS_SQL, GRID, cells, query, r6, table

AREA_HA, YEARS = 15713.91, 6
_C = f"c as (select *, l_partkey / 1e3 as ref_lon, -l_suppkey / 1e3 as ref_lat, l_tax * 1e1 - l_discount * 5e0 as d from ({CELLS_SQL}))"


def controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched rows: cells that share a part and supplier share a position."""
    c = cells(spark, sf_dir, "l_orderkey", "l_linenumber", "l_tax", "l_discount", "l_returnflag", "l_linestatus")
    c = c.withColumns({"ref_lon": F.col("grid_col") / 1000, "ref_lat": -F.col("grid_row") / 1000, "delta_tC_ha_yr": F.col("l_tax") * 10 - F.col("l_discount") * 5})
    return carbon.with_blocks(c, 500.0)


_INTERVAL = f"""{_C}, rows as (select d, round(ref_lon, 7) lo, round(ref_lat, 7) la, floor(x_utm / 5e2) bx, floor(y_utm / 5e2) by_ from c {{where}}),
p as (select count(d) n_rows, avg(d) mean, quantile_cont(d, 0.5) median, stddev_samp(d) sd, count(distinct (lo, la)) n_unique from rows),
b as (select count(*) n_blocks, stddev_samp(m) block_sd from (select avg(d) m from rows group by bx, by_)),
i0 as (select *, case when n_unique >= 2 then n_unique else n_rows end n_eff from p, b),
i1 as (select *, sd / sqrt(n_eff) se, 1.645e0 * sd / sqrt(n_eff) ci_pixel, 1.645e0 * sd / sqrt(n_rows) ci_naive, case when n_blocks >= 2 then 1.645e0 * block_sd / sqrt(n_blocks) end ci_block from i0),
i as (select *, greatest(ci_pixel, ci_block) ci, case when coalesce(ci_block > ci_pixel, false) then 'block' else 'pixel' end ci_source from i1)"""
_CONTROL = _INTERVAL.format(where="where l_returnflag = 'A'")


def interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return baseline.control_interval(controls(spark, sf_dir).where("l_returnflag = 'A'"))


@query(f"""
with {_CONTROL} select n_rows, n_unique, n_eff, round(mean, 8) as mean, round(median, 8) as median, round(sd, 8) as sd, round(se, 8) as se, round(ci_pixel, 8) as ci_pixel, round(ci_naive, 8) as ci_naive,
round(ci, 8) as ci, ci_source, round(mean - ci, 8) as lower, round(mean + ci, 8) as upper, round(case when mean > 0 then ci / mean end, 6) as uncbsl, case when mean > 0 then 'computed' else 'not_applicable_non_positive_mean' end as uncbsl_status from i""")
def control_ci90(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = interval(spark, sf_dir)
    eight = [r6(x, digits=8) for x in ("mean", "median", "sd", "se", "ci_pixel", "ci_naive", "ci", "lower", "upper")]
    return c.select("n_rows", "n_unique", "n_eff", *eight, "ci_source", r6("uncbsl"), "uncbsl_status")


@query(f"""
with {_C}, rows as (select l_returnflag, l_linestatus, d, round(ref_lon, 7) lo, round(ref_lat, 7) la, floor(x_utm / 5e2) bx, floor(y_utm / 5e2) by_ from c),
p as (select l_returnflag, l_linestatus, count(d) n_rows, avg(d) mean, quantile_cont(d, 0.5) median, stddev_samp(d) sd, count(distinct (lo, la)) n_unique from rows group by all),
b as (select l_returnflag, l_linestatus, count(*) n_blocks, stddev_samp(m) block_sd from (select l_returnflag, l_linestatus, avg(d) m from rows group by l_returnflag, l_linestatus, bx, by_) group by all),
i as (select *, greatest(1.645e0 * sd / sqrt(case when n_unique >= 2 then n_unique else n_rows end), case when n_blocks >= 2 then 1.645e0 * block_sd / sqrt(n_blocks) end) ci from p join b using (l_returnflag, l_linestatus) where n_rows >= {BaselineConfig().min_controls})
select l_returnflag, l_linestatus, n_rows, n_unique, n_blocks, round(mean, 8) as mean, round(median, 8) as median, round(ci, 8) as ci from i""")
def control_ci90_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = baseline.control_interval(controls(spark, sf_dir), by=("l_returnflag", "l_linestatus"), store=shared_store(spark))
    return out.select("l_returnflag", "l_linestatus", "n_rows", "n_unique", "n_blocks", *[r6(x, digits=8) for x in ("mean", "median", "ci")])


@query(f"with {_CONTROL} select n_blocks, round(block_sd, 8) as block_sd, round(ci_block, 8) as ci_block, 'computed' as block_status from i")
def block_ci90(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = baseline.block_interval(controls(spark, sf_dir).where("l_returnflag = 'A'"), "delta_tC_ha_yr")
    return out.select("n_blocks", r6("block_sd", digits=8), r6("ci_block", digits=8), "block_status")


_UNIQUE = f"""{_C}, one as (select d from c qualify row_number() over (partition by round(ref_lon, 7), round(ref_lat, 7) order by l_orderkey, l_linenumber, d) = 1),
u as (select count(d) n, avg(d) mean, stddev_samp(d) sd, stddev_samp(d) / sqrt(count(d)) se, 1.645e0 * stddev_samp(d) / sqrt(count(d)) ci from one)"""


@query(f"with {_UNIQUE} select n, round(mean, 8) as mean, round(sd, 8) as sd, round(se, 8) as se, round(ci, 8) as ci, round(case when mean > 0 then ci / mean end, 6) as uncbsl from u")
def uncbsl_dedup_v4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = baseline.unique_interval(controls(spark, sf_dir), order=("l_orderkey", "l_linenumber", "delta_tC_ha_yr"))
    return out.select("n", *[r6(x, digits=8) for x in ("mean", "sd", "se", "ci")], r6("uncbsl"))


@query(f"""
with {_UNIQUE}, r as (select *, greatest(mean, 0) rate from u), s as (select *, case when rate > 0 then ci / rate else 0 end unc, rate * (15713.91e0 * 6e0 * (44e0 / 12e0)) br from r)
select round(rate, 8) as rate, round(unc, 6) as unc, round(br, 4) as br_unadj, round(greatest(br * (1 + 1.25e-2) * (1 + unc), 1e3), 4) as br_crediting from s""")
def baseline_removals_v4(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = baseline.unique_interval(controls(spark, sf_dir), order=("l_orderkey", "l_linenumber", "delta_tC_ha_yr"))
    out = baseline.crediting_baseline(out, AREA_HA, YEARS, br_gov=1000.0)
    return out.select(r6("rate", digits=8), r6("unc"), r6("br_unadj", digits=4), r6("br_crediting", digits=4))


_BASE = f"""{_CONTROL}, pr as (select count(d) project_rows, count(distinct (round(ref_lon, 7), round(ref_lat, 7))) project_unique, avg(d) project_mean, 15713.91e0 area from c where l_returnflag = 'R'),
bl as (select *, mean as rate, project_mean * area as project_total_yr from i, pr)"""


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    project = controls(spark, sf_dir).where("l_returnflag = 'R'")
    return baseline.unadjusted_baseline(interval(spark, sf_dir), baseline.project_summary(project, AREA_HA, lon="ref_lon", lat="ref_lat"), YEARS)


@query(f"""
with {_BASE} select project_rows, project_unique, round(project_mean, 8) as project_mean, round(rate, 8) as rate, round(rate * area, 4) as bl_yr, round(rate * area * 6, 4) as bl_period, round(rate * area * 44e0 / 12e0, 4) as bl_yr_tco2e, round(rate * area * 6 * 44e0 / 12e0, 4) as bl_period_tco2e,
round(ci * area, 4) as ci_total_yr, round(ci * area * 6, 4) as ci_total_period, round(case when rate <> 0 then rate + ci else 0 end, 8) as rate_adjusted, case when rate > 0 then 'computed_positive_baseline' when rate <> 0 then 'computed_negative_baseline_pm_override' else 'zeroed_non_positive_baseline' end as baseline_status,
round(project_total_yr, 4) as project_total_yr, round(project_total_yr - rate * area, 4) as surplus_yr, round(project_total_yr * 6 - rate * area * 6, 4) as surplus_period from bl""")
def unadjusted_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    four = [r6(x, digits=4) for x in ("bl_yr", "bl_period", "bl_yr_tco2e", "bl_period_tco2e", "ci_total_yr", "ci_total_period", "project_total_yr", "surplus_yr", "surplus_period")]
    return base(spark, sf_dir).select("project_rows", "project_unique", r6("project_mean", digits=8), r6("rate", digits=8), *four, r6("rate_adjusted", digits=8), "baseline_status")


@query(f"""
with {_BASE} select area as project_area_ha, 6e0 as period_years, round(rate * 44e0 / 12e0, 8) as bl_mean_tco2e, round(rate * area * 6 * 44e0 / 12e0, 4) as bl_period_tco2e, round(ci * 44e0 / 12e0, 8) as ci_tco2e, ci_source, round(project_total_yr * 6 * 44e0 / 12e0, 4) as project_total_period_tco2e, 1.25e-2 as daf,
round(rate * area * 6 * 44e0 / 12e0 * (1 + 1.25e-2) * (1 + coalesce(case when mean > 0 then ci / mean end, 0)), 4) as br_illustrative_tco2e from bl""")
def pm_handoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = baseline.handoff(base(spark, sf_dir))
    return out.select("project_area_ha", "period_years", r6("bl_mean_tco2e", digits=8), r6("bl_period_tco2e", digits=4), r6("ci_tco2e", digits=8), "ci_source", r6("project_total_period_tco2e", digits=4), "daf", r6("br_illustrative_tco2e", digits=4))


@query(f"""
with c as ({CELLS_SQL}) select distinct grid_row, grid_col, x_utm - 15e0 as xmin, y_utm - 15e0 as ymin, x_utm + 15e0 as xmax, y_utm + 15e0 as ymax, 'native_bounds' as support_mode, 9e-2 as area_ha from c where l_returnflag = 'A'""")
def support_cells_native(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cells(spark, sf_dir, "l_returnflag").where("l_returnflag = 'A'").select("grid_row", "grid_col", F.col("x_utm").alias("x"), F.col("y_utm").alias("y")).distinct()
    bounds = {"ref_cell_xmin": F.col("x") - 15, "ref_cell_ymin": F.col("y") - 15, "ref_cell_xmax": F.col("x") + 15, "ref_cell_ymax": F.col("y") + 15}
    points = c.withColumns(bounds).withColumnsRenamed({"grid_row": "ref_grid_row", "grid_col": "ref_grid_col"})
    out = area.support_cells(points)
    return out.select(F.col("ref_grid_row").alias("grid_row"), F.col("ref_grid_col").alias("grid_col"), "xmin", "ymin", "xmax", "ymax", "support_mode", "area_ha")


@query(f"""
with c as ({CELLS_SQL}) select floor(x_utm / 15e1) * 15e1 as xmin, floor(y_utm / 15e1) * 15e1 as ymin, count(*) as n_matched_pts, 2.25e0 as area_ha from c where l_returnflag = 'A' group by 1, 2""")
def support_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cells(spark, sf_dir, "l_returnflag").where("l_returnflag = 'A'").select(F.col("x_utm").alias("x"), F.col("y_utm").alias("y"))
    return area.support_cells(c, AreaConfig(mode="block")).select("xmin", "ymin", "n_matched_pts", "area_ha")


@query("""
with a as (select distinct l_suppkey, l_partkey from lineitem where l_returnflag = 'A'), p as (select * from lineitem where l_linestatus = 'O'), i as (select count(*) n_in from p where exists (select 1 from a where a.l_suppkey = p.l_suppkey and a.l_partkey = p.l_partkey))
select (select count(*) from a) as n_cells, (select count(*) from p) as n_points, n_in, round((select count(*) from a) * 9e-2, 4) as total_ha, round(n_in / (select count(*) from p)::double * 100, 6) as pct_in from i""")
def reference_area_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cells(spark, sf_dir, "l_returnflag", "l_linestatus")
    ra = area.reference_cells(c.where("l_returnflag = 'A'"), GRID)
    return area.area_summary(c.where("l_linestatus = 'O'"), ra, GRID).select("n_cells", "n_points", "n_in", r6("total_ha", digits=4), r6("pct_in"))


@query("""
with a as (select distinct l_suppkey r, l_partkey c from lineitem where l_returnflag = 'A'), b as (select min(c) c0, max(c) c1, min(r) r0, max(r) r1 from a),
o as (select 5e5 + c0 * 3e1 as x0, 7e6 - (r1 + 1) * 3e1 as y0, (c1 - c0 + 1) * 3e1 as w, (r1 - r0 + 1) * 3e1 as h from b),
l as (select x0 + i * 1e2 as x, y0 + j * 1e2 as y from o, lateral (select unnest(generate_series(0, floor(w / 1e2)::int)) as i), lateral (select unnest(generate_series(0, floor(h / 1e2)::int)) as j))
select x, y from l where exists (select 1 from a where a.c = floor((x - 5e5) / 3e1) and a.r = ceil((7e6 - y) / 3e1) - 1)""")
def monitoring_grid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cells(spark, sf_dir, "l_returnflag").where("l_returnflag = 'A'")
    return area.monitoring_lattice(area.reference_cells(c, GRID), GRID, 100.0).select("x", "y")


def _stock(spark: SparkSession, sf_dir: str, first: bool) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").where(f"year(l_shipdate) {'<' if first else '>='} 1998")
    return li.groupBy(F.col("l_suppkey").cast("int").alias("grid_row"), F.col("l_partkey").cast("int").alias("grid_col")).agg(F.avg("l_quantity").alias("value"))


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cells(spark, sf_dir, "l_orderkey", "l_linenumber", "l_returnflag").where("l_returnflag = 'A'").drop("grid_row", "grid_col")
    return carbon.cell_of(c, GRID, "x_utm", "y_utm")


_STOCKS = "s as (select l_suppkey, l_partkey, avg(l_quantity) filter (where year(l_shipdate) < 1998) a, avg(l_quantity) filter (where year(l_shipdate) >= 1998) b from lineitem group by 1, 2)"


@query(f"""
with {_STOCKS} select l_orderkey, l_linenumber, grid_row, grid_col, round(a * (47e-2 * (1 + 4e-1)), 6) as C_t0_tC_ha, round(b * (47e-2 * (1 + 4e-1)), 6) as C_y_tC_ha, round((b - a) * (47e-2 * (1 + 4e-1)) / 6e0, 6) + 0 as delta_tC_ha_yr
from ({CELLS_SQL}) c join s using (l_suppkey, l_partkey) where l_returnflag = 'A'""")
def carbon_delta_two_stock(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = carbon.change(_points(spark, sf_dir), CarbonSpec(), YEARS, start=_stock(spark, sf_dir, True), end=_stock(spark, sf_dir, False))
    return out.select("l_orderkey", "l_linenumber", "grid_row", "grid_col", *[r6(x) for x in ("C_t0_tC_ha", "C_y_tC_ha", "delta_tC_ha_yr")])


@query(f"with {_STOCKS} select l_orderkey, l_linenumber, grid_row, grid_col, round(a, 6) as delta_tC_ha_yr from ({CELLS_SQL}) c join s using (l_suppkey, l_partkey) where l_returnflag = 'A'")
def carbon_delta_direct(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = carbon.change(_points(spark, sf_dir), CarbonSpec(mode="delta"), YEARS, delta=_stock(spark, sf_dir, True))
    return out.select("l_orderkey", "l_linenumber", "grid_row", "grid_col", r6("delta_tC_ha_yr"))


@query("""
with t as (select o_custkey, o_totalprice from orders qualify row_number() over (partition by o_custkey order by o_totalprice) = 1)
select c_custkey, round(o_totalprice, 4) as deltaC_tC_ha_yr from customer left join t on c_custkey = o_custkey""")
def carbon_table_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    locked = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") / 1000).alias("ref_lon"), F.lit(1.0).alias("ref_lat"), F.lit(0.0).alias("deltaC_tC_ha_yr"))
    prepared = table(spark, sf_dir, "orders").select((F.col("o_custkey") / 1000).alias("ref_lon"), F.lit(1.0).alias("ref_lat"), F.col("o_totalprice").alias("deltaC_tC_ha_yr"))
    out = carbon.join_by_position(locked, prepared)
    return out.select("c_custkey", carbon.delta_column(out, YEARS).alias("d")).select("c_custkey", r6("d", "deltaC_tC_ha_yr", 4))


SOURCES = ("A", "N", "R")
PERIODS = tuple((1995, y) for y in range(1996, 2001))


@query("""
with s as (select l_returnflag as source, l_suppkey, l_partkey // 50 as col, year(l_shipdate) as yr, avg(l_quantity) v from lineitem group by all),
pts as (select distinct l_suppkey, l_partkey // 50 as col, case when l_suppkey % 2 = 0 then 'control' else 'project' end as side from lineitem),
r as (select a.source, a.yr as t0_year, b.yr as monitoring_year, side, a.l_suppkey, a.col, (b.v - a.v) * (47e-2 * (1 + 4e-1)) / (b.yr - a.yr) as d from s a join s b using (source, l_suppkey, col) join pts using (l_suppkey, col) where a.yr = 1995 and b.yr between 1996 and 2000),
c as (select source, t0_year, monitoring_year, count(d) n, avg(d) mean, stddev_samp(d) sd, count(distinct (l_suppkey, col)) u from r where side = 'control' group by 1, 2, 3),
b as (select source, t0_year, monitoring_year, count(*) nb, stddev_samp(m) bsd from (select source, t0_year, monitoring_year, avg(d) m from r where side = 'control' group by 1, 2, 3, floor((5e5 + (col + 5e-1) * 3e1) / 5e2), floor((7e6 - (l_suppkey + 5e-1) * 3e1) / 5e2)) group by 1, 2, 3),
p as (select source, t0_year, monitoring_year, avg(d) pm, count(distinct (l_suppkey, col)) pu from r where side = 'project' group by 1, 2, 3),
j as (select *, case when u >= 2 then u else n end ne, 1.645e0 * sd / sqrt(case when u >= 2 then u else n end) cp, case when nb >= 2 then 1.645e0 * bsd / sqrt(nb) end cb from c join b using (source, t0_year, monitoring_year) join p using (source, t0_year, monitoring_year) where n >= 2)
select source, t0_year::int as t0_year, monitoring_year::int as monitoring_year, n as n_rows, ne as n_eff, pu as project_unique, round(mean::decimal(38, 12), 6)::double as rate, round(greatest(cp, cb)::decimal(38, 12), 6)::double as ci, case when coalesce(cb > cp, false) then 'block' else 'pixel' end as ci_source, round((mean * 15713.91e0 * (monitoring_year - 1995))::decimal(38, 8), 3)::double as bl_period, round((pm * 15713.91e0 * (monitoring_year - 1995) - mean * 15713.91e0 * (monitoring_year - 1995))::decimal(38, 8), 3)::double as surplus_period from j""")
def source_period_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline rows of sources and periods; figures are rounded at 12 (totals at 8) decimals before those shown."""
    li = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_suppkey").cast("int").alias("grid_row"), F.floor(F.col("l_partkey") / 50).cast("int").alias("grid_col"), F.year("l_shipdate").alias("year"), "l_quantity")
    stock = li.groupBy(F.col("l_returnflag").alias("source"), "grid_row", "grid_col", "year").agg(F.avg("l_quantity").alias("value"))
    points = li.select("grid_row", "grid_col").distinct()
    points = points.withColumns({"side": F.when(F.col("grid_row") % 2 == 0, "control").otherwise("project"), "lon": F.col("grid_col").cast("double"), "lat": F.col("grid_row").cast("double"), "x_utm": (F.col("grid_col") + 0.5) * 30 + GRID.x0, "y_utm": F.lit(GRID.y0) - (F.col("grid_row") + 0.5) * 30})
    plan = sweep.periods(spark, SOURCES, PERIODS)
    factor = F.lit(carbon.conversion_factor("AGB_Mg_ha"))
    out = sweep.source_period_batch(carbon.with_blocks(points, 500.0), stock, plan, factor, AREA_HA, BaselineConfig())
    # a mean may be a tie at the last digit shown (0.0886655): without its last bits, which hang on the order of summation
    firm = lambda c, inner, digits: F.round(F.col(c).cast(f"decimal(38,{inner})"), digits).cast("double").alias(c)
    return out.select("source", "t0_year", "monitoring_year", "n_rows", "n_eff", "project_unique", firm("rate", 12, 6), firm("ci", 12, 6), "ci_source", firm("bl_period", 8, 3), firm("surplus_period", 8, 3))
