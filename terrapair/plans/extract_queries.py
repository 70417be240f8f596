"""Scan, filter, mask and sampling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapair.config import WRB_TO_TEXTURE, SceneConfig
from terrapair.operators import area, extract, raster, scenes
from terrapair.plans.registry import CELLS_SQL, GRID, cells, query, r6, table
from terrapair.sources import tables

BANDS = ("l_quantity", "l_extendedprice", "l_discount")
KEY = ("l_orderkey", "l_linenumber")
CLASS_SQL = "case p_partkey % 33 " + " ".join(f"when {k} then '{v}'" for k, v in WRB_TO_TEXTURE.items()) + " end"


@query(f"""
with c as ({CELLS_SQL})
select l_orderkey, l_linenumber, x_utm, y_utm, x_utm - 15e0 as cell_xmin, y_utm - 15e0 as cell_ymin, x_utm + 15e0 as cell_xmax, y_utm + 15e0 as cell_ymax,
       'lineitem::r' || grid_row || '::c' || grid_col as pixel_id
from c where isfinite(l_quantity) and isfinite(l_extendedprice) and isfinite(l_discount)""")
def valid_cell_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = extract.valid_cells(cells(spark, sf_dir, *KEY, *BANDS), BANDS)
    df = extract.with_geometry(df, GRID, F.lit("lineitem"))
    return df.select(*KEY, "x_utm", "y_utm", "cell_xmin", "cell_ymin", "cell_xmax", "cell_ymax", "pixel_id")


@query(f"""
with c as ({CELLS_SQL}), b as (select min(x_utm) x0, max(x_utm) x1, min(y_utm) y0, max(y_utm) y1 from c)
select l_orderkey, l_linenumber, grid_row, grid_col from c, b where x_utm between x0 + 6e1 and x1 - 6e1 and y_utm between y0 + 6e1 and y1 - 6e1""")
def bbox_edge_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.exclude_bbox_edges(cells(spark, sf_dir, *KEY), GRID, 2).select(*KEY, "grid_row", "grid_col")


@query(f"""
with c as ({CELLS_SQL}), b as (select min(x_utm) x0, max(x_utm) x1, min(y_utm) y0, max(y_utm) y1 from c where grid_col between 40 and 60 and grid_row < 20)
select l_orderkey, l_linenumber, grid_row, grid_col from c, b where x_utm between x0 - 1e3 and x1 + 1e3 and y_utm between y0 - 1e3 and y1 + 1e3""")
def donor_extent_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cells(spark, sf_dir, *KEY)
    box = extract.bbox(c.where("grid_col between 40 and 60 and grid_row < 20"))
    return (extract.clip_to_extent(c, box, 1) if box else c.limit(0)).select(*KEY, "grid_row", "grid_col")


def _mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = cells(spark, sf_dir, "l_returnflag").where("l_returnflag = 'R'")
    return flagged.select(F.col("grid_row").alias("mask_row"), F.col("grid_col").alias("mask_col")).distinct()


_MASKED = """
select l_orderkey, l_linenumber, l_partkey, l_suppkey from lineitem a where l_linestatus = 'O' and {} (select 1 from lineitem b where b.l_returnflag = 'R' and b.l_partkey = a.l_partkey and b.l_suppkey = a.l_suppkey)"""


@query(_MASKED.format("exists"))
def mask_keep_inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cells(spark, sf_dir, *KEY, "l_partkey", "l_suppkey", "l_linestatus").where("l_linestatus = 'O'")
    return extract.filter_by_mask(df, _mask(spark, sf_dir), GRID, True).select(*KEY, "l_partkey", "l_suppkey")


@query(_MASKED.format("not exists"))
def mask_remove_inside(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cells(spark, sf_dir, *KEY, "l_partkey", "l_suppkey", "l_linestatus").where("l_linestatus = 'O'")
    return extract.filter_by_mask(df, _mask(spark, sf_dir), GRID, False).select(*KEY, "l_partkey", "l_suppkey")


@query(f"select * from (select p_partkey, {CLASS_SQL} as texture_class from part) where texture_class is not null")
def class_map_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.assign_texture(table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 33).alias("WRB2_CODE"))).select("p_partkey", "texture_class")


@query("""
with q as (select quantile_cont(p_retailprice, 0.01) a, quantile_cont(p_retailprice, 0.99) b, quantile_cont(p_size::double, 0.01) c, quantile_cont(p_size::double, 0.99) d from part where p_partkey % 10 = 3 and p_size between 5 and 30)
select p_partkey, p_retailprice, p_size from part, q where p_partkey % 10 <> 3
and p_retailprice between a - greatest(2e-1 * (b - a), 1e-6) and b + greatest(2e-1 * (b - a), 1e-6) and p_size between c - greatest(2e-1 * (d - c), 1e-6) and d + greatest(2e-1 * (d - c), 1e-6)""")
def quantile_prefilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_size")
    bounds = extract.quantile_bounds(part.where("p_partkey % 10 = 3 and p_size between 5 and 30"), ["p_retailprice", "p_size"])
    return extract.prefilter(part.where("p_partkey % 10 <> 3"), bounds)


@query("""
select l_partkey::int as grid_col, l_suppkey::int as grid_row, l_orderkey, l_linenumber, l_extendedprice from (
  select *, row_number() over (partition by l_partkey, l_suppkey order by l_orderkey, l_linenumber, l_extendedprice) r from lineitem) where r = 1""")
def grid_first_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cells(spark, sf_dir, *KEY, "l_extendedprice").drop("x_utm", "y_utm")
    return extract.first_per_key(df, ["grid_row", "grid_col"], [*KEY, "l_extendedprice"])


@query(f"""
with c as ({CELLS_SQL}), r as (select *, row_number() over (partition by floor(x_utm / 15e1), floor(y_utm / 15e1) order by l_orderkey, l_linenumber, grid_row, grid_col) r from c)
select l_orderkey, l_linenumber, grid_row, grid_col from r where r = 1""")
def grid_stratified_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = cells(spark, sf_dir, *KEY)
    return extract.stratified_sample(df, 150.0, [*KEY, "grid_row", "grid_col"], None).select(*KEY, "grid_row", "grid_col")


@query("""
with t as (select count(*) n from part), q as (select p_type, greatest(1, round_even(count(*) * 700 / (select n from t), 0)) quota from part group by 1),
k as (select p.p_partkey, p.p_type from (select *, row_number() over (partition by p_type order by p_partkey) r from part) p join q on p.p_type = q.p_type where r <= quota)
select p_partkey, p_type from k order by p_partkey limit 700""")
def stratified_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.stratified_cap(table(spark, sf_dir, "part").select("p_partkey", "p_type"), 700, "p_type", ["p_partkey"], None)


@query("""
select floor(p_retailprice / 1e1)::bigint as bin_x, floor(p_size / 1e1)::bigint as bin_y, count(*) as n from part group by 1, 2""")
def hist2d_densest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.histogram_2d(table(spark, sf_dir, "part").select("p_retailprice", F.col("p_size").cast("double").alias("p_size")), "p_retailprice", "p_size", 10.0)


@query("select least(floor((l_extendedprice - 0) / 25e2), 39)::bigint as bin, count(*) as n from lineitem where l_extendedprice between 0 and 100000 group by 1")
def value_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 0.0, 100000.0, 40)


@query("""
select p as project_n, d as donor_n, p * 9e-2 as project_ha, d * 9e-2 as donor_ha, round((d * 9e-2) / (p * 9e-2), 6) as ratio_area, d * 9e-2 >= 3 * (p * 9e-2) as meets_ratio
from (select count(*) filter (where c_mktsegment = 'BUILDING') p, count(*) filter (where c_mktsegment <> 'BUILDING') d from customer)""")
def ratio_3x_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_mktsegment")
    out = extract.area_ratio(c.where("c_mktsegment = 'BUILDING'"), c.where("c_mktsegment <> 'BUILDING'"), GRID.cell_ha, GRID.cell_ha)
    return out.withColumn("ratio_area", r6("ratio_area"))


@query("""
select 'l_discount' as band, min(l_discount) + 0 as min, max(l_discount) as max, round(avg(l_discount), 6) as mean, count(l_discount) as valid from lineitem
union all select 'l_quantity', min(l_quantity), max(l_quantity), round(avg(l_quantity), 6), count(l_quantity) from lineitem""")
def band_inspection(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = extract.band_summary(table(spark, sf_dir, "lineitem"), ["l_discount", "l_quantity"])
    return out.select("band", (F.col("min") + 0.0).alias("min"), "max", r6("mean"), "valid")


@query("""
with y as (select o_custkey, count(distinct year(o_orderdate)) as valid_years from orders where year(o_orderdate) between 1995 and 2000 group by 1)
select valid_years, count(*) as n from y group by 1""")
def valid_year_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", F.year("o_orderdate").alias("season"), "o_totalprice")
    wide = scenes.wide_years(o.groupBy("o_custkey", "season").agg(F.sum("o_totalprice").alias("v")), ["o_custkey"], range(1995, 2001), "v")
    years = wide.withColumn("valid_years", scenes.valid_years([f"NDVI_{y}" for y in range(1995, 2001)]).cast("long")).where("valid_years > 0")
    return extract.valid_year_histogram(years, "valid_years").withColumnRenamed("count", "n")


@query("select event_id, user_id from events where (event_id % 64)::bigint & 25 = 0 and event_id % 7 = 0")
def qa_bit_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id")
    return e.where(scenes.clear(F.col("event_id") % 64, F.col("event_id") % 7))


@query("""
select event_id, round(case when abs(n + r) > 1e-6 then (n - r) / (n + r) end, 6) + 0 as ndvi
from (select event_id, (value * 100) * 2.75e-5 - 2e-1 as n, (event_id % 20000) * 2.75e-5 - 2e-1 as r from events)""")
def scene_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    nir, red = scenes.reflectance(F.col("value") * 100), scenes.reflectance(F.col("event_id") % 20000)
    return e.select("event_id", r6(scenes.index(nir, red), "ndvi"))


@query("""
select o_custkey, year(o_orderdate - interval 3 month)::int as season, round(median(o_totalprice), 6) as median, count(o_totalprice) as n from (select o_custkey, o_totalprice, date_trunc('day', o_orderdate) as o_orderdate from orders) group by 1, 2""")
def annual_median_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    out = scenes.annual_composite(o, ["o_custkey"], "o_orderdate", "o_totalprice", SceneConfig())
    return out.withColumn("median", r6("median"))


@query("""
with c as (select o_custkey, year(o_orderdate - interval 3 month) as season, median(o_totalprice) as m from (select o_custkey, o_totalprice, date_trunc('day', o_orderdate) as o_orderdate from orders) group by 1, 2)
select o_custkey, round(regr_slope(m, season - 1998e0), 6) as slope, regr_count(m, season)::bigint as valid_years from c group by 1""")
def composite_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    out = scenes.trend(scenes.annual_composite(o, ["o_custkey"], "o_orderdate", "o_totalprice"), ["o_custkey"])
    return out.select("o_custkey", r6("slope"), F.col("valid_years").cast("long").alias("valid_years"))


@query("select year(o_orderdate)::int as year, count(*) as n_scenes from orders group by 1")
def scene_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.yearly_counts(table(spark, sf_dir, "orders"), "o_orderdate")


@query("select p_partkey from part where isfinite(p_retailprice) and p_size >= 4 and p_partkey % 33 > 0 and p_partkey % 33 <> 31")
def valid_covariate_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", F.col("p_size").alias("ndvi_valid_years"), (F.col("p_partkey") % 33).alias("WRB2_CODE"))
    return scenes.valid_covariates(p, ["p_retailprice"]).select("p_partkey")


@query("select round(coalesce(sum(case when coalesce(nullif(l_quantity, 7), 0) < 40 then 9e-2 end), 0), 4) as area_ha from lineitem")
def mask_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.nullif("l_quantity", F.lit(7.0)).alias("occurrence"), F.lit(GRID.cell_ha).alias("pixel_area_ha"))
    return scenes.mask_area(li, scenes.not_water(F.col("occurrence"), 40.0)).select(r6("area_ha", digits=4))


@query("select event_type, count(*) as n from events group by 1")
def type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.type_histogram(table(spark, sf_dir, "events"), "event_type")


#: A concave ring and a square with a hole, in the grid's metres, counted from its corner.
RINGS = {
    1: [[(615.0, -450.0), (30150.0, -330.0), (24000.0, -1200.0), (33000.0, -2700.0), (900.0, -2400.0), (9000.0, -1500.0)]],
    2: [[(36007.0, -307.0), (50007.0, -307.0), (50007.0, -2407.0), (36007.0, -2407.0)], [(40007.0, -907.0), (40007.0, -1807.0), (45007.0, -1807.0), (45007.0, -907.0)]],
}


def _edges() -> list[tuple]:
    out = []
    for pid, rings in RINGS.items():
        for k, ring in enumerate(rings):
            for i, (a, b) in enumerate(zip(ring, [*ring[1:], ring[0]])):
                out.append((pid, k, i, GRID.x0 + a[0], GRID.y0 + a[1], GRID.x0 + b[0], GRID.y0 + b[1]))
    return out


_EDGES_SQL = "(values " + ", ".join("({}, {!r}::double, {!r}::double, {!r}::double, {!r}::double)".format(e[0], *e[3:]) for e in _edges()) + ") e(poly_id, x0, y0, x1, y1)"


def _edge_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(_edges(), "poly_id long, ring_id int, edge_id int, x0 double, y0 double, x1 double, y1 double")


@query(f"""
with c as (select distinct grid_row, grid_col, x_utm, y_utm from ({CELLS_SQL})),
k as (select grid_row, grid_col, poly_id from c, {_EDGES_SQL} where (y_utm >= least(y0, y1)) and (y_utm < greatest(y0, y1)) and x0 + (y_utm - y0) / (y1 - y0) * (x1 - x0) <= x_utm group by all having count(*) % 2 = 1)
select distinct grid_row, grid_col from k""")
def polygon_rasterize(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = raster.rasterize(_edge_table(spark), GRID)
    found = cells(spark, sf_dir).select("grid_row", "grid_col").distinct()
    return found.join(mask.withColumnsRenamed({"mask_row": "grid_row", "mask_col": "grid_col"}), ["grid_row", "grid_col"], "left_semi")


@query(f"select poly_id::bigint as poly_id, round(abs(sum(x0 * y1 - x1 * y0)) / 2 / 1e4, 3) as area_ha from {_EDGES_SQL} group by 1")
def polygon_area(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.polygon_area_ha(_edge_table(spark)).select("poly_id", r6("area_ha", digits=3))


@query("""
with s as (select s_suppkey, (s_nationkey * 40)::double as x_utm, floor(s_acctbal / 2e1) as y_utm from supplier), t as (select (c_nationkey * 40 + 3)::double as tx, floor(c_acctbal / 2e1) as ty from customer where c_mktsegment = 'BUILDING')
select s_suppkey, round(coalesce(min(d) filter (where d <= 30), 5e4), 6) as distance from (select s_suppkey, sqrt(power(x_utm - tx, 2) + power(y_utm - ty, 2)) as d from s, t) group by 1""")
def nearest_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_nationkey") * 40).cast("double").alias("x_utm"), F.floor(F.col("s_acctbal") / 20).cast("double").alias("y_utm"))
    t = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select((F.col("c_nationkey") * 40 + 3).cast("double").alias("x_utm"), F.floor(F.col("c_acctbal") / 20).cast("double").alias("y_utm"))
    return raster.nearest_distance(s, t, 30.0, 50000.0).select("s_suppkey", r6("distance"))


_DENSE = "select (l_suppkey // 4)::int as grid_row, (l_partkey // 40)::int as grid_col, sum(l_quantity) as v, sum(l_linenumber) as k from lineitem group by 1, 2"


def _dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.floor(F.col("l_suppkey") / 4).cast("int").alias("grid_row"), F.floor(F.col("l_partkey") / 40).cast("int").alias("grid_col")).agg(F.sum("l_quantity").alias("v"), F.sum("l_linenumber").alias("k"))


@query(f"""
with d as ({_DENSE}), n as (select a.grid_row, a.grid_col, b.grid_row - a.grid_row dr, b.grid_col - a.grid_col dc, b.v from d a join d b on b.grid_row between a.grid_row - 1 and a.grid_row + 1 and b.grid_col between a.grid_col - 1 and a.grid_col + 1),
g as (select grid_row, grid_col, sum(v * dc * (2 - abs(dr))) gx, sum(v * -dr * (2 - abs(dc))) gy, count(*) n from n where not (dr = 0 and dc = 0) group by 1, 2)
select d.grid_row, d.grid_col, round(degrees(atan(sqrt(power(gx / 24e1, 2) + power(gy / 24e1, 2)))), 6) as slope_deg from d left join g on d.grid_row = g.grid_row and d.grid_col = g.grid_col and n = 8""")
def terrain_slope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.terrain_slope(_dense(spark, sf_dir), GRID, "v").select("grid_row", "grid_col", r6("slope_deg"))


_SPARSE = f"select grid_row, grid_col from ({_DENSE}) where k % 3 = 0"


@query(f"""
with s as ({_SPARSE}), o as (select unnest([-1, 0, 1]) as k), d as (select distinct grid_row + a.k as grid_row, grid_col + b.k as grid_col from s, o a, o b)
select x.grid_row, x.grid_col from d x, o a, o b where exists (select 1 from d y where y.grid_row = x.grid_row + a.k and y.grid_col = x.grid_col + b.k) group by 1, 2 having count(*) = 9""")
def morphological_closing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.close(_dense(spark, sf_dir).where("k % 3 = 0"), 1)


@query(f"""
with recursive s as materialized (select grid_row, grid_col, grid_row::bigint * 4294967296 + grid_col as id from ({_SPARSE})),
e as materialized (select a.id as x, b.id as y from s a join s b on b.grid_row between a.grid_row - 1 and a.grid_row + 1 and b.grid_col between a.grid_col - 1 and a.grid_col + 1),
r(x, y) as (select x, y from e union select r.x, e.y from r join e on r.y = e.x)
select grid_row, grid_col, component from s join (select x, min(y) as component from r group by 1) on x = id""")
def cell_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    from terrapair.plans.pipeline import shared_store

    return raster.components(_dense(spark, sf_dir).where("k % 3 = 0"), shared_store(spark))


@query("select doc_id, sha256(text) as sha256, length(text) as length from documents")
def sha256_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("sha256"), F.length("text").cast("long").alias("length"))


@query(None)
def file_checksums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.checksums(spark, sf_dir, "region.parquet").select("length", "sha256")


@query("""
select c_custkey, 'POLYGON ((' || x || '.0 ' || y || '.0, ' || (x + 30) || '.0 ' || y || '.0, ' || (x + 30) || '.0 ' || (y + 30) || '.0, ' || x || '.0 ' || (y + 30) || '.0, ' || x || '.0 ' || y || '.0))' as wkt
from (select c_custkey, c_custkey % 1000 * 30 as x, c_nationkey * 30 as y from customer)""")
def cell_wkt(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    x, y = (F.col("c_custkey") % 1000 * 30).cast("double"), (F.col("c_nationkey") * 30).cast("double")
    return c.select("c_custkey", x.alias("xmin"), y.alias("ymin"), (x + 30).alias("xmax"), (y + 30).alias("ymax")).select("c_custkey", area.box_wkt().alias("wkt"))
