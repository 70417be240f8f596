"""Queries over polygons: masks to rings, shapefiles, buffers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapair.operators import polygons, raster, scenes, validity
from terrapair.plans.extract_queries import _DENSE, _SPARSE, _dense
from terrapair.plans.pipeline import shared_store
from terrapair.plans.registry import CELLS_SQL, GRID, cells, query, r6, table
from terrapair.sources import geotiff, geotiff_sink, shapefile, tables

#: Cells with their 8- and 4-connected components, and for each grid corner how many cells meet there.
_PARTS = f"""s as materialized (select grid_row, grid_col, grid_row::bigint * 4294967296 + grid_col as id from ({_SPARSE})),
e8 as materialized (select a.id as x, b.id as y from s a join s b on b.grid_row between a.grid_row - 1 and a.grid_row + 1 and b.grid_col between a.grid_col - 1 and a.grid_col + 1),
e4 as materialized (select a.id as x, b.id as y from s a join s b on abs(a.grid_row - b.grid_row) + abs(a.grid_col - b.grid_col) <= 1),
r8(x, y) as (select x, y from e8 union select r.x, e8.y from r8 r join e8 on r.y = e8.x),
r4(x, y) as (select x, y from e4 union select r.x, e4.y from r4 r join e4 on r.y = e4.x),
of as materialized (select s.*, c.y as component, p.y as part from s join (select x, min(y) y from r8 group by 1) c on c.x = id join (select x, min(y) y from r4 group by 1) p on p.x = id),
corner as (select component, grid_row + i as r, grid_col + j as c, count(*) as n, sum(case when i = j then 1 else -1 end) as d from of, (values (0), (1)) a(i), (values (0), (1)) b(j) group by 1, 2, 3)"""


@query(f"""
with recursive {_PARTS}, sides as (select component, sum(4 - n) as n from (select component, x, count(*) - 1 as n from of join e4 on e4.x = id group by 1, 2) group by 1),
corners as (select component, sum(case when n in (1, 3) then 1 when n = 2 and abs(d) = 2 then 2 else 0 end)::bigint as n from corner group by 1)
select component, count(*) * 9e-2 as area_ha, count(distinct part) as n_parts, any_value(sides.n) * 3e1 as length_m, any_value(corners.n) as n_vertices
from of join sides using (component) join corners using (component) group by 1""")
def mask_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polygons of a mask: areas, outlines and corners of its components' rings."""
    v = polygons.mask_polygons(_dense(spark, sf_dir).where("k % 3 = 0"), GRID, shared_store(spark))
    a = polygons.ring_areas(v, "component", "part")
    signed = F.when(F.col("hole"), -F.col("area_m2")).otherwise(F.col("area_m2"))
    out = a.groupBy("component").agg((F.sum(signed) / 1e4).alias("ha"), F.count_distinct("part").alias("n_parts"), F.sum("length_m").alias("m"), F.sum("n_vertices").alias("n_vertices"))
    return out.select("component", r6("ha", "area_ha"), "n_parts", r6("m", "length_m"), "n_vertices")


@query(f"""
with recursive {_PARTS}, sides as (select part, sum(4 - n) as n from (select part, x, count(*) - 1 as n from of join e4 on e4.x = id group by 1, 2) group by 1)
select part as poly_id, count(*) * 9e-2 as area_ha, any_value(sides.n) * 3e1 as length_m from of join sides using (part) group by 1""")
def shapefile_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mask's parts written as a shapefile by all tasks and read back by its record index."""
    v = polygons.mask_polygons(_dense(spark, sf_dir).where("k % 3 = 0"), GRID, shared_store(spark))
    path = f"{tables.new_folder(spark, 'layer')}/parts.shp"
    shapefile.save_edges(polygons.to_edges(v, "part"), path, GRID.crs)
    names = shapefile.load_attributes(spark, path).select(F.col("poly_id").alias("at"), F.col("values")["POLY_ID"].cast("long").alias("id"))
    back = shapefile.load_mask(spark, path, GRID.crs)
    whole = raster.polygon_area_ha(back, m=F.sum(F.sqrt(F.pow(F.col("x1") - F.col("x0"), F.lit(2)) + F.pow(F.col("y1") - F.col("y0"), F.lit(2)))))
    return whole.join(raster.apart(names), F.col("poly_id") == F.col("at")).select(F.col("id").alias("poly_id"), r6("area_ha"), r6("m", "length_m"))


def _supplier_rings(spark: SparkSession, sf_dir: str, *corners: tuple[str, str]) -> DataFrame:
    """Edges of one ring a supplier through corners given as SQL over a, b; rings lie apart."""
    s = table(spark, sf_dir, "supplier").selectExpr("s_suppkey as poly_id", "s_suppkey * 1000D as o", "10D + s_suppkey % 7 as a", "10D + s_suppkey % 5 as b")
    n = len(corners)
    edge = [F.struct(F.lit(0).alias("ring_id"), F.lit(i).alias("edge_id"), *(F.expr(f"o + ({x})" if k == "x" else y).alias(f"{k}{j}") for j, (x, y) in enumerate((corners[i], corners[(i + 1) % n])) for k in "xy")) for i in range(n)]
    return s.select("poly_id", F.explode(F.array(*edge)).alias("e")).select("poly_id", "e.*")


@query("select s_suppkey as poly_id, 2::bigint as n_rings, round((1e1 + s_suppkey % 7) * (1e1 + s_suppkey % 5) / 2, 6) as area_m2 from supplier")
def repaired_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings that cross themselves, as valid ones: a bow-tie becomes two triangles."""
    out = validity.repair(_supplier_rings(spark, sf_dir, ("0", "0D"), ("a", "b"), ("a", "0D"), ("0", "b")), shared_store(spark))
    area = F.sum((F.col("x0") - F.col("poly_id") * 1000) * F.col("y1") - (F.col("x1") - F.col("poly_id") * 1000) * F.col("y0")) / 2
    return out.groupBy("poly_id").agg(F.count_distinct("ring_id").alias("n_rings"), area.alias("area_m2")).select("poly_id", "n_rings", r6("area_m2"))


@query("select s_suppkey as poly_id, 4::bigint as n_corners, round((1e1 + s_suppkey % 7) * (1e1 + s_suppkey % 5), 6) as area_m2 from supplier")
def simplified_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rings without the corners that are within the tolerance."""
    rings = _supplier_rings(spark, sf_dir, ("0", "0D"), ("a / 2", "0.1D"), ("a", "0D"), ("a - 0.2", "b / 3"), ("a", "b"), ("a / 3", "b - 0.05"), ("0", "b"), ("0.3", "b / 2"))
    out = polygons.simplify(rings, 0.5, shared_store(spark))
    area = F.abs(F.sum((F.col("x0") - F.col("poly_id") * 1000) * F.col("y1") - (F.col("x1") - F.col("poly_id") * 1000) * F.col("y0"))) / 2
    return out.groupBy("poly_id").agg(F.count(F.lit(1)).alias("n_corners"), area.alias("area_m2")).select("poly_id", "n_corners", r6("area_m2"))


_AREA = "(grid_row < 20 and grid_col between 40 and 90) or (grid_row between 20 and 60 and grid_col between 40 and 45)"


@query(f"""
with c as materialized (select distinct grid_row, grid_col, mod(grid_col, 5) <> 0 as good from ({CELLS_SQL})), p as materialized (select * from c where {_AREA}),
d as (select c.grid_row, c.grid_col, c.good, min(sqrt(((c.grid_row - p.grid_row) * 3e1) ** 2 + ((c.grid_col - p.grid_col) * 3e1) ** 2)) as distance from c, p group by 1, 2, 3)
select grid_row, grid_col, round(distance, 6) as distance from d where good and distance > 3e2 and distance <= 12e2""")
def donor_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells in a buffer around an area with an inner corner, less those too near, in wanted regions."""
    c = cells(spark, sf_dir).select("grid_row", "grid_col").distinct()
    regions = c.withColumn("region", (F.col("grid_col") % 5 != 0).cast("string"))
    out = scenes.donor_ring(c, c.where(_AREA), GRID, regions, {"region": ["true"]}, 1.2, 0.3)
    return out.select("grid_row", "grid_col", r6("distance"))


@query(f"select 'r' as source_tile, grid_row, grid_col, v::double as v, k::double as k from ({_DENSE})")
def raster_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells exported as a tiled raster with overviews and read back by its own header."""
    path = f"{tables.new_folder(spark, 'raster')}/r.tif"
    geotiff_sink.save_raster(_dense(spark, sf_dir), path, GRID, ["v", "k"], tile=64, overviews=2)
    return geotiff.load_files(spark, path).select("source_tile", "grid_row", "grid_col", "v", "k")
