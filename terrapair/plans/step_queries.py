"""Queries of the steps' smaller parts: positions, pair tables, calipers with tenure and fallback, scenes, batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrapair.config import AreaConfig, ExtractConfig, MatchConfig, SceneConfig, SweepConfig
from terrapair.functions import projection
from terrapair.functions.columns import number
from terrapair.operators import area, balance, baseline, carbon, extract, matching, scenes, sweep, trend
from terrapair.plans import match_queries as m
from terrapair.plans.registry import CELLS_SQL, GRID, cells, query, r6, table
from terrapair.sources import tables

# positions and projections

_CUSTOMERS = "select c_custkey, 18e0 + c_nationkey * 1e-1 + (c_custkey % 97) * 1e-3 as lon, -34e0 + (c_custkey % 101) * 1e-2 as lat from customer"


def _positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    lon, lat = F.lit(18.0) + F.col("c_nationkey") * F.lit(0.1) + F.col("c_custkey") % 97 * F.lit(0.001), F.lit(-34.0) + F.col("c_custkey") % 101 * F.lit(0.01)
    return c.select("c_custkey", lon.alias("lon"), lat.alias("lat"))


@query(f"with c as ({_CUSTOMERS}) select 'EPSG:' || (case when avg(lat) >= 0 then 32600 else 32700 end + floor((avg(lon) + 180) / 6)::int + 1) as epsg from c")
def utm_zone_of_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.createDataFrame([(area.auto_utm(_positions(spark, sf_dir)),)], "epsg string")


_N, _R = projection.N, projection.K0 * projection.RADIUS
_SERIES = {f: " + ".join([base, *(f"{a!r} * {one}({2 * j} * xi) * {two}({2 * j} * eta)" for j, a in enumerate(projection.ALPHA, 1))]) for f, base, one, two in (("x", "eta", "cos", "sinh"), ("y", "xi", "sin", "cosh"))}


@query(f"""
with c as ({_CUSTOMERS}), d as (select distinct round(lon, 9) as lon, round(lat, 9) as lat from c), a as (select lon, lat, sin(radians(lat)) as s, radians(lon) - radians(21e0) as lam from d),
b as (select *, sinh(atanh(s) - {projection.E1!r} * atanh({projection.E1!r} * s)) as t from a), e as (select *, atan2(t, cos(lam)) as xi, atanh(sin(lam) / sqrt(t * t + 1)) as eta from b)
select round(({_SERIES["x"]}) * {_R!r} + 5e5, 4) as x, round(({_SERIES["y"]}) * {_R!r} + 1e7, 4) as y from e""")
def reference_points_utm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct finite positions in the zone of their mean."""
    pairs = _positions(spark, sf_dir).select(F.round("lon", 9).alias("ref_lon"), F.round("lat", 9).alias("ref_lat"))
    broken = pairs.limit(1).select(F.lit(float("nan")).alias("ref_lon"), "ref_lat")  # goes
    out, _ = area.with_utm(area.reference_points(pairs.union(broken)), "EPSG:32734")
    return out.select(r6("x", digits=4), r6("y", digits=4))


@query(f"with c as ({_CUSTOMERS}) select c_custkey, round(lon, 7) as lon, round(lat, 7) as lat from c")
def utm_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """To UTM and back gives the positions."""
    x, y = projection.to_utm(F.col("lon"), F.col("lat"), "EPSG:32734")
    lon, lat = projection.from_utm(F.col("x"), F.col("y"), "EPSG:32734")
    return _positions(spark, sf_dir).withColumns({"x": x, "y": y}).select("c_custkey", r6(lon, "lon", 7), r6(lat, "lat", 7))


@query(f"with c as ({_CUSTOMERS}) select c_custkey, round(radians(lon) * 6378137e0, 4) as x, round(ln(tan(radians(lat) / 2 + pi() / 4)) * 6378137e0, 4) as y from c")
def web_mercator(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = projection.to_web_mercator(F.col("lon"), F.col("lat"))
    return _positions(spark, sf_dir).select("c_custkey", r6(x, "x", 4), r6(y, "y", 4))


@query(f"with c as ({CELLS_SQL}), s as (select floor(x_utm / 15e1) * 15e1 as xmin, floor(y_utm / 15e1) * 15e1 as ymin from c where l_returnflag = 'A' group by 1, 2) select xmin, ymin, row_number() over (order by xmin, ymin)::int as support_id from s")
def support_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = cells(spark, sf_dir, "l_returnflag").where("l_returnflag = 'A'").select(F.col("x_utm").alias("x"), F.col("y_utm").alias("y"))
    return area.numbered(area.support_cells(c, AreaConfig(mode="block")).select("xmin", "ymin"), "support_id", "xmin", "ymin")


@query(f"with c as ({CELLS_SQL}) select distinct x_utm - 15e0 as xmin, y_utm + 15e0 as ymax, 'centroid' as support_mode, 9e-2 as area_ha from c where l_returnflag = 'A'")
def support_cells_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supports of points without bounds of their own."""
    c = cells(spark, sf_dir, "l_returnflag").where("l_returnflag = 'A'").select(F.col("x_utm").alias("x"), F.col("y_utm").alias("y")).distinct()
    return area.support_cells(c).select("xmin", "ymax", "support_mode", "area_ha")


# sources and sinks

_TILES = "a as (select l_orderkey, l_linenumber, l_suppkey::int as grid_row, l_partkey::int as grid_col, l_quantity as v, case when l_returnflag = 'A' then 1 else 2 end as tile from lineitem where l_returnflag in ('A', 'N'))"


@query(f"""
with {_TILES}, f as (select grid_row, grid_col, tile, v, l_orderkey, row_number() over (partition by tile, grid_row, grid_col order by l_orderkey, l_linenumber) r from a),
t as (select grid_row, grid_col, tile, v, case when tile = 2 then l_orderkey end as extra from f where r = 1)
select grid_row, grid_col, 'tile_' || tile as source_tile, v, extra from t qualify row_number() over (partition by grid_row, grid_col order by tile) = 1""")
def tile_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two overlapping tiles with different bands: written, found again, loaded as one table."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").cast("int").alias("grid_row"), F.col("l_partkey").cast("int").alias("grid_col"), F.col("l_quantity").alias("v"), "l_returnflag")
    folder = tables.new_folder(spark, "tiles")
    for k, flag in ((1, "A"), (2, "N")):
        one = extract.first_per_key(li.where(F.col("l_returnflag") == flag), ["grid_row", "grid_col"], ["l_orderkey", "l_linenumber"])
        one = one.select("grid_row", "grid_col", "v", *([F.col("l_orderkey").alias("extra")] if k == 2 else []), F.lit(f"tile_{k}").alias("source_tile"))
        tables.save(one, f"{folder}/deep{k}/tile_{k}")
    found = sorted({p.rsplit("/", 1)[0] for p in tables.find_tiles(spark, [folder], "*.parquet")})
    return tables.load_tiles(spark, found, ("grid_row", "grid_col")).select("grid_row", "grid_col", "source_tile", "v", "extra")


@query("select c_custkey, case when c_custkey % 7 = 0 then null else c_acctbal end as v from customer")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and infinities written to CSV come back as nulls; the table is found by its stem."""
    v = F.when(F.col("c_custkey") % 14 == 0, F.lit(float("nan"))).when(F.col("c_custkey") % 7 == 0, F.lit(float("inf"))).otherwise(F.col("c_acctbal"))
    folder = tables.new_folder(spark, "csv")
    tables.save(table(spark, sf_dir, "customer").select("c_custkey", v.alias("v")), f"{folder}/pixels", "csv")
    return tables.load(spark, tables.find(spark, folder, "pixels"), "c_custkey long, v double")


@query("select count(*) as n, round(avg(c_acctbal), 6) as mean from customer")
def json_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report through JSON."""
    r = table(spark, sf_dir, "customer").agg(F.count(F.lit(1)).alias("n"), F.avg("c_acctbal").alias("mean")).first()
    path = f"{tables.new_folder(spark, 'report')}/report.json"
    tables.write_json(spark, path, {"n": r["n"], "mean": r["mean"]})
    back = tables.read_json(spark, path)
    return spark.createDataFrame([(back["n"], back["mean"])], "n long, mean double").select("n", r6("mean"))


@query("select o_orderkey, try_cast(case when o_orderkey % 5 = 0 then null when o_orderkey % 7 = 0 then 'x' else o_totalprice::varchar end as double) as v from orders where o_orderkey % 5 <> 0 and o_orderkey % 7 <> 0")
def finite_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts and infinities of a target column are missing; rows without it go."""
    o = table(spark, sf_dir, "orders").withColumn("t", F.when(F.col("o_orderkey") % 5 == 0, F.lit("Infinity")).when(F.col("o_orderkey") % 7 == 0, F.lit("x")).otherwise(F.col("o_totalprice").cast("string")))
    return o.select("o_orderkey", number("t").alias("v")).na.drop(subset=["v"])


# masks and scenes


@query("""
with r as (select distinct l_partkey, l_suppkey from lineitem where l_returnflag = 'R'), e as (select distinct l_partkey, l_suppkey from lineitem where l_quantity > 10)
select l_orderkey, l_linenumber from lineitem a where exists (select 1 from e where e.l_partkey = a.l_partkey and e.l_suppkey = a.l_suppkey) and not exists (select 1 from r where r.l_partkey = a.l_partkey and r.l_suppkey = a.l_suppkey)""")
def donor_mask_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Donors inside the eligible area and outside the forest."""
    c = cells(spark, sf_dir, "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    mask = lambda where: c.where(where).select(F.col("grid_row").alias("mask_row"), F.col("grid_col").alias("mask_col")).distinct()
    return extract.apply_masks(c, "donor", GRID, mask("l_returnflag = 'R'"), mask("l_quantity > 10"), ExtractConfig()).select("l_orderkey", "l_linenumber")


@query("select event_id, user_id from events where ts >= timestamp '2024-01-05' and ts < timestamp '2024-01-20' and value <= 10 and user_id between 20 and 90")
def scene_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes by date, bounds and cloud cover."""
    e = table(spark, sf_dir, "events").withColumns({"cloud_cover": F.col("value"), "x": F.col("user_id").cast("double"), "y": F.lit(0.0)})
    return scenes.collection(e, "ts", "2024-01-05", "2024-01-20", (20.0, -1.0, 90.0, 1.0), ("x", "y"), SceneConfig(max_cloud=10.0)).select("event_id", "user_id")


@query("select event_id, case when user_id % 2 = 0 then 'L8' else 'L9' end as sensor, case when user_id % 2 = 1 then value end as extra from events")
def sensor_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    eight = e.where("user_id % 2 = 0").select("event_id", F.lit("L8").alias("sensor"))
    nine = e.where("user_id % 2 = 1").select("event_id", F.lit("L9").alias("sensor"), F.col("value").alias("extra"))
    return scenes.merge_sensors(eight, nine)


@query("select p_partkey, coalesce(case when p_size > 5 then p_size * 2 end, 0) < 60 as dry from part")
def permanent_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells without an observation of water are dry."""
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", scenes.not_water(F.when(F.col("p_size") > 5, F.col("p_size") * 2)).alias("dry"))


@query(f"""
with c as (select distinct grid_row, grid_col, x_utm, y_utm from ({CELLS_SQL}) x), p as (select * from c where grid_col between 40 and 60 and grid_row < 20), b as (select min(x_utm) x0, max(x_utm) x1, min(y_utm) y0, max(y_utm) y1 from p),
g as (select l_suppkey::int as grid_row, l_partkey::int as grid_col from lineitem where l_returnflag in ('A', 'N') and l_linestatus = 'O' group by 1, 2),
d as (select c.*, greatest(x0 - x_utm, x_utm - x1, y0 - y_utm, y_utm - y1, 0) / 1e3 as km from c, b)
select grid_row, grid_col, (km > 1)::int::double as is_donor, 9e-2 as pixel_area_ha from d where km <= 2 and km > 2e-1 and exists (select 1 from g where g.grid_row = d.grid_row and g.grid_col = d.grid_col)""")
def donor_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of the wanted regions within a buffer around the project, without a ring next to it."""
    c = cells(spark, sf_dir).distinct()
    project = c.where("grid_col between 40 and 60 and grid_row < 20")
    box = extract.bbox(project) or (0.0, 0.0, 0.0, 0.0)
    regions = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("int").alias("grid_row"), F.col("l_partkey").cast("int").alias("grid_col"), "l_returnflag", "l_linestatus")
    out = scenes.donor_domain(c, project, regions, {"l_returnflag": ("A", "N"), "l_linestatus": ("O",)}, box, 2.0, 0.2)
    out = scenes.flag_sides(out, F.lit(False), sweep.extent_of(F.col("x_utm"), F.col("y_utm"), box) > 1, GRID.cell_ha)
    return out.select("grid_row", "grid_col", "is_donor", "pixel_area_ha")


# matching


@query("""
with t as (select avg(p_retailprice) s, avg(p_size / 5e1) n from part where p_partkey % 10 = 3)
select * from (select 'SOC_g_kg' as "column", round(greatest(abs(s) * 1e-1, 1e-9), 6) as tolerance from t union all select 'NDVI_t0', round(greatest(abs(n) * 1e-1, 1e-9), 6) from t
union all select * from (values ('elevation', 200e0), ('slope_deg', 10e0), ('dist_roads_km', 1e0)))""")
def caliper_tolerances(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").where("p_partkey % 10 = 3")
    zero = F.lit(0.0)
    p = p.select(F.col("p_retailprice").alias("SOC_g_kg"), (F.col("p_size") / 50).alias("NDVI_t0"), zero.alias("elevation"), zero.alias("slope_deg"), zero.alias("dist_roads_km"))
    return spark.createDataFrame([(c.column, float(c.tolerance)) for c in matching.calipers(p)], "column string, tolerance double").select("column", r6("tolerance"))


_TENURE = m._CAND.replace("abs(d.elev - p.elev) <= 20 as ok_elev", "abs(d.elev - p.elev) <= 20 and p.p_partkey % 3 = d.p_partkey % 3 as ok_elev")


@query(f"with {m._SIDES}, {_TENURE} select proj_idx, donor_idx, match_rank::int as match_rank, rejected from matched")
def tenure_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenure on both sides is an exact caliper."""
    project, donors = m.sides(spark, sf_dir)
    project, donors = project.withColumn("tenure_status", F.col("proj_idx") % 3), donors.withColumn("tenure_status", F.col("donor_idx") % 3)
    metric = matching.fit_metric(project, donors, m.COVS, whitening="standard")
    out = matching.match(project, donors, m.COVS, m.limits(project), "cls", MatchConfig(), metric).pairs
    return out.select(F.col("p_proj_idx").alias("proj_idx"), F.col("d_donor_idx").alias("donor_idx"), "match_rank", "rejected")


_FALL = m._CAND.replace("quota as (select cls, count(*) donor_n, greatest(1, least(150, floor(0.95 * count(*)), count(*))) q from don group by 1)", """
have as (select cls, count(*) n from don group by 1), allow as (select cls, cls as dcls, n from have union all select 'sand', cls, n from have where not exists (select 1 from have where cls = 'sand')),
quota as (select cls, sum(n)::bigint donor_n, greatest(1, least(150, floor(0.95 * sum(n)), sum(n)))::bigint q from allow group by 1)""").replace("and d.cls = p.cls, tol", "join allow on allow.cls = p.cls and allow.dcls = d.cls, tol").replace("abs(d.elev - p.elev) <= 20 as ok_elev", "abs(d.elev - p.elev) <= 20 and d.cls = p.cls as ok_elev")


@query(f"""
with {m._SIDES}, {_FALL}
select p.p_partkey as proj_idx, case when w.best is not null then 'matched' when q.cls is null then 'no_texture_donor' when w.proj_idx is null then 'no_texture_compatible_in_knn' else 'no_candidate_passed_hard_calipers' end as result, case when w.proj_idx is not null and w.best is null then q.q::int end as queried_n, w.rejected
from proj p left join quota q on p.cls = q.cls left join won w on p.p_partkey = w.proj_idx""")
def fallback_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A class without donors takes candidates of its fallbacks, which the class caliper then rejects."""
    project, donors = m.sides(spark, sf_dir)
    metric = matching.fit_metric(project, donors, m.COVS, whitening="standard")
    out = matching.match(project, donors, m.COVS, m.limits(project), "cls", MatchConfig(fallback=True), metric)
    pairs = out.pairs.select(F.col("p_proj_idx").alias("proj_idx"), F.lit("matched").alias("result"), F.lit(None).cast("int").alias("queried_n"))
    rejected = out.candidates.select(F.col("p_proj_idx").alias("proj_idx"), "rejected").distinct()
    return pairs.union(out.unmatched.select("proj_idx", "reason", "queried_n")).join(rejected, "proj_idx", "left")


_C = [[f"(1 - sh) * c{min(i, j)}{max(i, j)}" + (" + sh * mu + 1e-6" if i == j else "") for j in range(3)] for i in range(3)]
_ADJ = [[f"(a{(j + 1) % 3}{(i + 1) % 3} * a{(j + 2) % 3}{(i + 2) % 3} - a{(j + 1) % 3}{(i + 2) % 3} * a{(j + 2) % 3}{(i + 1) % 3})" for j in range(3)] for i in range(3)]
_METRIC = f"""stats as (select {m._STATS} from pool), z as (select {m._Z} from pool, stats),
s as (select count(*) n, sum(power(z0 * z0 + z1 * z1 + z2 * z2, 2)) f, {", ".join(f"avg(z{i} * z{j}) c{i}{j}" for i in range(3) for j in range(i, 3))} from z),
t as (select *, (c00 + c11 + c22) / 3 mu, c00 * c00 + c11 * c11 + c22 * c22 + 2 * (c01 * c01 + c02 * c02 + c12 * c12) s2 from s),
u as (select *, (s2 - 3 * mu * mu) / 3 delta, (f / n - s2) / (n * 3) b0 from t), h as (select *, case when least(b0, delta) <= 0 then 0 else least(b0, delta) / delta end sh from u),
k as (select {", ".join(f"{_C[i][j]} a{i}{j}" for i in range(3) for j in range(3))} from h), det as (select *, a00 * {_ADJ[0][0]} + a01 * {_ADJ[1][0]} + a02 * {_ADJ[2][0]} d from k),
w as (select {", ".join(f"{_ADJ[i][j]} / d + {'1e-6' if i == j else '0'} m{i}{j}" for i in range(3) for j in range(3))} from det)"""


@query(f"""
with {m._SIDES}, {_METRIC}, dz as (select p.p_partkey as proj_idx, d.p_partkey as donor_idx, {", ".join(f"(p.{c} - d.{c}) / s_{c} as e{i}" for i, c in enumerate(m.COVS))} from proj p, don d, stats),
dist as (select proj_idx, donor_idx, round(sqrt({" + ".join(f"e{i} * e{j} * m{i}{j}" for i in range(3) for j in range(3))}), 9) as distance from dz, w)
select proj_idx, donor_idx, row_number() over (partition by proj_idx order by distance, donor_idx)::int as rank, round(distance, 6) as distance from dist qualify row_number() over (partition by proj_idx order by distance, donor_idx) <= 4""")
def mahalanobis_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearest donors by the whitener of the shrunk covariance: ridge, inverse, Cholesky factor."""
    project, donors = m.sides(spark, sf_dir)
    return matching.knn(project, donors, matching.fit_metric(project, donors, m.COVS), 4).select("proj_idx", "donor_idx", "rank", r6("distance"))


@query(f"""
with {m._SIDES}, {m._CAND}
select t.proj_idx, t.donor_idx, p.cls as proj_texture, true as texture_exact, round(p.elev::double, 6) as proj_elevation, round(d.elev::double, 6) as ref_elevation, round((d.elev - p.elev)::double, 6) as diff_elevation, d.p_retailprice as ref_lon, 't::r' || (d.p_partkey // 100) || '::c' || (d.p_partkey % 100) as ref_pixel_id
from matched t join proj p on p.p_partkey = t.proj_idx join don d on d.p_partkey = t.donor_idx""")
def matched_pair_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Donor rows with the columns of both sides, their differences, bounds and ids."""
    out = m.run(spark, sf_dir)
    project, donors = m.sides(spark, sf_dir)
    more = {"elevation": F.col("elev").cast("double"), "lon": F.col("p_retailprice"), "lat": F.lit(0.0), "texture_class": F.col("cls")}
    ids = {"grid_row": F.floor(F.col("donor_idx") / 100).cast("int"), "grid_col": (F.col("donor_idx") % 100).cast("int")}
    donors = extract.with_geometry(donors.withColumns(more).withColumns(ids), GRID, F.lit("t"))
    t = matching.pair_table(out.pairs, project.withColumns(more), donors, shown=("elevation",))
    return t.select("proj_idx", "donor_idx", "proj_texture", "texture_exact", r6("proj_elevation"), r6("ref_elevation"), r6("diff_elevation"), "ref_lon", "ref_pixel_id")


@query(f"""
with {m._SIDES}, {m._CAND}, x as (select 'p_size' as covariate, avg(p.p_size) mp, var_pop(p.p_size) vp from proj p), y as (select avg(d.p_size) mr, var_pop(d.p_size) vr from matched t join don d on d.p_partkey = t.donor_idx)
select covariate, round(abs(mp - mr) / sqrt((vp + vr) / 2), 4) as smd, round(mp, 6) as proj_mean, round(mr, 6) as ref_mean from x, y""")
def smd_of_matched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balance over the matched rows: a donor counts as often as it was used."""
    pairs = m.run(spark, sf_dir).pairs.select(F.col("d_p_size").alias("p_size"))
    return balance.smd(m.sides(spark, sf_dir)[0], pairs, ["p_size"]).select("covariate", "smd", r6("proj_mean"), r6("ref_mean"))


@query("""
with o as (select o_custkey, o_totalprice from orders where o_orderkey % 3 = 0), p as (select round(o_custkey / 1e3, 7) k, min(o_totalprice) v from o group by 1)
select c_custkey as pair_id, round(c_acctbal, 4) as ref_NDVI_2013, round(v, 4) as proj_NDVI_2013 from customer left join p on k = round(c_custkey / 1e3 + 1e-9, 7)""")
def series_by_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The project's series joined to pairs by positions rounded to seven decimals."""
    pairs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pair_id"), (F.col("c_custkey") / 1000 + 1e-9).alias("proj_lon"), F.lit(1.0).alias("proj_lat"), F.col("c_acctbal").alias("NDVI_2013"))
    o = table(spark, sf_dir, "orders").where("o_orderkey % 3 = 0").groupBy((F.col("o_custkey") / 1000).alias("lon")).agg(F.min("o_totalprice").alias("NDVI_2013"))
    out = trend.attach_by_position(pairs, o.withColumn("lat", F.lit(1.0)), [2013])
    return out.select("pair_id", r6("ref_NDVI_2013", digits=4), r6("proj_NDVI_2013", digits=4))


# carbon and baselines


@query("""
select o_orderkey, 'carbon' as kind, round((o_totalprice - o_custkey) / 5e0, 6) + 0 as delta from orders union all
select o_orderkey, 'biomass', round((o_totalprice - o_custkey) * 47e-2 / 5e0, 6) + 0 from orders""")
def carbon_pair_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change from a prepared table's pair of carbon stocks, or of biomass."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").cast("double").alias("a"), F.col("o_totalprice").alias("b"))
    out = []
    for kind, names in (("carbon", ("C_ref_t0_tC_ha", "C_ref_y_tC_ha")), ("biomass", ("AGB_ref_t0_Mg_ha", "AGB_ref_y_Mg_ha"))):
        t = o.withColumnsRenamed(dict(zip("ab", names)))
        out.append(t.select("o_orderkey", F.lit(kind).alias("kind"), r6(carbon.delta_column(t, 5.0), "delta")))
    return out[0].union(out[1])


@query("select 'pixels' as source, round(sum(p_size * 1e-2), 6) as ha from part union all select 'rows', round(count(*) * 9e-2, 6) from part union all select 'given', 7e0")
def project_area_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given area, else the pixels' areas, else rows times the pixel's."""
    p = table(spark, sf_dir, "part").select((F.col("p_size") * 0.01).alias("pixel_area_ha"))
    rows = [("pixels", baseline.project_area(p, None, GRID.cell_ha, True)), ("rows", baseline.project_area(p.select(F.lit(1).alias("x")), None, GRID.cell_ha, True)), ("given", baseline.project_area(p, 7.0, GRID.cell_ha))]
    return spark.createDataFrame(rows, "source string, ha double").select("source", r6("ha"))


# sweeps

_KM = "(values ('full', 1e300), ('5', 5e0), ('10', 10e0), ('20', 20e0), ('30', 30e0)) e(extent, km)"
# The selection of parallel pairs. All pairs come first (none of their slopes differs by more than the threshold), then their shares by
# slope difference, the longest first; without one that passes, the smallest mean difference. A p-value is the tail of Student's t for
# whole degrees of freedom, a finite sum: with c = cos(atan(t / sqrt(df))) and s its sine, 1 - s (1 + 1/2 c^2 + 1*3/(2*4) c^4 + ...) for even
# ones, 1 - 2/pi (atan(t / sqrt(df)) + s (c + 2/3 c^3 + 2*4/(3*5) c^5 + ...)) for odd ones.
_VERDICT = """ranked as (select *, row_number() over (partition by extent order by round(abs(sd), 12), proj_idx) r, count(*) over (partition by extent) n from best),
sizes as (select extent, any_value(n) n, 0 as step, any_value(n) k from ranked group by 1 union all
          select extent, n, i + 1, k from (select extent, n, i, greatest(30, floor(3e-1 * n), floor(n * ((95 - 5 * i) / 1e2)))::bigint k from (select distinct extent, n from ranked), range(14) g(i)) where k <= n),
tests as (select s.extent, s.n, step, k, avg(sd) md, avg(sd) / (nullif(stddev_samp(sd), 0) / sqrt(k)) t, (avg(sp) - avg(sr)) / greatest(sqrt(10e0 * k * (var_pop(sp) + var_pop(sr)) / (10e0 * k - 4) * 2 / (10e0 * k)), 1e-15) ti
          from sizes s join ranked r on r.extent = s.extent and r.r <= k group by 1, 2, 3, 4),
asked as (select extent, step, 'pair' as what, greatest(k - 1, 1) df, abs(t) t from tests union all select extent, step, 'inter', 10 * k - 4, abs(ti) from tests),
angle as (select *, atan(t / sqrt(df)) th, df % 2 = 0 as even, case when df % 2 = 0 then df // 2 else (df - 1) // 2 end terms from asked),
terms as (select extent, step, what, even, th, case when even then exp(lgamma(j + 5e-1) - lgamma(j + 1) - lgamma(5e-1)) * cos(th) ** (2 * j) else exp(lgamma(5e-1) + lgamma(j + 1) - lgamma(j + 1.5e0)) / 2 * cos(th) ** (2 * j + 1) end x
          from angle left join range((select max(terms) from angle)) g(j) on j < terms),
tails as (select extent, step, what, case when any_value(even) then 1 - sin(any_value(th)) * sum(x) else 1 - 2 / pi() * (any_value(th) + sin(any_value(th)) * coalesce(sum(x), 0)) end p from terms group by 1, 2, 3),
tried as (select t.*, i.p pi, coalesce(k >= 3 and q.p > 5e-2 and abs(md) <= 5e-3 and i.p > 5e-2, false) as passed
          from tests t join tails q on q.extent = t.extent and q.step = t.step and q.what = 'pair' join tails i on i.extent = t.extent and i.step = t.step and i.what = 'inter'),
verdict as (select extent, passed as compliant, k n_selected from tried qualify row_number() over (partition by extent order by passed desc, case when passed then step else (step = 0)::int end, round(abs(md), 12), coalesce(pi, 0) desc, step) = 1)"""
_EXTENT = f"""{m._SIDES}, stats as (select {m._STATS} from pool), tol as (select greatest(avg(p_retailprice) * 2e-2, 1e-9) t from proj), tn as (select *, p_partkey % 3 as half from proj),
box as (select min(p_partkey * 3e1) x0, max(p_partkey * 3e1) x1 from proj where p_partkey < 400), pr as (select * from proj where p_partkey < 400),
dd as (select d.*, greatest(x0 - d.p_partkey * 3e1, d.p_partkey * 3e1 - x1, 0) / 1e3 as need from don d, box), e as (select * from {_KM}),
c as (select p.p_partkey as proj_idx, d.p_partkey as donor_idx, d.need, {m._DIST} as distance, d.p_retailprice, d.p_size, p.p_retailprice as pp, p.p_size as ps from pr p join dd d on p.cls = d.cls, stats, tol where abs(d.p_retailprice - p.p_retailprice) <= t and abs(d.p_size - p.p_size) <= 10 and abs(d.elev - p.elev) <= 20),
best as (select extent, c.*, (((proj_idx * 31) % 101) - ((donor_idx * 31) % 101)) * 4e-5 as sd, ((proj_idx * 31) % 101 - 50) * 4e-5 as sp, ((donor_idx * 31) % 101 - 50) * 4e-5 as sr from c, e where need <= km qualify row_number() over (partition by extent, proj_idx order by distance, donor_idx) = 1),
{_VERDICT},
side as (select avg(p_size) mp, var_pop(p_size) vp, count(*) n_project from pr),
mm as (select extent, count(*) n_matched, any_value(v.n_selected) n_selected, any_value(v.compliant) compliant, avg(p_size) mr, var_pop(p_size) vr from best left join verdict v using (extent) group by 1),
dn as (select extent, count(*) n_donor from dd, e where need <= km group by 1),
k as (select extent, n_project, n_donor, coalesce(n_matched, 0) n_matched, coalesce(n_selected, 0) n_selected, coalesce(compliant, false) as ok_compliant, abs(mp - mr) / sqrt((vp + vr) / 2) as smd from dn left join mm using (extent), side),
o as (select *, n_donor / n_project::double >= 3 as ok_ratio, coalesce(n_matched / n_project::double * 100 >= 50, false) as ok_match, coalesce(n_selected / greatest(n_matched, 1)::double * 100 >= 30, false) as ok_twin, coalesce(round(smd, 4) <= 5e-1, false) as ok_smd from k)"""
_ALL = "ok_ratio and ok_match and ok_twin and ok_smd and ok_compliant"
_SWEEP = SweepConfig(coverage_pct=50.0, smd=0.5)
_YEARS = (2013, 2014, 2015, 2016, 2017)


def _extent_criteria(spark: SparkSession, sf_dir: str) -> DataFrame:
    project, donors = m.sides(spark, sf_dir)
    metric = matching.fit_metric(project, donors, m.COVS, whitening="standard")
    limits = m.limits(project)
    place = lambda df, c: df.withColumns({"x_utm": F.col(c) * 30.0, "y_utm": F.lit(0.0)})
    project, donors = place(project.where("proj_idx < 400"), "proj_idx"), place(donors, "donor_idx")
    # yearly values on lines of slopes that no covariate tells
    line = lambda df, c: df.withColumns({f"NDVI_{y}": F.lit(0.4) + (F.col(c) * 31 % 101 - 50) * 4e-5 * (y - 2015) for y in _YEARS})
    metrics = sweep.match_extents(line(project, "proj_idx"), line(donors, "donor_idx"), limits, "cls", metric, _SWEEP.extents, ["p_size"], _YEARS)
    return sweep.extent_criteria(metrics, _SWEEP)


@query(f"with {_EXTENT} select extent, n_project, n_donor, n_matched, n_selected, round(smd, 4) as smd_max, ok_ratio, ok_match, ok_twin, ok_smd, ok_compliant, {_ALL} as all_sufficient from o")
def extent_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matching, balance and twin share of all extents in one plan."""
    return _extent_criteria(spark, sf_dir).select("extent", "n_project", "n_donor", "n_matched", "n_selected", "smd_max", "ok_ratio", "ok_match", "ok_twin", "ok_smd", "ok_compliant", "all_sufficient")


@query(f"with {_EXTENT} select extent, n_project, n_donor, n_matched, round(n_donor / n_project::double, 2) as ratio, round(n_matched / n_project::double * 100, 2) as match_coverage_pct, round(n_selected / greatest(n_matched, 1)::double * 100, 2) as twin_pct, {_ALL} as all_sufficient from o")
def extent_sweep_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The figures that the criteria of the extents are held against."""
    return _extent_criteria(spark, sf_dir).select("extent", "n_project", "n_donor", "n_matched", "ratio", "match_coverage_pct", "twin_pct", "all_sufficient")


@query(f"with {_EXTENT} select extent, n_donor from o where {_ALL} order by case extent when 'full' then 1e300 else try_cast(extent as double) end limit 1")
def min_sufficient_extent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sweep.minimum_extent(_extent_criteria(spark, sf_dir)).select("extent", "n_donor")


@query(f"""
with {_EXTENT} select criterion, x.extent, case when ok then 'PASS' else 'FAIL' end as cell from o, lateral (values ('ok_ratio', ok_ratio), ('ok_match', ok_match), ('ok_twin', ok_twin), ('ok_smd', ok_smd), ('ok_compliant', ok_compliant), ('all_sufficient', {_ALL})) c(criterion, ok), lateral (select o.extent) x(extent)""")
def extent_comparison_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The comparison's cells: passed or failed, by criterion and extent."""
    return sweep.comparison_table(_extent_criteria(spark, sf_dir), ("ok_ratio", "ok_match", "ok_twin", "ok_smd", "ok_compliant", "all_sufficient"))


@query("""
with plan as (select s.source, 1995 as t0_year, y::int as monitoring_year from (values ('A'), ('N'), ('R'), ('Z')) s(source), generate_series(1996, 2000) g(y)), have as (select distinct l_returnflag as source, year(l_shipdate) as yr from lineitem)
select source, t0_year, monitoring_year, case when not exists (select 1 from have h where h.source = p.source and h.yr = t0_year) then 'missing_start' when not exists (select 1 from have h where h.source = p.source and h.yr = monitoring_year) then 'missing_end' else 'ready' end as status from plan p""")
def batch_plan_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dry run: which items of a batch have both their carbon tables."""
    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("source"), F.year("l_shipdate").alias("year"))
    plan = sweep.periods(spark, ("A", "N", "R", "Z"), tuple((1995, y) for y in range(1996, 2001)))
    return sweep.plan_status(plan, li)
