"""Operators on small literal tables against values worked out by hand or by plain numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapair.config import AreaConfig, BaselineConfig, CarbonSpec, ExtractConfig, Grid, MatchConfig, TrendConfig
from terrapair.functions import columns, ols, projection, quantiles, ranking
from terrapair.operators import area, balance, baseline, carbon, extract, matching, raster, scenes, sweep, trend
from terrapair.plans.pipeline import shared_store
from terrapair.sources import tables

GRID = Grid(0.0, 300.0)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_finite_and_ratio(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (float("inf"),), (None,)], "x double")
    assert [r[0] for r in columns.clean(df).collect()] == [1.0, None, None, None]
    assert df.where(columns.all_finite(["x"])).count() == 1
    with pytest.raises(ValueError):
        columns.expect_columns(df, ["y"], "test")


@pytest.mark.parametrize("dof", [1, 2, 3, 4, 5, 10, 31])
def test_t_pvalue_closed_form_equals_incomplete_beta(spark, dof):
    df = spark.createDataFrame([(t, dof) for t in (0.0, 0.3, 1.0, 2.0, 7.5)], "t double, d int")
    for r in df.select("t", columns.t_two_sided(F.col("t"), F.col("d")).alias("p")).collect():
        assert r["p"] == pytest.approx(columns.t_sf2(r["t"], dof), abs=1e-10)
    assert columns.t_sf2(1.0, 1) == pytest.approx(0.5) and columns.t_sf2(2.0, 2) == pytest.approx(1 - 2 / math.sqrt(6))


def test_row_ols(spark):
    data = [(1, 1.0, 2.0, 3.0, 4.0, 5.0), (2, 1.0, None, 2.0, float("nan"), 5.0), (3, 1.0, 2.0, None, None, None), (4, 2.0, 2.0, 2.0, 2.0, 2.0), (5, None, None, None, None, None), (6, 1.0, 3.0, 2.0, 5.0, 4.0)]
    df = spark.createDataFrame(data, "id int, a double, b double, c double, d double, e double")
    years = [2013, 2014, 2015, 2016, 2017]
    got = {r["id"]: r["o"] for r in df.select("id", ols.row_ols(list("abcde"), years, 3).alias("o")).collect()}
    assert got[1]["slope"] == pytest.approx(1) and got[1]["pvalue"] == pytest.approx(1) and got[1]["n"] == 5
    x, y = np.array([2013, 2015, 2017.0]), np.array([1, 2, 5.0])
    assert got[2]["slope"] == pytest.approx(np.polyfit(x, y, 1)[0]) and got[2]["n"] == 3
    assert got[3]["slope"] is None and got[3]["pvalue"] is None and got[3]["n"] == 2
    assert got[4]["slope"] == 0 and got[4]["pvalue"] == 1
    assert got[5]["slope"] is None and got[5]["n"] == 0
    y = np.array([1, 3, 2, 5, 4.0])
    x = np.arange(5.0)
    b, a = np.polyfit(x, y, 1)
    se = math.sqrt(((y - a - b * x) ** 2).sum() / 3 / ((x - 2) ** 2).sum())
    assert got[6]["pvalue"] == pytest.approx(columns.t_sf2(b / se, 3))


def test_projection_round_trip_and_known_point(spark):
    assert projection.utm_zone(21.0, -17.0) == "EPSG:32734" and projection.utm_zone(3.0, 50.0) == "EPSG:32631"
    df = spark.createDataFrame([(21.0, -17.0), (18.3, -22.9), (23.9, -1.0)], "lon double, lat double")
    x, y = projection.to_utm(F.col("lon"), F.col("lat"), "EPSG:32734")
    lon, lat = projection.from_utm(F.col("x"), F.col("y"), "EPSG:32734")
    back = df.withColumns({"x": x, "y": y}).withColumns({"lon2": lon, "lat2": lat}).collect()
    for r in back:
        assert r["lon2"] == pytest.approx(r["lon"], abs=1e-9) and r["lat2"] == pytest.approx(r["lat"], abs=1e-9)
    assert back[0]["x"] == pytest.approx(500000.0, abs=1e-6)
    mx, my = projection.to_web_mercator(F.lit(180.0), F.lit(0.0))
    r = spark.range(1).select(mx.alias("x"), my.alias("y")).first()
    assert r["x"] == pytest.approx(20037508.342789244) and r["y"] == pytest.approx(0, abs=1e-8)


def test_global_rank_both_ways(spark):
    rng = random.Random(1)
    df = spark.createDataFrame([(i, float(rng.randint(0, 50))) for i in range(500)], "id long, v double")
    small = {r["id"]: r["rank"] for r in ranking.global_rank(df, "v", "id").collect()}
    limit, ranking.SMALL = ranking.SMALL, 10
    try:
        big = {r["id"]: r["rank"] for r in ranking.global_rank(df, "v", "id").collect()}
    finally:
        ranking.SMALL = limit
    assert small == big and sorted(small.values()) == list(range(1, 501))


def test_extraction_filters(spark):
    cells = spark.createDataFrame([(r, c, float(r * 10 + c)) for r in range(10) for c in range(10)], "grid_row int, grid_col int, v double").withColumn("source_tile", F.lit("t"))
    g = extract.with_geometry(cells, GRID)
    assert g.where("grid_row = 0 and grid_col = 1").select("x_utm", "y_utm", "cell_xmin", "cell_ymax", "pixel_id").first()[:] == (45.0, 285.0, 30.0, 300.0, "t::r0::c1")
    assert extract.exclude_bbox_edges(g, GRID, 1).count() == 64
    assert extract.clip_to_extent(g, (0.0, 0.0, 60.0, 300.0), 0.06).count() == 40
    mask = spark.createDataFrame([(0, 0), (5, 5), (99, 99)], "mask_row int, mask_col int")
    inside, outside = extract.filter_by_mask(g, mask, GRID, True), extract.filter_by_mask(g, mask, GRID, False)
    assert inside.count() == 2 and outside.count() == 98 and inside.columns == g.columns
    with pytest.raises(ValueError):
        extract.apply_masks(g.where("grid_row = 9"), "donor", GRID, None, mask.limit(0), ExtractConfig())
    keep = extract.apply_masks(g, "project", GRID, mask, None, ExtractConfig(forest_mode="keep_inside"))
    assert keep.count() == 2
    assert extract.stratified_sample(g, 150.0, ["pixel_id"]).count() == 4
    assert extract.covariates(["NDVI_t0", "NDVI_2013", "elevation", "WRB2_CODE", "band_3", "is_donor"]) == ["NDVI_t0", "elevation"]
    assert extract.t0_year(["NDVI_2013", "NDVI_2017"]) == 2018
    twice = g.unionByName(g.withColumn("source_tile", F.lit("a")))
    assert {r["source_tile"] for r in extract.first_per_key(twice, ["x_utm", "y_utm"], ["source_tile"]).collect()} == {"a"}


def test_exact_quantiles_through_brackets(spark):
    rng = np.random.default_rng(2)
    a, b = rng.normal(size=5000), np.repeat([1.0, 2.0, 5.0], [2000, 2500, 500])
    rng.shuffle(b)
    rows = [(float(x), float(y), None, int(i % 7)) for i, (x, y) in enumerate(zip(a, b))] + [(float("nan"), float("inf"), None, None)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d int")
    shares = [0.0, 0.01, 0.4, 0.5, 0.9, 0.98, 1.0]
    for keep in (30, 100_000):
        got = quantiles.exact_quantiles(df, ["a", "b", "c", "d"], shares, keep)
        assert got["a"] == pytest.approx(np.quantile(a, shares)) and got["b"] == pytest.approx(np.quantile(b, shares))
        assert got["c"] is None and got["d"] == pytest.approx(np.quantile(np.arange(5000) % 7, shares))


def test_stratified_cap_by_thresholds_equals_all_ranks(spark):
    df = spark.range(20000).select("id", (F.col("id") % 10 == 0).cast("string").alias("s"))
    got = {r["id"] for r in extract.stratified_cap(df, 2000, "s", ["id"], 42).collect()}
    order = df.select("id", "s", F.xxhash64(F.lit(42), "id").alias("h")).toPandas().sort_values(["h", "id"])
    assert got == {x for s, q in (("true", 200), ("false", 1800)) for x in order[order.s == s].id[:q]}


def test_texture_prefilter_cap(spark):
    df = spark.createDataFrame([(i, i % 32) for i in range(64)], "id long, WRB2_CODE int")
    assert extract.assign_texture(df).count() == 60
    p = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    assert extract.quantile_bounds(p, ["x"])["x"] == pytest.approx((1 - 19.6, 99 + 19.6))
    assert extract.quantile_bounds(p.limit(0), ["x"]) == {}
    d = spark.createDataFrame([(i, "rare" if i < 3 else "common") for i in range(1000)], "id long, s string")
    capped = extract.stratified_cap(d, 100, "s", ["id"])
    counts = dict(rows(capped.groupBy("s").count()))
    assert sum(counts.values()) == 100 and counts["common"] >= 99


def polygons(spark, rings):
    out = []
    for pid, many in rings.items():
        for k, ring in enumerate(many):
            out += [(pid, k, i, *a, *b) for i, (a, b) in enumerate(zip(ring, [*ring[1:], ring[0]]))]
    return spark.createDataFrame(out, "poly_id long, ring_id int, edge_id int, x0 double, y0 double, x1 double, y1 double")


def inside(x, y, rings):
    n = 0
    for ring in rings:
        for (x0, y0), (x1, y1) in zip(ring, [*ring[1:], ring[0]]):
            if min(y0, y1) <= y < max(y0, y1) and x0 + (y - y0) / (y1 - y0) * (x1 - x0) <= x:
                n += 1
    return n % 2 == 1


def test_rasterize_concave_and_holed(spark):
    rings = {1: [[(10.0, 10.0), (250.0, 20.0), (130.0, 100.0), (280.0, 280.0), (20.0, 250.0)]], 2: [[(100.0, 100.0), (290.0, 100.0), (290.0, 290.0), (100.0, 290.0)], [(160.0, 160.0), (220.0, 160.0), (220.0, 220.0), (160.0, 220.0)]]}
    for pid, many in rings.items():
        got = set(rows(raster.rasterize(polygons(spark, {pid: many}), GRID)))
        want = {(r, c) for r in range(10) for c in range(10) if inside((c + 0.5) * 30, 300 - (r + 0.5) * 30, many)}
        assert got == want
    wkt = spark.createDataFrame([(7, "POLYGON ((0 0, 60 0, 60 60, 0 60, 0 0), (10 10, 10 20, 20 20, 20 10, 10 10))"), (8, None), (9, "MULTIPOLYGON (((0 0, 3 0, 3 3, 0 0)), ((5 5, 8 5, 8 8, 5 5)))"), (10, "POLYGON EMPTY")], "poly_id long, wkt string")
    edges = tables.edges_from_wkt(wkt)
    assert dict(rows(edges.groupBy("poly_id").count())) == {7: 8, 9: 6}
    assert dict(rows(raster.polygon_area_ha(edges)))[7] == pytest.approx(0.35)


def test_morphology_components_distance_slope(spark):
    cells = spark.createDataFrame([(0, 0), (0, 1), (1, 2), (5, 5), (5, 7), (9, 9)], "grid_row int, grid_col int")
    parts = raster.components(cells, lambda df: df.persist())
    groups = {}
    for r, c, k in rows(parts.select("grid_row", "grid_col", "component")):
        groups.setdefault(k, set()).add((r, c))
    assert sorted(map(sorted, groups.values())) == [[(0, 0), (0, 1), (1, 2)], [(5, 5)], [(5, 7)], [(9, 9)]]
    assert raster.keep_large_components(cells, GRID, 0.27, lambda df: df.persist()).count() == 3
    assert raster.dilate(cells.where("grid_row = 9"), 1).count() == 9
    assert rows(raster.erode(raster.dilate(cells.where("grid_row = 9"), 1), 1)) == [(9, 9)]
    assert (5, 6) in set(rows(raster.close(cells, 1)))
    pts = spark.createDataFrame([(0.0, 0.0), (100.0, 0.0), (1000.0, 1000.0)], "x_utm double, y_utm double")
    to = spark.createDataFrame([(3.0, 4.0), (90.0, 0.0)], "x_utm double, y_utm double")
    assert sorted(r["distance"] for r in raster.nearest_distance(pts, to, 20.0, 50.0).collect()) == [5.0, 10.0, 50.0]
    plane = spark.createDataFrame([(r, c, 3.0 * c) for r in range(4) for c in range(4)], "grid_row int, grid_col int, elevation double")
    got = [r["slope_deg"] for r in raster.terrain_slope(plane, GRID).collect() if r["slope_deg"] is not None]
    assert len(got) == 4 and all(v == pytest.approx(math.degrees(math.atan(0.1))) for v in got)


def pixels(spark, n_project=9, n_donor=60):
    """two textures, a planted twin per project pixel."""
    rng = random.Random(3)
    proj = [(i, "clay" if i % 2 else "loam", rng.uniform(0, 10), rng.uniform(0, 10)) for i in range(n_project)]
    don = [(100 + i, proj[i][1], proj[i][2] + 1e-3, proj[i][3]) for i in range(n_project)]
    don += [(200 + i, rng.choice(["clay", "loam"]), rng.uniform(0, 10), rng.uniform(0, 10)) for i in range(n_donor - n_project)]
    p = spark.createDataFrame([*proj, (50, "sand", 5.0, 5.0), (51, "clay", 500.0, 5.0)], "proj_idx long, cls string, a double, b double")
    return p, spark.createDataFrame(don, "donor_idx long, cls string, a double, b double")


def test_matching_finds_planted_twins_in_both_modes(spark):
    p, d = pixels(spark)
    limits = [matching.Caliper("a", 2.0), matching.Caliper("b", 2.0)]
    metric = matching.fit_metric(p.where("a < 100"), d, ["a", "b"])
    for mode in ("reference", "caliper_first"):
        m = matching.match(p, d, ["a", "b"], limits, "cls", MatchConfig(mode=mode), metric)
        got = {r["p_proj_idx"]: r["d_donor_idx"] for r in m.pairs.collect()}
        assert got == {i: 100 + i for i in range(9)}
        un = {r["proj_idx"]: r["reason"] for r in m.unmatched.collect()}
        assert un[50] == "no_texture_donor" and 51 in un
        s = {r["cls"]: r for r in m.summary.collect()}
        assert s["clay"]["matched_n"] + s["loam"]["matched_n"] == 9 and s["sand"]["unmatched_n"] == 1
        assert set(got) | set(un) == {r["proj_idx"] for r in p.collect()} and not set(got) & set(un)


@pytest.mark.parametrize("mode", ["reference", "caliper_first"])
def test_tenure_is_an_exact_caliper(spark, mode):
    p = spark.createDataFrame([(1, "x", 0.0, "a"), (2, "x", 0.0, None), (3, "x", 0.0, "c")], "proj_idx long, cls string, a double, tenure_status string")
    d = spark.createDataFrame([(10, "x", 0.0, "b"), (11, "x", 0.5, "a"), (12, "x", 0.7, None), (13, "x", 90.0, "d")], "donor_idx long, cls string, a double, tenure_status string")
    metric = matching.Metric(("a",), np.zeros(1), np.ones(1), np.eye(1))
    m = matching.match(p, d, ["a"], [matching.Caliper("a", 10.0)], "cls", MatchConfig(mode=mode), metric)
    assert sorted((r["p_proj_idx"], r["d_donor_idx"]) for r in m.pairs.collect()) == [(1, 11), (2, 12)]
    reason = "no_candidate_passed_hard_calipers" if mode == "reference" else "no_texture_compatible_in_knn"
    assert [(r["proj_idx"], r["reason"], r["queried_n"]) for r in m.unmatched.collect()] == [(3, reason, 3 if mode == "reference" else None)]


def test_fallback_classes_are_candidates_but_fail_the_class_caliper(spark):
    p = spark.createDataFrame([(1, "sand", 0.0), (2, "loam", 0.0), (3, "other", 0.0)], "proj_idx long, cls string, a double")
    d = spark.createDataFrame([(10, "sandy_loam", 0.0), (11, "loam", 5.0)], "donor_idx long, cls string, a double")
    metric = matching.Metric(("a",), np.zeros(1), np.ones(1), np.eye(1))
    m = matching.match(p, d, ["a"], [], "cls", MatchConfig(fallback=True), metric)
    assert [(r["p_proj_idx"], r["d_donor_idx"], r["rejected"]) for r in m.pairs.collect()] == [(2, 11, 0)]  # a class with donors doesn't fall back
    assert sorted((r["proj_idx"], r["reason"], r["queried_n"]) for r in m.unmatched.collect()) == [(1, "no_candidate_passed_hard_calipers", 1), (3, "no_texture_donor", None)]
    s = {r["cls"]: r for r in m.summary.collect()}
    assert (s["sand"]["exact_texture"], s["sand"]["rejected_total"], s["loam"]["exact_texture"], s["sand"]["k_query"]) == (False, 1, True, 1)
    m = matching.match(p, d, ["a"], [], "cls", MatchConfig(), metric)
    assert {r["proj_idx"]: r["reason"] for r in m.unmatched.collect()} == {1: "no_texture_donor", 3: "no_texture_donor"}


def test_caliper_first_with_missing_project_values(spark):
    rng = random.Random(3)
    p = spark.createDataFrame([(i, "xy"[i % 2], rng.choice([None, 0.0, 3.0, 9.0]), rng.choice([None, 1.0, 8.0]), rng.choice([None, 2.0]), float(i)) for i in range(40)], "proj_idx long, cls string, a double, b double, c double, z double")
    d = spark.createDataFrame([(100 + i, "xy"[i // 3 % 2], rng.uniform(0, 9), rng.choice([None, 1.0, 7.5]), rng.uniform(0, 4), float(i)) for i in range(60)], "donor_idx long, cls string, a double, b double, c double, z double")
    limits = [matching.Caliper("a", 2.0), matching.Caliper("b", 1.0), matching.Caliper("c", 1.5)]
    metric = matching.Metric(("z",), np.zeros(1), np.ones(1), np.eye(1))
    m = matching.match(p, d, ["z"], limits, "cls", MatchConfig(mode="caliper_first"), metric)
    want = {}
    for x in p.collect():
        ok = [y for y in d.collect() if y["cls"] == x["cls"] and all(x[c.column] is None or (y[c.column] is not None and abs(y[c.column] - x[c.column]) <= c.tolerance) for c in limits)]
        if ok:
            want[x["proj_idx"]] = min((abs(y["z"] - x["z"]), y["donor_idx"]) for y in ok)[1]
    assert {r["p_proj_idx"]: r["d_donor_idx"] for r in m.pairs.collect()} == want and len(want) > 25


def test_relative_calipers_need_a_mean(spark):
    p = spark.createDataFrame([(1, None, 0.5)], "proj_idx long, SOC_g_kg double, NDVI_t0 double")
    with pytest.raises(ValueError, match="SOC_g_kg"):
        matching.calipers(p)
    assert matching.calipers(p.drop("SOC_g_kg"))[0] == matching.Caliper("NDVI_t0", 0.05)


def test_reuse_flag_and_enforcement(spark):
    p = spark.createDataFrame([(1, "x", 0.0), (2, "x", 0.1), (3, "x", 0.2)], "proj_idx long, cls string, a double")
    d = spark.createDataFrame([(10, "x", 0.0), (11, "x", 1.0), (12, "x", 2.0)], "donor_idx long, cls string, a double")
    metric = matching.Metric(("a",), np.zeros(1), np.ones(1), np.eye(1))
    m = matching.match(p, d, ["a"], [], "cls", metric=metric)
    assert sorted((r["p_proj_idx"], r["d_donor_idx"], r["reuse_exceeded"]) for r in m.pairs.collect()) == [(1, 10, False), (2, 10, True), (3, 10, True)]
    m = matching.match(p, d, ["a"], [matching.Caliper("a", 10.0)], "cls", MatchConfig(mode="caliper_first"), metric)
    got = matching.enforce_reuse(m.candidates, 1, store=lambda df: df.persist())
    assert sorted((r["p_proj_idx"], r["d_donor_idx"]) for r in got.collect()) == [(1, 10), (2, 12), (3, 11)]


def greedy(pairs, max_reuse):
    """Brute force: pairs by distance, project and donor; a project once, a donor max_reuse times."""
    done, uses, out = set(), {}, []
    for dist, p, d in sorted((x[2], x[0], x[1]) for x in pairs):
        if p not in done and uses.get(d, 0) < max_reuse:
            done.add(p)
            uses[d] = uses.get(d, 0) + 1
            out.append((p, d))
    return sorted(out)


@pytest.mark.parametrize("max_reuse, chunk", [(1, 200_000), (1, 1500), (3, 1500)])
def test_enforced_reuse_equals_greedy_with_many_projects_on_one_donor_order(spark, max_reuse, chunk):
    rng = random.Random(5)
    pairs = [(p, 1000 + d, float(d // 2)) for p in range(60) for d in range(90)]  # one donor order, donors tied by twos
    pairs += [(p, 1000 + d, round(rng.uniform(0, 60), 1)) for p in range(60, 100) for d in rng.sample(range(150), 30)]
    cand = spark.createDataFrame([(*x, True) for x in pairs] + [(7, 5000, 0.0, False)], "p_proj_idx long, d_donor_idx long, distance double, passed boolean")
    more = {} if chunk == 200_000 else {"chunk": chunk}
    got = sorted((r["p_proj_idx"], r["d_donor_idx"]) for r in matching.enforce_reuse(cand, max_reuse, store=shared_store(spark, "reuse"), **more).collect())
    assert got == greedy(pairs, max_reuse) and len(got) == 100


def test_knn_blocks_sql_and_numpy_agree(spark):
    rng = np.random.default_rng(0)
    p = spark.createDataFrame([(i, *map(float, rng.normal(size=3))) for i in range(40)], "proj_idx long, a double, b double, c double")
    d = spark.createDataFrame([(i, *map(float, rng.normal(size=3))) for i in range(300)], "donor_idx long, a double, b double, c double")
    metric = matching.fit_metric(p, d, ["a", "b", "c"])
    one = sorted(rows(matching.knn(p, d, metric, 7)))
    assert [x[:2] for x in one] == [x[:2] for x in sorted(rows(matching.knn(p, d, metric, 7, block_rows=100).select("proj_idx", "donor_idx", "distance", "rank")))]
    assert [x[:2] for x in one] == [x[:2] for x in sorted(rows(matching.knn_sql(p, d, metric, 7)))]


def test_knn_in_boxes_equals_brute_force(spark):
    """Clusters of donors, far project rows, a very frequent vector, more neighbours than a box holds."""
    rng = np.random.default_rng(3)
    at = np.concatenate([rng.normal(c, s, size=(n, 2)) for c, s, n in (((0, 0), 1, 900), ((50, 0), 0.1, 900), ((0, 9), 5, 300))] + [np.full((700, 2), 3.0)])
    q = np.concatenate([rng.normal((0, 0), 4, size=(20, 2)), rng.normal((50, 0), 1, size=(20, 2)), [[500.0, -500.0], [3.0, 3.0]]])
    d = spark.createDataFrame([(int(i), *map(float, x)) for i, x in zip(rng.permutation(len(at)), at)], "donor_idx long, a double, b double")
    p = spark.createDataFrame([(i, *map(float, x)) for i, x in enumerate(q)], "proj_idx long, a double, b double")
    metric = matching.Metric(("a", "b"), np.zeros(2), np.ones(2), np.eye(2))
    ids = np.array([r["donor_idx"] for r in d.collect()])
    for k, rows_ in ((5, 100), (60, 100)):
        got = {}
        for r in matching.knn(p, d, metric, k, rows_).collect():
            got.setdefault(r["proj_idx"], []).append((r["rank"], r["donor_idx"]))
        for i, x in enumerate(q):
            dist = np.round(np.sqrt(((at - x) ** 2).sum(1)), 9)
            assert [j for _, j in sorted(got[i])] == ids[np.lexsort((ids, dist))[:k]].tolist()


@pytest.mark.parametrize("spread", [0, 1e-12])
def test_knn_gives_ties_to_the_smaller_ids(spark, spread):
    """Hundreds of donors at one distance, equal ones and ones on a circle, in shuffled id order."""
    rng = np.random.default_rng(2)
    ids = rng.permutation(900)
    angle = rng.uniform(0, 2 * math.pi, 900)
    at = [(5.0 + spread * i, 1.0) if i % 3 else (1e3 + 2 * math.cos(t), 1e3 + 2 * math.sin(t)) for i, t in zip(ids.tolist(), angle.tolist())]
    d = spark.createDataFrame([(int(i), *x) for i, x in zip(ids, at)], "donor_idx long, a double, b double")
    p = spark.createDataFrame([(0, 4.0, 1.0), (1, 1e3, 1e3), (2, 5.0, 1.0)], "proj_idx long, a double, b double")
    metric = matching.Metric(("a", "b"), np.zeros(2), np.ones(2), np.eye(2))
    tied = {0: [i for i in range(900) if i % 3], 1: list(range(0, 900, 3))}
    tied[2] = tied[0]
    for block_rows in (300_000, 200):
        got = sorted((r["proj_idx"], r["rank"], r["donor_idx"]) for r in matching.knn(p, d, metric, 7, block_rows).collect())
        assert got == [(q, k + 1, tied[q][k]) for q in range(3) for k in range(7)]


def test_ledoit_wolf_against_numpy(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(80, 4)) @ rng.normal(size=(4, 4)) + 5
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double, d double")
    m = matching.moments(df, list("abcd"))
    z = (x - x.mean(0)) / x.std(0)
    s = z.T @ z / len(z)
    mu = np.trace(s) / 4
    delta = ((s - mu * np.eye(4)) ** 2).sum() / 4
    beta = min(sum(((np.outer(r, r) - s) ** 2).sum() for r in z) / len(z) ** 2 / 4, delta)
    sigma, shrink = matching.ledoit_wolf(m)
    assert shrink == pytest.approx(beta / delta) and np.allclose(sigma, (1 - shrink) * s + shrink * mu * np.eye(4))


def test_validation(spark):
    p, d = pixels(spark)
    with pytest.raises(ValueError):
        matching.validate_mandatory(p, d)
    assert matching.tenure_column(p, d) is None
    k = [r[0] for r in spark.range(0, 3000, 1000).select(matching.adaptive_k(F.col("id") + 1, MatchConfig())).collect()]
    assert sorted(k) == [1, 150, 150]


def test_balance(spark):
    a = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "x double, y double")
    assert {r["covariate"]: (r["smd"], r["passed"]) for r in balance.smd(a, a, ["x", "y"]).collect()} == {"x": (0.0, True), "y": (0.0, True)}
    b = a.withColumn("x", F.col("x") + 1)
    r = balance.smd(a, b, ["x"]).first()
    assert r["smd"] == round(1 / math.sqrt(2 / 3), 4) and not r["passed"]
    assert not balance.smd(a, a.limit(0), ["x"]).first()["passed"]
    s = balance.covariate_summary(spark.createDataFrame([(float(i), None) for i in range(101)] + [(float("nan"), None)], "x double, z double"), ["x", "z"]).collect()
    assert len(s) == 1 and (s[0]["n"], s[0]["median"], s[0]["q02"], s[0]["q98"]) == (101, 50.0, 2.0, 98.0)
    f = balance.audit(spark.createDataFrame([(True,), (False,), (None,)], "ok boolean"), ["ok"]).first()
    assert (f["n"], f["passed_n"], f["passed_pct"]) == (2, 1, 50.0)


def pair_frame(spark, diffs, years=(2013, 2014, 2015, 2016, 2017)):
    data = []
    for i, d in enumerate(diffs):
        proj = [0.5 + 0.01 * k for k in range(5)]
        ref = [0.4 + (0.01 + d) * k for k in range(5)]
        data.append((i, *proj, *ref))
    names = [f"proj_NDVI_{y} double" for y in years] + [f"ref_NDVI_{y} double" for y in years]
    return spark.createDataFrame(data, "pair_id long, " + ", ".join(names)), list(years)


def test_interaction_equals_regression(spark):
    rng = np.random.default_rng(4)
    data = [(i, float(y), float(g), float(0.3 * y * (1 + 0.1 * g) + rng.normal())) for i in range(12) for y in range(5) for g in (0, 1)]
    long = spark.createDataFrame(data, "pair_id long, year double, group double, value double")
    x = np.array([[1, g, y, g * y] for _, y, g, _ in data])
    v = np.array([r[3] for r in data])
    b, res, *_ = np.linalg.lstsq(x, v, rcond=None)
    se = math.sqrt(res[0] / (len(v) - 4) * np.linalg.inv(x.T @ x)[3, 3])
    r = trend.interaction_sums(long).first()
    assert r["interaction"] == pytest.approx(b[3]) and r["t"] == pytest.approx(b[3] / se)
    assert trend.interaction_test(long).pvalue == pytest.approx(columns.t_sf2(b[3] / se, len(v) - 4))
    assert not trend.interaction_test(long.where("group = 1")).passed


@pytest.mark.parametrize("kind", ["fixed", "prefix", "never"])
def test_selection_modes(spark, kind):
    rng = random.Random(5)
    if kind == "fixed":
        diffs = [rng.uniform(-0.004, 0.004) for _ in range(40)]
    elif kind == "prefix":
        diffs = [rng.uniform(-0.002, 0.002) for _ in range(28)] + [0.004 + 1e-5 * i for i in range(12)] + [0.02] * 3
    else:
        diffs = [0.05 + 1e-4 * i for i in range(40)]
    pairs, years = pair_frame(spark, diffs)
    s = trend.select_parallel(trend.pair_slopes(pairs, years), years, TrendConfig())
    n = s.pairs.where("selected").count()
    assert s.mode == {"fixed": "fixed_pair_slope_threshold", "prefix": "iterative_smallest_slope_diff", "never": "best_available_failed_or_marginal"}[kind]
    assert s.compliant == (kind != "never") and n == s.n_selected > 0
    assert s.pairs.where("twin_compliant").count() == (n if s.compliant else 0)


def gaps_frame(spark, n=40):
    """Pairs of equal slopes whose references are low in early years and high in late ones, the rest missing."""
    rng = random.Random(8)
    years = (2013, 2014, 2015, 2016, 2017)
    data = []
    for i in range(n):
        ref = [0.4 + 0.01 * k + rng.uniform(-0.001, 0.001) + (0.2 if i % 2 else 0.0) if (k >= 2 if i % 2 else k <= 2) else None for k in range(5)]
        data.append((i, *[0.5 + 0.01 * k + rng.uniform(-0.001, 0.001) for k in range(5)], *ref))
    names = [f"proj_NDVI_{y} double" for y in years] + [f"ref_NDVI_{y} double" for y in years]
    return spark.createDataFrame(data, "pair_id long, " + ", ".join(names)), list(years)


def test_selection_needs_both_tests(spark):
    pairs, years = gaps_frame(spark)
    sloped = trend.pair_slopes(pairs, years)
    assert trend.paired_slope_test(sloped).passed and not trend.interaction_test(trend.to_long(sloped, years)).passed
    s = trend.select_parallel(sloped, years)
    assert not s.compliant and s.test.passed and not s.interaction.passed and s.mode == "best_available_failed_or_marginal"
    assert s.pairs.where("selected").count() == s.n_selected > 0 and s.pairs.where("twin_compliant").count() == 0
    few = trend.select_parallel(sloped.limit(12), years)  # no prefix of 30 pairs
    assert few.mode == "failed_no_valid_candidate" and few.n_selected == 12 and not few.compliant
    none = trend.select_parallel(sloped.limit(0), years)
    assert none.mode == "failed_no_valid_candidate" and none.n_selected == 0


def test_prefix_statistics_equal_the_single_tests(spark):
    pairs, years = gaps_frame(spark)
    sloped = trend.pair_slopes(pairs, years)
    order = [r["pair_id"] for r in sloped.orderBy("slope_diff", "pair_id").collect()]
    for r in trend.prefix_statistics(sloped, [20, 30, 38], years).collect():
        part = sloped.where(F.col("pair_id").isin(order[: r["size"]]))
        one, two = trend.paired_sums(part).first(), trend.interaction_sums(trend.to_long(part, years)).first()
        assert [r[k] for k in ("n", "mean_diff", "sd")] == pytest.approx([one[k] for k in ("n", "mean_diff", "sd")])
        assert [r[k] for k in ("n_obs", "interaction", "se", "t")] == pytest.approx([two[k] for k in ("n", "interaction", "se", "t")])
    assert trend.prefix_sizes(40, 200) == {} and list(trend.prefix_sizes(40, 40).values())[:3] == [38, 36, 34]


def test_attach_and_long(spark):
    pairs = spark.createDataFrame([(1, 10, 0.1234567891, 1.0, 0.3), (2, 11, 5.0, 5.0, None)], "pair_id long, proj_idx long, proj_lon double, proj_lat double, NDVI_2013 double")
    proj = spark.createDataFrame([(10, 0.1234567892, 1.0, 0.9), (12, 0.1234567892, 1.0, 0.9)], "proj_idx long, lon double, lat double, NDVI_2013 double")
    by_id = trend.attach_series(pairs, proj, [2013]).orderBy("pair_id").collect()
    by_pos = trend.attach_by_position(pairs, proj, [2013]).orderBy("pair_id").collect()
    assert [r["proj_NDVI_2013"] for r in by_id] == [0.9, None] == [r["proj_NDVI_2013"] for r in by_pos]
    long = trend.to_long(trend.attach_series(pairs, proj, [2013]), [2013])
    assert sorted((r["pair_id"], r["group"], r["value"]) for r in long.collect()) == [(1, 0.0, 0.3), (1, 1.0, 0.9)]


def test_intervals_and_baseline(spark):
    df = spark.createDataFrame([(1.0, 0.0, 0.0, "a"), (3.0, 0.0, 0.0, "a"), (5.0, 1.0, 0.0, "b"), (float("nan"), 2.0, 0.0, "b")], "delta_tC_ha_yr double, ref_lon double, ref_lat double, block_id string")
    r = baseline.control_interval(df).first()
    assert (r["n_rows"], r["n_unique"], r["n_eff"], r["mean"], r["median"], r["sd"]) == (3, 2, 2, 3.0, 3.0, 2.0)
    assert r["ci_pixel"] == pytest.approx(1.645 * 2 / math.sqrt(2)) and r["ci_block"] == pytest.approx(1.645 * np.std([2, 5], ddof=1) / math.sqrt(2))
    assert r["ci_source"] == "block" and r["ci"] >= r["ci_pixel"] and r["uncbsl"] == pytest.approx(r["ci"] / 3)
    one = baseline.control_interval(df.withColumn("block_id", F.lit("a"))).first()
    assert one["ci_block"] is None and one["block_status"] == "not_enough_blocks" and one["ci_source"] == "pixel"
    neg = baseline.control_interval(df.withColumn("delta_tC_ha_yr", -F.col("delta_tC_ha_yr")))
    assert neg.first()["uncbsl"] is None
    proj = baseline.project_summary(df, 100.0, lon="ref_lon", lat="ref_lat")
    b = baseline.unadjusted_baseline(neg, proj, 6).first()
    assert b["baseline_status"] == "computed_negative_baseline_pm_override" and b["bl_period"] == pytest.approx(-1800)
    z = baseline.unadjusted_baseline(neg, proj, 6, BaselineConfig(allow_negative=False)).first()
    assert z["baseline_status"] == "zeroed_non_positive_baseline" and z["adjusted_yr"] == 0 and z["surplus_yr"] == pytest.approx(300)
    h = baseline.handoff(baseline.unadjusted_baseline(baseline.control_interval(df), proj, 6)).first()
    assert h["br_illustrative_tco2e"] == pytest.approx(1800 * 44 / 12 * 1.0125 * (1 + r["uncbsl"]))
    u = baseline.unique_interval(df, order=("delta_tC_ha_yr",)).first()
    assert (u["n"], u["mean"]) == (2, 3.0)
    c = baseline.crediting_baseline(baseline.unique_interval(df, order=("delta_tC_ha_yr",)), 10.0, 1.0).first()
    assert c["br_crediting"] == pytest.approx(c["br_unadj"] * 1.0125 * (1 + c["unc"]))
    assert baseline.find_area({"a": [{"area_ha": 5}]}) == 5.0 and baseline.find_area({}) is None
    with pytest.raises(ValueError):
        baseline.project_area(df, None, 0.09)


def test_carbon(spark):
    assert carbon.conversion_factor("AGB_Mg_ha") == pytest.approx(0.658) and carbon.conversion_factor("tC_ha") == 1
    with pytest.raises(ValueError):
        carbon.conversion_factor("kg")
    pts = carbon.cell_of(spark.createDataFrame([(1, 15.0, 285.0), (2, 1e6, 0.0), (3, float("nan"), 0.0)], "id int, x double, y double"), GRID, "x", "y")
    stock = lambda v: spark.createDataFrame([(0, 0, v)], "grid_row int, grid_col int, value double")
    out = carbon.change(pts, CarbonSpec(units="tC_ha"), 2.0, start=stock(4.0), end=stock(10.0))
    assert {r["id"]: r["delta_tC_ha_yr"] for r in out.collect()} == {1: 3.0, 2: None, 3: None}
    with pytest.raises(ValueError):
        carbon.change(pts, CarbonSpec(), 2.0)
    assert carbon.monitoring_period(BaselineConfig()) == 6
    for bad in (BaselineConfig(monitoring_year=2018), BaselineConfig(monitoring_year=2020), BaselineConfig(period_years=5)):
        with pytest.raises(ValueError):
            carbon.monitoring_period(bad)
    t = spark.createDataFrame([("1", "4.0")], "C_t0 string, C_y string")
    assert t.select(carbon.delta_column(t, 3.0)).first()[0] == 1.0
    t = spark.createDataFrame([(10.0, 20.0)], "AGB_t0_Mg_ha double, AGB_y_Mg_ha double")
    assert t.select(carbon.delta_column(t, 1.0)).first()[0] == pytest.approx(4.7)
    b = carbon.with_blocks(spark.createDataFrame([(-1.0, 999.0), (float("inf"), 0.0)], "x_utm double, y_utm double"), 500.0)
    assert [r["block_id"] for r in b.collect()] == ["-1_1", None]


def test_area_and_monitoring(spark):
    pts = spark.createDataFrame([(15.0, 285.0), (45.0, 285.0), (15.0, 15.0)], "x double, y double")
    assert {r["support_mode"] for r in area.support_cells(pts).collect()} == {"centroid"}
    blocks = area.support_cells(pts, AreaConfig(mode="block")).collect()
    assert sorted(r["n_matched_pts"] for r in blocks) == [1, 2] and all(r["area_ha"] == 2.25 for r in blocks)
    cells = spark.createDataFrame([(0, 0), (0, 0), (0, 1), (9, 0)], "grid_row int, grid_col int")
    ra = area.reference_cells(cells, GRID)
    assert ra.count() == 3
    s = area.area_summary(cells, ra, GRID).first()
    assert (s["n_cells"], s["n_in"], s["pct_in"]) == (3, 4, 100.0)
    lattice = sorted(rows(area.monitoring_lattice(ra, GRID, 30.0).select("x", "y")))
    assert lattice == [(0.0, 0.0), (0.0, 270.0), (30.0, 270.0)]
    assert area.monitoring_points(pts, ra.limit(0), GRID, AreaConfig(monitoring="grid")).first()["method"] == "matched_pixels"
    with pytest.raises(ValueError):
        area.check_twin(False)
    with pytest.raises(ValueError):
        area.check_lock(None)


def test_sweep(spark):
    d = spark.createDataFrame([(float(x), 0.0) for x in (0, 4000, 9000, 50000)], "x_utm double, y_utm double")
    tagged = sweep.tag_extents(d, (0.0, 0.0, 0.0, 0.0), ("full", 5, 10))
    counts = dict(rows(tagged.groupBy("extent").count()))
    assert counts == {"full": 4, "5": 2, "10": 3}
    schema = "extent string, n_project long, n_donor long, n_matched long, n_pairs long, n_selected long, smd_max double, twin_compliant boolean"
    m = spark.createDataFrame([("full", 10, 90, 10, 10, 9, 0.05, True), ("10", 10, 40, 9, 9, 5, 0.1, True), ("5", 10, 20, 9, 9, 5, 0.1, True)], schema)
    c = sweep.extent_criteria(m)
    assert sweep.minimum_extent(c).first()["extent"] == "10"
    assert sweep.minimum_extent(c.where("extent = 'full'")).first()["extent"] == "full"
    assert sweep.minimum_extent(c.where("extent = '5'")).count() == 0
    done, failed = sweep.run_each([1, 0], lambda x: 1 / x)
    assert done == {1: 1.0} and failed[0].name == "0"


def test_scenes(spark):
    s = spark.createDataFrame([(0, 0, 5.0, 20000.0, 10000.0), (8, 0, 5.0, 20000.0, 10000.0), (0, 1, 5.0, 1.0, 1.0), (0, 0, 50.0, 1.0, 1.0)], "qa int, saturation int, cloud_cover double, nir double, red double")
    out = scenes.prepare(s).collect()
    assert len(out) == 1 and out[0]["ndvi"] == pytest.approx((0.35 - 0.075) / (0.35 + 0.075))
    t = spark.createDataFrame([("2017-03-31",), ("2017-04-01",)], "d string").select(scenes.season_year(F.to_timestamp("d")))
    assert [r[0] for r in t.collect()] == [2016, 2017]
    assert spark.range(1).select(scenes.not_water(F.lit(None).cast("double"))).first()[0] is True
    cells = spark.createDataFrame([(0, 0, 0.0, 0.0), (0, 1, 8000.0, 0.0), (0, 2, 90000.0, 0.0)], "grid_row int, grid_col int, x_utm double, y_utm double")
    got = scenes.donor_domain(cells, cells.where("grid_col = 0"), None, {}, (0.0, 0.0, 0.0, 0.0), 50.0, 5.0)
    assert rows(got.select("grid_col")) == [(1,)]
