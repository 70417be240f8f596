"""Tiles named by the given paths, extents with tenure and trend tests, one sketch for several quantiles."""

import random

import numpy as np
from pyspark.sql import functions as F

from terrapair.config import TrendConfig
from terrapair.functions.quantiles import exact_quantiles, with_quantiles
from terrapair.operators import matching, sweep, trend
from terrapair.plans.pipeline import shared_store
from terrapair.sources import tables

TILE = "x_utm double, y_utm double, grid_row int, grid_col int, v double"


def one_file(df, folder, name):
    """A plain Parquet file, not a folder."""
    df.toPandas().to_parquet(f"{folder}/{name}", index=False)
    return f"{folder}/{name}"


def test_tiles_that_are_plain_files(spark, tmp_path):
    a = spark.createDataFrame([(1.0, 1.0, 0, 0, 10.0), (2.0, 1.0, 0, 1, 11.0)], TILE)
    b = spark.createDataFrame([(1.0, 1.0, 0, 0, 20.0), (3.0, 1.0, 0, 2, 21.0)], TILE)
    t1, t2 = one_file(a, tmp_path, "t1.parquet"), one_file(b, tmp_path, "t2.parquet")
    rows = lambda df: {(r["x_utm"]): (r["source_tile"], r["v"]) for r in df.collect()}
    assert rows(tables.load_tiles(spark, [t1, t2])) == {1.0: ("t1", 10.0), 2.0: ("t1", 11.0), 3.0: ("t2", 21.0)}
    # the caller's order decides on repeated cells
    assert rows(tables.load_tiles(spark, [t2, t1])) == {1.0: ("t2", 20.0), 2.0: ("t1", 11.0), 3.0: ("t2", 21.0)}
    # folders of one name get their parent's too; csv tiles and Parquet folders are told alike
    for k, df in (("p", a), ("q", b)):
        df.write.option("header", True).csv(f"{tmp_path}/{k}/tile.csv")
        df.repartition(2).write.parquet(f"{tmp_path}/{k}/tile.parquet")
    for kind in ("csv", "parquet"):
        found = rows(tables.load_tiles(spark, [f"{tmp_path}/p/tile.{kind}", f"{tmp_path}/q/tile.{kind}"]))
        assert found == {1.0: ("p/tile", 10.0), 2.0: ("p/tile", 11.0), 3.0: ("q/tile", 21.0)}


def test_tiles_of_unequal_types(spark, tmp_path):
    a = spark.createDataFrame([(1.0, 1.0, 0, 0, 10)], TILE.replace("v double", "v int"))
    b = spark.createDataFrame([(2.0, 1.0, 0, 1, 0.5)], TILE)
    paths = [one_file(a, tmp_path, "i.parquet"), one_file(b, tmp_path, "d.parquet")]
    out = tables.load_tiles(spark, paths)
    assert dict(out.dtypes)["v"] == "double" and {r["v"] for r in out.collect()} == {10.0, 0.5}


def sides(spark, slope, tenures=("a", "b"), n=60):
    """Projects and donors with equal covariates; donor series differ from the projects' by `slope` a year."""
    rng = random.Random(5)
    years = range(2013, 2018)
    shape = "idx long, cls string, tenure string, c double, x_utm double, y_utm double, " + ", ".join(f"NDVI_{y} double" for y in years)

    def row(i, x, tenure, s):
        base = rng.uniform(0.4, 0.6)
        return (i, "loam", tenure, float(i % 7), x, 0.0, *[base + s * (y - 2015) + rng.gauss(0, 0.01) for y in years])

    p = [row(i, float(i), tenures[0], 0.0) for i in range(n)]
    d = [row(1000 + i, 3000.0 + 40 * i, tenures[1], slope) for i in range(4 * n)]
    df = lambda rows, name: spark.createDataFrame(rows, shape).withColumnRenamed("idx", name).withColumnRenamed("tenure", "tenure_status")
    return df(p, "proj_idx"), df(d, "donor_idx"), list(years)


def extents(spark, slope, tenures=("a", "a"), years=True):
    p, d, series = sides(spark, slope, tenures)
    metric = matching.fit_metric(p, d, ["c"], whitening="standard")
    out = sweep.match_extents(p, d, [matching.Caliper("c", 1.0)], "cls", metric, ("full", 5, 10), ["c"], series if years else (), store=shared_store(spark))
    return {r["extent"]: r for r in sweep.extent_criteria(out).collect()}


def test_extents_need_equal_tenure(spark):
    assert matching.tenure_column(*sides(spark, 0.0)[:2]) == "tenure_status"
    assert all(r["n_matched"] == 0 for r in extents(spark, 0.0, ("a", "b")).values())
    assert all(r["n_matched"] == 60 for r in extents(spark, 0.0).values())


def test_extents_are_judged_by_the_trend_tests(spark):
    fair, steep, blind = extents(spark, 0.0), extents(spark, 0.05), extents(spark, 0.0, years=False)
    assert all(r["twin_compliant"] and r["ok_compliant"] and r["n_selected"] >= 30 for r in fair.values())
    assert not any(r["twin_compliant"] or r["ok_compliant"] or r["all_sufficient"] for r in steep.values())
    assert all(r["twin_compliant"] is None and not r["ok_compliant"] and not r["ok_twin"] for r in blind.values())


def test_group_verdicts_equal_those_of_each_group(spark):
    """Groups at once against the selection of each group alone."""
    rng, years = random.Random(9), list(range(2013, 2018))
    cols = ", ".join(f"{s}_NDVI_{y} double" for s in ("proj", "ref") for y in years)
    rows = []
    for g, slope in (("same", 0.0), ("near", 0.004), ("far", 0.03)):
        for i in range(80):
            s = slope + rng.gauss(0, 0.004)
            rows.append((g, i, *[0.5 + rng.gauss(0, 0.004) for _ in years], *[0.5 + s * (y - 2015) + rng.gauss(0, 0.004) for y in years]))
    rows += [("few", i, *[0.5 + rng.gauss(0, 0.01)] * 10) for i in range(3)] + [("none", 1, *[None] * 10)]
    pairs = trend.pair_slopes(spark.createDataFrame(rows, f"g string, pair_id long, {cols}"), years)
    got = trend.group_verdicts(pairs, "g", years)
    assert set(got) == {"same", "near", "far", "few", "none"}
    for g, v in got.items():
        s = trend.select_parallel(pairs.where(F.col("g") == g), years, TrendConfig())
        assert (v.compliant, v.n_selected) == (s.compliant, s.n_selected), g
    assert got["same"].compliant and not got["far"].compliant and not got["none"].compliant


def test_quantiles_of_many_shares_from_one_sketch(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(0, 1, 3000), np.full(2000, 0.25), rng.exponential(5, 100)])
    df = spark.createDataFrame([(float(x), float(-x)) for x in v], "a double, b double")
    shares = [0.0, 0.01, 0.02, 0.5, 0.98, 0.99, 1.0]
    out, row = with_quantiles(df, ["a", "b"], shares, [F.avg("a").alias("m")], keep=50)
    for c, x in (("a", v), ("b", -v)):
        assert np.allclose(out[c], np.quantile(x, shares), rtol=0, atol=1e-12)
    assert abs(row["m"] - v.mean()) < 1e-12 and exact_quantiles(df, [], [0.5]) == {}


def test_batch_goes_on_after_a_broken_source(spark, tmp_path):
    import json

    from terrapair.operators import carbon

    points = spark.createDataFrame([(r, c, "control" if r < 4 else "project", float(c), float(r), 30.0 * c, -30.0 * r) for r in range(8) for c in range(10)], "grid_row int, grid_col int, side string, lon double, lat double, x_utm double, y_utm double")
    points = carbon.with_blocks(points, 60.0)
    stock = lambda rate, years: spark.createDataFrame([(r, c, y, 50.0 + (y - 2018) * (rate + (0.5 if r < 4 else 0.0) + 0.01 * c)) for r in range(8) for c in range(10) for y in years], "grid_row int, grid_col int, year int, value double")
    paths = {k: f"{tmp_path}/{k}.parquet" for k in ("good", "better", "short", "broken", "columns", "none")}
    stock(1.0, (2018, 2022, 2024)).write.parquet(paths["good"])
    stock(3.0, (2018, 2022, 2024)).write.parquet(paths["better"])
    stock(1.0, (2018, 2022)).write.parquet(paths["short"])
    stock(1.0, (2018,)).drop("value").write.parquet(paths["columns"])
    with open(paths["broken"], "w") as f:
        f.write("no table")
    out = sweep.run_batch(points, paths, [(2018, 2022), (2018, 2024)], F.lit(0.47), 100.0, f"{tmp_path}/out", store=shared_store(spark))
    got = {(r["source"], r["monitoring_year"]): r for r in out.status.collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        **{(s, y): "done" for s in ("good", "better") for y in (2022, 2024)}, ("short", 2022): "done", ("short", 2024): "missing_end",
        **{(s, y): k for s, k in (("broken", "failed"), ("columns", "failed"), ("none", "missing_table")) for y in (2022, 2024)},
    }
    assert "missing columns" in got["columns", 2022]["error"] and got["broken", 2022]["error"]
    surplus = [r["surplus_period"] for r in out.master.collect()]
    assert len(surplus) == 5 and surplus == sorted(surplus, reverse=True)
    report = json.load(open(f"{tmp_path}/out/broken_2018_2022.json"))
    assert report["status"] == "failed" and len(json.load(open(f"{tmp_path}/out/master.json"))["records"]) == 5
    nothing = sweep.run_batch(points, {"none": paths["none"]}, [(2018, 2022)], F.lit(0.47), 100.0, store=shared_store(spark))
    assert nothing.master.count() == 0 and nothing.status.first()["status"] == "missing_table"


def test_nearest_search_measures_few_pairs(monkeypatch):
    """Balls and the triangle inequality: the same rows as with all pairs, a small share of them measured."""
    import pyarrow as pa

    rng = np.random.default_rng(1)
    centres = rng.normal(size=(40, 5)) * 6
    donors = centres[rng.integers(0, 40, 30_000)] + rng.normal(size=(30_000, 5)) * 0.5
    donors[:500] = donors[0]  # ties
    donors[500] = np.nan
    asked = np.concatenate([donors[rng.integers(0, 30_000, 300)] + 0.1, donors[:3], np.full((1, 5), np.nan), np.full((1, 5), 1e3)])
    ids = rng.permutation(30_000).astype(np.int64)

    def run(tally=None):
        batch = pa.record_batch([pa.array(np.arange(len(asked))), *[pa.array(asked[:, i].copy()) for i in range(5)]], names=["proj_idx", *[f"z{i}" for i in range(5)]])
        out = pa.Table.from_batches(list(matching._nearest(20, ids, donors, tally)(iter([batch]))))
        rows = sorted(zip(*(out[c].to_pylist() for c in ("proj_idx", "rank", "donor_idx", "distance"))))
        return [r for r in rows if np.isfinite(asked[r[0]]).all()]

    tally = []
    found = run(tally)
    finite = [t for t in tally if t[0] < t[1]]
    assert sum(a for a, _ in finite) < 0.25 * sum(b for _, b in finite) and len(finite) > 10
    monkeypatch.setattr(matching, "BALL", 1 << 40)
    assert run() == found and len(found) == 304 * 20


def test_raster_round_trip(spark, tmp_path):
    """Written by tasks, read back by its own header; overviews hold means."""
    import struct

    from terrapair.config import Grid
    from terrapair.sources import geotiff, geotiff_sink

    grid, rng = Grid(x0=1000.0, y0=9000.0), random.Random(3)
    cells = {(rng.randrange(150), rng.randrange(90)): (rng.uniform(-5, 5), float(i)) for i in range(900)} | {(149, 200): (1.5, 2.5)}
    df = spark.createDataFrame([(*k, *v) for k, v in cells.items()] + [(0, 3, None, 1.0), (0, 4, float("nan"), 1.0)], "grid_row int, grid_col int, NDVI_t0 double, n double")
    cells = {k: v for k, v in cells.items() if k not in ((0, 3), (0, 4))}
    df = df.where("not (grid_row = 0 and grid_col in (3, 4)) or n = 1.0")
    path = f"{tmp_path}/deep/r.tif"
    geotiff_sink.save_raster(df.repartition(5), path, grid, ["NDVI_t0", "n"], tile=64, overviews=2)
    assert [p.name for p in (tmp_path / "deep").iterdir()] == ["r.tif"]
    spark.dataSource.register(geotiff.GeoTiffSource)
    for back in (spark.read.format("cells").option("path", path).option("blockRows", 40).load(), geotiff.load_files(spark, path)):
        assert {(r["grid_row"], r["grid_col"]): (r["NDVI_t0"], r["n"]) for r in back.collect()} == cells
    with open(path, "rb") as f:
        h = geotiff.read_header(f)
        assert h.size == (150, 201) and h.transform == (1000.0, 9000.0, 30.0, 30.0) and h.names == ["NDVI_t0", "n"]
        raw = open(path, "rb").read()
        place, sizes = struct.unpack_from("<Q", raw, 8)[0], []
        while place:
            n = struct.unpack_from("<Q", raw, place)[0]
            tags = {struct.unpack_from("<H", raw, place + 8 + 20 * i)[0]: struct.unpack_from("<I", raw, place + 8 + 20 * i + 12)[0] for i in range(n)}
            sizes.append((tags[257], tags[256], tags[254]))
            place = struct.unpack_from("<Q", raw, place + 8 + 20 * n)[0]
        assert sizes == [(150, 201, 0), (75, 101, 1), (38, 51, 1)]
    small = {(r["level"], r["tr"], r["tc"]) for r in geotiff_sink.tiles(df, ["n"], 64, 2).select("level", "tr", "tc").collect()}
    assert (2, 0, 0) in small and (0, 2, 3) in small
    geotiff_sink.save_raster(df.limit(0), f"{tmp_path}/none.tif", grid, ["n"])
    assert geotiff.load_files(spark, f"{tmp_path}/none.tif").count() == 0


def test_rasters_by_ranges(spark, tmp_path):
    """One file is several tasks, its content is no column of the plan; whole values give the same rows."""
    from terrapair.config import Grid
    from terrapair.sources import geotiff, geotiff_sink, stores

    df = spark.range(300 * 40).selectExpr("cast(id div 40 as int) grid_row", "cast(id % 40 as int) grid_col", "cast(id as double) v")
    for name, rows in (("a", 300), ("b", 10)):
        geotiff_sink.save_raster(df.where(f"grid_row < {rows}"), f"{tmp_path}/t/{name}.tif", Grid(x0=0.0, y0=9000.0), ["v"], tile=16)
    spark.range(3).write.parquet(f"{tmp_path}/t/other")
    path = f"file://{tmp_path}/t"
    assert stores.seekable(spark.createDataFrame([(f"file:{tmp_path}/t/a.tif",), ("/x/y.tif",)], "path string"))
    assert not stores.seekable(spark.createDataFrame([("nosuchstore://x/y.tif",)], "path string"))
    cut = geotiff.load_files(spark, path, part_bytes=64 * 40 * 8)
    tasks = [n for n in cut.groupBy(F.spark_partition_id()).count().toPandas()["count"]]
    assert len(tasks) > 2 and max(tasks) < 300 * 40
    assert "content" not in cut._jdf.queryExecution().executedPlan().toString()
    want = sorted((t, i // 40, i % 40, float(i)) for t, rows in (("a", 300), ("b", 10)) for i in range(rows * 40))
    assert sorted(tuple(r) for r in cut.collect()) == want
    assert sorted(tuple(r) for r in geotiff.load_files(spark, path, ranges=False).collect()) == want
    spark.dataSource.register(geotiff.GeoTiffSource)
    assert spark.read.format("cells").option("path", f"{path}/a.tif").option("blockRows", 50).load().count() == 300 * 40
    assert geotiff.load_files(spark, path, "*.tiff").count() == 0


def test_wide_rasters_by_tiles(spark, tmp_path, monkeypatch):
    """A row of tiles is never held whole, lists of tiles stay in the file, and a shared empty tile is decoded once."""
    import tracemalloc

    from terrapair.config import Grid
    from terrapair.sources import geotiff, geotiff_sink

    df = spark.createDataFrame([(i, i * 2000, float(i)) for i in range(50)], "grid_row int, grid_col int, v double")
    geotiff_sink.save_raster(df, f"{tmp_path}/w.tif", Grid(x0=0.0, y0=9000.0), ["v"], tile=16, overviews=1)
    decoded, unpack = [], geotiff._unpack
    monkeypatch.setattr(geotiff, "_unpack", lambda *a: decoded.append(1) or unpack(*a))
    with open(f"{tmp_path}/w.tif", "rb") as f:
        tracemalloc.start()
        h = geotiff.read_header(f)
        found = [tuple(r.values()) for b in geotiff._cells(f, h, 0, 50) for r in b.to_pylist()]
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert sorted(found) == [(i, i * 2000, float(i)) for i in range(50)]
        assert len(decoded) == 51 and most < 3_000_000  # a row of tiles has 16 * 98,016 * 8 bytes
        assert isinstance(h.tags[324], geotiff.Placed)
        rows = geotiff.read_rows(f, h, 3, 5)
        assert rows.shape == (2, 98_001, 1) and rows[0, 6000, 0] == 3.0 and (rows == -9999).sum() == 2 * 98_001 - 2
