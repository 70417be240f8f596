"""What grows with the data is neither broadcast nor gathered in one task."""

import collections
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrapair.config import Grid
from terrapair.operators import polygons
from terrapair.plans import catalog
from terrapair.plans.pipeline import shared_store
from terrapair.sources import geotiff, geotiff_sink, shapefile

GRID = Grid(x0=300.0, y0=9000.0)


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_polygons_are_not_broadcast(spark):
    """Edges of stored corners, and the layer with its attributes read back, which is read once."""
    store = shared_store(spark)
    cells = spark.createDataFrame([(r, c) for r in range(9) for c in range(9) if (r * c) % 4 != 1], "grid_row int, grid_col int")
    edges = polygons.to_edges(store(polygons.mask_polygons(cells, GRID, store)), "part")
    assert "Broadcast" not in executed(edges)
    ends = [(r["poly_id"], r["ring_id"], r["edge_id"], r["x1"], r["y1"]) for r in edges.collect()]
    starts = {(r["poly_id"], r["ring_id"], r["edge_id"]): (r["x0"], r["y0"]) for r in edges.collect()}
    assert all(starts.get((p, k, e + 1), starts[p, k, 0]) == (x, y) for p, k, e, x, y in ends) and len(starts) == len(ends) > 20
    plan = executed(catalog.QUERIES["shapefile_round_trip"](spark, "/root/testdata/sf0.001"))
    assert "Broadcast" not in plan and plan.count("_edge_stretches(") == 1 and "BatchScan" not in plan


def test_failed_shapefile_leaves_no_file(spark, tmp_path):
    edges = spark.createDataFrame([(1, 0, i, 1.0 * i, 2.0 * (i % 2), 0.0, 0.0) for i in range(4)], shapefile.EDGES)
    bad = edges.withColumn("x0", F.when(F.col("edge_id") == 3, F.raise_error(F.lit("bad"))).otherwise(F.col("x0")))
    with pytest.raises(Exception, match="bad"):
        shapefile.save_edges(bad, f"{tmp_path}/a/b.shp")
    assert not list(tmp_path.glob("**/*.*"))
    shapefile.save_edges(edges, f"{tmp_path}/a/b.shp", mode="append")
    with pytest.raises(FileExistsError):
        shapefile.save_edges(edges, f"{tmp_path}/a/b.shp", mode="append")
    assert sorted(x.name for x in tmp_path.glob("a/*")) == ["b.dbf", "b.shp", "b.shx"]


def test_stretches_hold_what_is_there(tmp_path, spark):
    """A wide raster with few tiles is one stretch, however many places it has; full ones are cut by their tiles."""
    df = spark.range(40).selectExpr("cast(id * 16 as int) grid_row", "cast(id * 4000 as int) grid_col", "cast(id as double) v")
    geotiff_sink.save_raster(df, f"{tmp_path}/r.tif", GRID, ["v"], tile=16)
    paths = [pa.record_batch([pa.array([f"{tmp_path}/r.tif"])], names=["path"])]
    cut = lambda size: [b.select(["first", "last"]).to_pylist() for b in geotiff._planned(size)(iter(paths))][0]
    assert cut(1 << 20) == [{"first": 0, "last": 625}]
    some = cut(16 * 16 * 8 * 7)
    assert len(some) == 14 and some[0] == {"first": 0, "last": 48} and all(a["last"] == b["first"] for a, b in zip(some, some[1:]))
    assert sorted((r["grid_row"], r["grid_col"], r["v"]) for r in geotiff.load_files(spark, f"{tmp_path}/r.tif").collect()) == [(i * 16, i * 4000, float(i)) for i in range(40)]


def test_overviews_come_with_their_tiles(spark, tmp_path, monkeypatch):
    """Means of every level, in blocks and beyond them; a table of cells is gone through once, and what is no place is refused."""
    rng = random.Random(1)
    cells = {(rng.randrange(90), rng.randrange(200)): rng.choice([None, float(rng.randrange(9))]) for _ in range(3000)}
    df = spark.createDataFrame([(r, c, v) for (r, c), v in cells.items()] + [(r, c, -1.0) for (r, c), v in cells.items() if v == 8], "grid_row int, grid_col int, v double")
    for block in (1024, 32):
        monkeypatch.setattr(geotiff_sink, "BLOCK", block)
        out = geotiff_sink.tiles(df, ["v"], 16, 2)
        got = {}
        for t in out.collect():
            x = np.frombuffer(zlib.decompress(t["data"])).reshape(16, 16)
            got |= {(t["level"], t["tr"] * 16 + i, t["tc"] * 16 + j): x[i, j] for i, j in zip(*np.nonzero(x != geotiff_sink.NODATA))}
        want = collections.defaultdict(list)
        for (r, c), v in cells.items():
            for k in range(3 if v is not None else 0):
                want[k, r >> k, c >> k].append(v)
        assert got.keys() == want.keys() and all(abs(got[k] - sum(v) / len(v)) < 1e-12 for k, v in want.items())
        if block == 1024:
            assert executed(out).count("Exchange") == 2
    bad = df.union(spark.createDataFrame([(-1, 3, 1.0)], df.schema)), df.union(spark.createDataFrame([(None, 3, 1.0)], df.schema))
    for some in bad:
        with pytest.raises(ValueError, match="count from 0"):
            geotiff_sink.save_raster(some, f"{tmp_path}/x/bad.tif", GRID, ["v"], tile=16, overviews=2)
    assert not list((tmp_path / "x").iterdir())
