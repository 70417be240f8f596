"""Neighbours of cells over blocks, against plain loops, with blocks that split the cells."""

import math
import random

import pytest

from terrapair.config import Grid
from terrapair.operators import raster

GRID = Grid(x0=0.0, y0=300.0)


@pytest.mark.parametrize("reach", [1, 3])
def test_morphology_in_blocks(spark, monkeypatch, reach):
    monkeypatch.setattr(raster, "BLOCK", 5)
    rng = random.Random(reach)
    have = {(rng.randrange(-20, 40), rng.randrange(-20, 40)) for _ in range(500)} | {(900, -900)}
    cells = spark.createDataFrame([*have, *list(have)[:50]], "grid_row int, grid_col int")
    near = [(a, b) for a in range(-reach, reach + 1) for b in range(-reach, reach + 1)]
    grown = lambda s: {(r + a, c + b) for r, c in s for a, b in near}
    shrunk = lambda s: {(r, c) for r, c in s if all((r + a, c + b) in s for a, b in near)}
    for got, want in ((raster.dilate(cells, reach), grown(have)), (raster.close(cells, reach), shrunk(grown(have))), (raster.erode(cells, reach), shrunk(have))):
        found = [tuple(r) for r in got.collect()]
        assert len(found) == len(set(found)) and set(found) == want
    plan = raster.close(cells, reach)._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapGroupsInPandas" in plan and plan.count("Generate") == 2  # a cell is repeated for blocks, not for neighbours


def test_slope_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(raster, "BLOCK", 4)
    rng = random.Random(2)
    v = {(r, c): rng.choice([None, 3.0, 8.0, 100.0]) if rng.random() < 0.2 else rng.uniform(0, 50) for r in range(-6, 15) for c in range(30) if rng.random() < 0.97}
    df = spark.createDataFrame([(*k, x, "kept") for k, x in v.items()], "grid_row int, grid_col int, elevation double, other string")
    got = {(r["grid_row"], r["grid_col"]): r["slope_deg"] for r in raster.terrain_slope(df, GRID).where("other = 'kept'").collect()}
    assert set(got) == set(v)
    for (r, c), slope in got.items():
        n = {(a, b): v.get((r + a, c + b)) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)}
        if any(x is None for x in n.values()):
            assert slope is None
            continue
        gx = sum(x * b * (2 - abs(a)) for (a, b), x in n.items()) / (8 * GRID.dx)
        gy = sum(x * -a * (2 - abs(b)) for (a, b), x in n.items()) / (8 * GRID.dy)
        assert slope == pytest.approx(math.degrees(math.atan(math.hypot(gx, gy))))
    assert sum(x is not None for x in got.values()) > 50


def test_polygons_over_blocks(spark, monkeypatch):
    """Parts within blocks and parts over many give the polygons and components of one block that holds all."""
    from terrapair.operators import polygons
    from terrapair.plans.pipeline import shared_store

    rng = random.Random(8)
    have = {(r, c) for r in range(33) for c in range(33) if rng.random() < 0.5} | {(39, c) for c in range(20)} | {(r, 47) for r in range(17)}
    df, store = spark.createDataFrame(sorted(have), "grid_row int, grid_col int"), shared_store(spark)
    seen = []
    for side, wide in ((512, False), (7, True)):
        monkeypatch.setattr(raster, "BLOCK", side)
        found = raster.connected(df, store)
        assert bool(found.where("not inner").count()) == wide and found.where("inner").count()
        labels = [sorted(tuple(r) for r in raster.components(df, store, diagonal=d).collect()) for d in (False, True)]
        seen.append((sorted(tuple(r) for r in polygons.mask_polygons(df, GRID, store).collect()), labels))
    assert seen[0] == seen[1]


def test_finished_rings_leave(spark, tmp_path):
    """A long ring doesn't keep the rows of short ones in its rounds."""
    from terrapair.operators import polygons
    from terrapair.plans.pipeline import shared_store

    rows = [(4 * k + i, 4 * k + (i + 1) % 4) for k in range(500) for i in range(4)] + [(5000 + i, 5000 + (i + 1) % 300) for i in range(300)]
    sizes, keep = [], shared_store(spark)

    def store(df):
        out = keep(df)
        sizes.append(out.count())
        return out

    assert polygons.ring_order(spark.createDataFrame(rows, "seg long, next long"), store).count() == 2300
    assert len(sizes) >= 8 and sizes[5] <= 300


def test_only_reached_blocks_are_measured(spark, monkeypatch):
    """Cells far from all sources are in no group, and far from a project's box they don't leave the scan."""
    from terrapair.operators import scenes

    made = raster._block_distances

    def strict(*args):
        near = made(*args)

        def run(key, there, asked):
            if not len(there):
                raise AssertionError("a block without sources was measured")
            return near(key, there, asked)

        return run

    monkeypatch.setattr(raster, "_block_distances", strict)
    project = [(r, c) for r in range(3) for c in range(3)]
    cells = project + [(r, c) for r in range(20) for c in range(20)] + [(r, 5000) for r in range(0, 5000, 50)]
    df, p = (spark.createDataFrame(x, "grid_row int, grid_col int") for x in (cells, project))
    found = {(r[0], r[1]): r[2] for r in raster.distance_to_cells(df, p, GRID, 150.0, 8).collect()}
    assert set(found) == set(cells) and found[0, 5000] is None and found[0, 4] == 60.0 and found[0, 0] == 0.0
    ring = scenes.donor_ring(df, p, GRID, None, {}, 0.15, 0.03)
    want = {(r, c) for r in range(20) for c in range(20) if 30 < math.hypot(max(r - 2, 0), max(c - 2, 0)) * 30 <= 150}
    assert {(r["grid_row"], r["grid_col"]) for r in ring.collect()} == want
    assert "grid_col#" in (plan := ring._jdf.queryExecution().optimizedPlan().toString()) and "<= 8" in plan
    assert scenes.donor_ring(df, p.limit(0), GRID, None, {}, 0.15, 0.03).count() == 0


def test_masks_meet_the_rows_in_one_exchange(spark, monkeypatch):
    """Both masks over one deal of the rows; rows beyond the first few decide where those are all masked."""
    from terrapair.config import ExtractConfig
    from terrapair.operators import extract

    monkeypatch.setattr(extract, "PROBE", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = spark.range(400).selectExpr("id", "cast(id div 20 as int) r", "cast(id % 20 as int) c").selectExpr("id", "15D + c * 30 as x_utm", "285D - r * 30 as y_utm")
        cell = lambda where: df.where(where).selectExpr("cast(id div 20 as int) mask_row", "cast(id % 20 as int) mask_col")
        kept = extract.apply_masks(df, "donor", GRID, cell("id % 3 = 0"), cell("id >= 100"), ExtractConfig())
        assert sorted(r["id"] for r in kept.collect()) == [i for i in range(100, 400) if i % 3]
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning(mask_row") == 3
        with pytest.raises(ValueError):
            extract.apply_masks(df, "donor", GRID, cell("true"), cell("id >= 100"), ExtractConfig())
        with pytest.raises(ValueError):
            extract.apply_masks(df.limit(0), "project", GRID, None, None, ExtractConfig())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
