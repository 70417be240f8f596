"""Masks to polygons, shapefiles, validity repair, simplification and buffers."""

import collections
import random
import struct

import numpy as np
import pytest

from terrapair.config import Grid
from terrapair.operators import polygons, raster
from terrapair.plans.pipeline import shared_store
from terrapair.sources import shapefile, tables

GRID = Grid(x0=300.0, y0=9000.0)


def mask():
    rng = random.Random(3)
    cells = {(r, c) for r in range(12) for c in range(12) if rng.random() < 0.6}
    cells |= {(20, c) for c in range(20, 26)} | {(25, c) for c in range(20, 26)} | {(r, 20) for r in range(20, 26)} | {(r, 25) for r in range(20, 26)}
    return cells | {(22, 22), (22, 23), (23, 23), (-3, -4)}


def four_connected(cells):
    left, out = set(cells), []
    while left:
        todo = [left.pop()]
        one = set(todo)
        while todo:
            r, c = todo.pop()
            for n in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                if n in left:
                    left.remove(n)
                    one.add(n)
                    todo.append(n)
        out.append(one)
    return out


def burned(edges):
    return {tuple(r) for r in raster.rasterize(edges, GRID).collect()}


@pytest.fixture(scope="module")
def vertices(spark):
    store = shared_store(spark)
    df = spark.createDataFrame([*sorted(mask()), (None, 1), (2, None), (-3, -4)], "grid_row int, grid_col int")
    return store(polygons.mask_polygons(df, GRID, store))


def test_mask_polygons_burn_back_to_the_mask(spark, vertices):
    assert burned(polygons.to_edges(vertices, "part")) == mask()
    text = polygons.polygon_wkt(vertices)
    assert burned(tables.edges_from_wkt(text, "wkt", "component").withColumnRenamed("component", "poly_id")) == mask()


def test_rings_of_a_mask(vertices):
    """A shell for each 4-connected part, a hole for each region it encloses, areas by the shoelace formula."""
    parts = four_connected(mask())
    box = {(r, c) for r in range(-6, 30) for c in range(-6, 30)}
    want = sorted((min(p), len(four_connected(box - p)) - 1, 900.0 * len(p)) for p in parts)
    seen = collections.defaultdict(lambda: [0, 0.0, 0])
    for r in polygons.ring_areas(vertices, "part").collect():
        x = seen[r["part"]]
        x[0] += r["hole"]
        x[1] += -r["area_m2"] if r["hole"] else r["area_m2"]
        x[2] += not r["hole"]
    assert sorted((x[0], x[1]) for x in seen.values()) == sorted((h, a) for _, h, a in want)
    assert all(x[2] == 1 for x in seen.values())
    corners = [(r["ring"], r["x"], r["y"]) for r in vertices.collect()]
    assert len(set(corners)) == len(corners)


def test_no_cells_no_polygons(spark):
    store = shared_store(spark)
    assert polygons.mask_polygons(spark.createDataFrame([], "grid_row int, grid_col int"), GRID, store).count() == 0


def test_ring_order(spark):
    sizes = (1, 2, 3, 7, 64, 100)
    rng, rows, want, at = random.Random(1), [], {}, 0
    for n in sizes:
        ids = [at + i for i in range(n)]
        rng.shuffle(ids)
        least = ids.index(min(ids))
        for i, s in enumerate(ids):
            rows.append((s, ids[(i + 1) % n]))
            want[s] = (min(ids), (i - least) % n)
        at += n
    out = polygons.ring_order(spark.createDataFrame(rows, "seg long, next long"), shared_store(spark)).collect()
    assert {r["seg"]: (r["ring"], r["pos"]) for r in out} == want


def written(path, records):
    """A shapefile by the format's description; records: None (null shape) or a list of rings."""
    bodies = []
    for rings in records:
        if rings is None:
            bodies.append(struct.pack("<i", 0))
            continue
        points = [p for r in rings for p in r]
        first = [sum(map(len, rings[:i])) for i in range(len(rings))]
        box = [f(p[k] for p in points) if points else 0.0 for f in (min, max) for k in (0, 1)]
        bodies.append(struct.pack("<i4d2i", 5, *box, len(rings), len(points)) + struct.pack(f"<{len(first)}i", *first) + b"".join(struct.pack("<2d", *p) for p in points))
    head = lambda n: struct.pack(">7i", 9994, 0, 0, 0, 0, 0, n // 2) + struct.pack("<2i8d", 1000, 5, *[0.0] * 8)
    shp, shx = b"", b""
    for i, b in enumerate(bodies):
        shx += struct.pack(">2i", (100 + len(shp)) // 2, len(b) // 2)
        shp += struct.pack(">2i", i + 1, len(b) // 2) + b
    for kind, body in (("shp", shp), ("shx", shx)):
        with open(f"{path}.{kind}", "wb") as f:
            f.write(head(100 + len(body)) + body)


def square(x, y, n, clockwise=True):
    p = [(x, y), (x, y + n), (x + n, y + n), (x + n, y), (x, y)]
    return p if clockwise else p[::-1]


def test_shapefile_source(spark, tmp_path):
    records = [[square(0.0, 0.0, 10.0), square(2.0, 2.0, 3.0, False)], None, [[]], [square(50.0, 50.0, 5.0)], [square(100.0 + i, 7.0, 1.0) for i in range(30)]]
    written(f"{tmp_path}/a", records)
    spark.dataSource.register(shapefile.ShapefileSource)
    split = spark.read.format("shapefile").option("splitBytes", 100).load(f"{tmp_path}/a.shp")
    assert split.rdd.getNumPartitions() > 2
    rows = sorted(tuple(r) for r in split.collect())
    want = sorted((i, k, j, *a, *b) for i, rings in enumerate(records) if rings for k, r in enumerate(rings) for j, (a, b) in enumerate(zip(r, r[1:])))
    assert rows == want
    for ranges in (True, False, None):
        assert sorted(tuple(r) for r in shapefile.load_edges(spark, f"file://{tmp_path}/a.shp", ranges).collect()) == want
    area = {r["poly_id"]: r["area_ha"] * 1e4 for r in raster.polygon_area_ha(split).collect()}
    assert area == pytest.approx({0: 91.0, 3: 25.0, 4: 30.0})
    written(f"{tmp_path}/none", [])
    assert spark.read.format("shapefile").load(f"{tmp_path}/none.shp").count() == 0


def test_shapefile_round_trip(spark, vertices, tmp_path):
    edges = polygons.to_edges(vertices, "part")
    shapefile.save_edges(edges, f"{tmp_path}/out/mask.shp", "EPSG:32734")
    names = sorted(p.name for p in (tmp_path / "out").iterdir())
    assert names == ["mask.dbf", "mask.prj", "mask.shp", "mask.shx"]
    back = shapefile.load_mask(spark, f"{tmp_path}/out/mask.shp", "EPSG:32734")
    assert burned(back) == mask()
    ids = {int(r["values"]["POLY_ID"]) for r in shapefile.load_attributes(spark, f"{tmp_path}/out/mask.shp").collect()}
    assert ids == {r["part"] for r in vertices.collect()}
    shapefile.save_edges(edges.limit(0), f"{tmp_path}/out/empty.shp", "EPSG:4326")
    assert shapefile.load_edges(spark, f"{tmp_path}/out/empty.shp").count() == 0
    assert shapefile.read_crs(spark, f"{tmp_path}/out/empty.shp") == "EPSG:4326"


def test_projection_files(spark, tmp_path):
    for crs in ("EPSG:4326", "EPSG:32734", "EPSG:32601"):
        assert shapefile.crs_of(shapefile.projection_text(crs)) == crs
    assert shapefile.crs_of('PROJCS["x",PROJECTION["Transverse_Mercator"],PARAMETER["False_Northing",10000000],PARAMETER["Central_Meridian",21],PARAMETER["Scale_Factor",0.9996]]') == "EPSG:32734"
    assert shapefile.crs_of('PROJCS["other"]') is None
    written(f"{tmp_path}/a", [[square(500000.0, 7000000.0, 1000.0)]])
    with pytest.raises(ValueError):
        shapefile.load_mask(spark, f"{tmp_path}/a.shp", "EPSG:32734")
    there = shapefile.load_mask(spark, f"{tmp_path}/a.shp", "EPSG:4326", "EPSG:32734")
    again = shapefile.reproject(shapefile.reproject(there, "EPSG:4326", "EPSG:3857"), "EPSG:3857", "EPSG:32734").collect()
    first = shapefile.load_edges(spark, f"{tmp_path}/a.shp").collect()
    assert np.allclose([tuple(r) for r in sorted(again)], [tuple(r) for r in sorted(first)], atol=1e-3)
    assert abs(there.agg({"x0": "min"}).first()[0] - 21.0) < 1e-9


def closed(poly, ring, points):
    return [(poly, ring, i, *a, *b) for i, (a, b) in enumerate(zip(points, points[1:] + points[:1]))]


def cross(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def crossing(p, q):
    """Do two edges meet anywhere but in a common end?"""
    if {p[:2], p[2:]} & {q[:2], q[2:]}:
        return False
    a, b, c, d = cross(p[:2], p[2:], q[:2]), cross(p[:2], p[2:], q[2:]), cross(q[:2], q[2:], p[:2]), cross(q[:2], q[2:], p[2:])
    return a * b < -1e-3 and c * d < -1e-3


EDGES = "poly_id long, ring_id int, edge_id int, x0 double, y0 double, x1 double, y1 double"


def broken():
    rng = random.Random(8)
    bow = closed(1, 0, [(0.0, 0.0), (200.0, 200.0), (200.0, 0.0), (0.0, 200.0)])
    over = closed(2, 0, [(0.0, 0.0), (300.0, 0.0), (300.0, 300.0), (0.0, 300.0)]) + closed(2, 1, [(150.0, 150.0), (450.0, 150.0), (450.0, 450.0), (150.0, 450.0)])
    spike = closed(3, 0, [(0.0, 0.0), (100.0, 0.0), (100.0, 100.0), (100.0, 260.0), (100.0, 100.0), (0.0, 100.0)])
    touch = closed(4, 0, [(0.0, 0.0), (300.0, 0.0), (300.0, 300.0), (0.0, 300.0)]) + closed(4, 1, [(0.0, 0.0), (100.0, 200.0), (200.0, 100.0)])
    same = closed(5, 0, [(0.0, 0.0), (90.0, 0.0), (90.0, 90.0)]) + closed(5, 1, [(90.0, 90.0), (90.0, 0.0), (0.0, 0.0)])
    star = [r for k in range(6, 12) for r in closed(k, 0, [(float(rng.randint(0, 600)), float(rng.randint(0, 600))) for _ in range(k + 3)])]
    nested = closed(20, 0, [(0.0, 0.0), (400.0, 0.0), (400.0, 400.0), (0.0, 400.0)]) + closed(20, 1, [(50.0, 50.0), (350.0, 50.0), (350.0, 350.0), (50.0, 350.0)]) + closed(20, 2, [(100.0, 100.0), (300.0, 100.0), (300.0, 300.0), (100.0, 300.0)])
    odd = [(1, 9, 0, 5.0, 5.0, 5.0, 5.0), (2, 9, 0, None, 1.0, 2.0, 2.0), (2, 9, 1, float("nan"), 1.0, 2.0, 2.0)]
    return bow + over + spike + touch + same + star + nested + odd


def test_repair_keeps_the_interior(spark):
    """The cells inside by the even-odd rule stay; rings don't cross; shells are counter-clockwise."""
    from terrapair.operators import validity

    df = spark.createDataFrame(broken(), EDGES)
    store = shared_store(spark)
    out = store(validity.repair(df, store))
    fine = Grid(x0=-3.3, y0=703.7, dx=7.0, dy=7.0)
    spans = lambda e: {(r["poly_id"], r["grid_row"], c) for r in raster.edge_spans(e, fine).collect() for c in range(r["col_start"], r["col_end"] + 1)}
    assert spans(out) == spans(df.where("x0 is not null and not isnan(x0)"))
    rows = [tuple(r) for r in out.collect()]
    by = collections.defaultdict(list)
    for r in rows:
        by[r[0], r[1]].append(r[2:])
    area = collections.Counter()
    for (poly, _), ring in by.items():
        ring.sort()
        assert [r[0] for r in ring] == list(range(len(ring))) and all(a[3:] == b[1:3] for a, b in zip(ring, ring[1:] + ring[:1]))
        assert len({r[1:3] for r in ring}) == len(ring)
        area[poly] += sum(r[1] * r[4] - r[3] * r[2] for r in ring) / 2
    for poly in {r[0] for r in rows}:
        mine = [r[3:] for r in rows if r[0] == poly]
        assert not any(crossing(a, b) for i, a in enumerate(mine) for b in mine[:i])
    assert (area[1], area[2], area[3], area[20]) == (20000.0, 2 * 90000.0 - 2 * 150.0**2, 10000.0, 160000.0 - 90000.0 + 40000.0)
    assert area[4] == 90000.0 - 15000.0 and 5 not in area
    assert len({k for k in by if k[0] == 1}) == 2 and len({k for k in by if k[0] == 4}) == 2 and len({k for k in by if k[0] == 20}) == 3


def test_shapefile_in_pieces(spark, tmp_path, monkeypatch):
    """Index, records and attributes in small pieces give the same layer; a part's message doesn't grow with its records."""
    import pickle

    rows = [(i * 7, 0, j, *p, *q) for i in range(400) for j, (p, q) in enumerate(zip(square(i * 9.0, 0.0, 1.0 + i % 5), square(i * 9.0, 0.0, 1.0 + i % 5)[1:]))]
    edges = spark.createDataFrame(rows, EDGES)
    shapefile.save_edges(edges, f"{tmp_path}/a", "EPSG:32734")
    whole = [sorted(tuple(r) for r in shapefile.load_edges(spark, f"{tmp_path}/a").collect()), {r[0]: r[1] for r in shapefile.load_attributes(spark, f"{tmp_path}/a", False).collect()}]
    assert len(whole[0]) == len(rows) and [whole[1][i]["POLY_ID"] for i in range(400)] == [str(i * 7) for i in range(400)]
    monkeypatch.setattr(shapefile, "INDEX_PIECE", 160)
    monkeypatch.setattr(shapefile, "ATTRIBUTE_ROWS", 64)
    cut = shapefile._Reader(f"{tmp_path}/a", 1000).partitions()
    assert len(cut) > 20 and (cut[0].first, cut[-1].last) == (0, 400) and all(a.last == b.first for a, b in zip(cut, cut[1:]))
    parts = shapefile.load_attributes(spark, f"{tmp_path}/a")
    assert {r[0]: r[1] for r in parts.collect()} == whole[1]
    writer, sizes = shapefile._Writer(f"{tmp_path}/b", "", True), []
    for some in (rows[:800], rows[800:]):
        sizes.append(writer.write(iter([dict(zip(("poly_id", "ring_id", "edge_id", "x0", "y0", "x1", "y1"), r)) for r in some])))
    assert all(len(pickle.dumps(m)) < 600 for m in sizes)
    writer.commit(sizes[::-1])
    assert sorted(p.name for p in tmp_path.iterdir() if p.name[0] == "b") == ["b.dbf", "b.shp", "b.shx"]
    assert all((tmp_path / f"a.{k}").read_bytes() == (tmp_path / f"b.{k}").read_bytes() for k in ("shp", "shx", "dbf"))


def test_repair_of_nothing(spark):
    from terrapair.operators import validity

    assert validity.repair(spark.createDataFrame([], EDGES), shared_store(spark)).count() == 0


def test_distances_of_a_concave_area(spark):
    """A distance transform over small blocks against all pairs; ring of a buffer less an exclusion."""
    from terrapair.operators import scenes

    grid = Grid(x0=0.0, y0=0.0, dx=30.0, dy=20.0)
    project = {(r, c) for r in range(10, 40) for c in range(10, 16)} | {(r, c) for r in range(34, 40) for c in range(10, 44)} | {(r, 43) for r in range(20, 40)}
    cells = sorted({(r, c) for r in range(-5, 60) for c in range(-7, 60)})
    p, df = spark.createDataFrame(sorted(project), "grid_row int, grid_col int"), spark.createDataFrame(cells, "grid_row int, grid_col int")
    want = {}
    for r, c in cells:
        d = min(((r - a) * 20.0) ** 2 + ((c - b) * 30.0) ** 2 for a, b in project) ** 0.5
        want[r, c] = d if d <= 300.0 else None
    for block in (8, 512):
        out = {(x["grid_row"], x["grid_col"]): x["distance"] for x in raster.distance_to_cells(df, p, grid, 300.0, block).collect()}
        out = {k: out.get(k) for k in want}
        assert {k for k, v in out.items() if v is None} == {k for k, v in want.items() if v is None}
        assert all(v is None or abs(v - want[k]) < 1e-9 for k, v in out.items())
    ring = scenes.donor_ring(df, p, grid, None, {}, 0.3, 0.1).collect()
    assert {(x["grid_row"], x["grid_col"]) for x in ring} == {k for k, v in want.items() if v is not None and v > 100.0}
    assert raster.distance_to_cells(df, p.limit(0), grid, 300.0).where("distance is not null").count() == 0
    assert raster.distance_to_cells(df.limit(0), p, grid, 300.0).count() == 0


def test_simplify_keeps_topology(spark, vertices):
    edges = polygons.to_edges(vertices, "part")
    store = shared_store(spark)
    out = store(polygons.simplify(edges, 45.0, store))
    rows = [tuple(r) for r in out.collect()]
    assert len(rows) < edges.count() and {r[:2] for r in rows} == {(r["poly_id"], r["ring_id"]) for r in edges.collect()}
    corners = {(r["x0"], r["y0"]) for r in edges.collect()}
    by = collections.defaultdict(list)
    for r in rows:
        by[r[:2]].append(r[2:])
        assert r[3:5] in corners
    for ring in by.values():
        ring.sort()
        assert len(ring) >= 3 and all(a[3:] == b[1:3] for a, b in zip(ring, ring[1:] + ring[:1]))
    flat = sorted({min(r[3:], r[5:] + r[3:5]) for r in rows})
    assert not any(crossing(a, b) for i, a in enumerate(flat) for b in flat[:i])
    same = polygons.simplify(edges, 0.0, store)
    assert same.count() == edges.count()


def test_simplify_shared_edges_alike(spark):
    rng = random.Random(4)
    line = [(100.0 + rng.uniform(-8, 8), float(y)) for y in range(0, 301, 10)]
    left = [(0.0, 0.0), *line, (0.0, 300.0)]
    right = [(200.0, 300.0), *line[::-1], (200.0, 0.0)]
    edges = spark.createDataFrame(closed(1, 0, left) + closed(2, 0, right), EDGES)
    store = shared_store(spark)
    rows = [tuple(r) for r in polygons.simplify(edges, 6.0, store).collect()]
    inner = {k: {frozenset((r[3:5], r[5:7])) for r in rows if r[0] == k and 50 < r[3] < 150 and 50 < r[5] < 150} for k in (1, 2)}
    assert inner[1] == inner[2] and 1 <= len(inner[1]) < 20
    # every dropped corner is within the tolerance of the simplified line
    for x, y in line:
        d = min(abs(cross(a, b, (x, y))) / max(1e-9, ((a[0] - b[0]) ** 2 + (a[1] - b[1]) ** 2) ** 0.5) for e in inner[1] for a, b in [sorted(e, key=lambda p: p[1])] if a[1] - 1e-9 <= y <= b[1] + 1e-9)
        assert d <= 6.0 + 1e-6
