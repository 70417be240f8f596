"""Sources, sinks, streaming, and a whole run on a planted grid."""

import json
import random
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapair.config import BaselineConfig, CarbonSpec, Grid, MatchConfig, RunConfig, TrendConfig
from terrapair.operators import extract
from terrapair.plans import pipeline
from terrapair.sources import geotiff, tables
from terrapair.streaming import observations

GRID = Grid(0.0, 3000.0)
YEARS = range(2013, 2018)


def pixel_table(spark, rows, tile):
    names = "grid_row int, grid_col int, lon double, lat double, NDVI_t0 double, NDVI_slope_5yr double, elevation double, slope_deg double, SOC_g_kg double, dist_roads_km double, WRB2_CODE double, " + ", ".join(f"NDVI_{y} double" for y in YEARS)
    return extract.with_geometry(spark.createDataFrame(rows, names).withColumn("source_tile", F.lit(tile)), GRID)


def planted(spark):
    """36 project cells in a corner; a twin with a parallel series for each, and noise donors."""
    rng = random.Random(11)
    project, donors = [], []
    for i in range(36):
        r, c = divmod(i, 6)
        cov = [rng.uniform(0.3, 0.6), rng.uniform(-0.01, 0.01), rng.uniform(100, 900), rng.uniform(0, 9), rng.uniform(10, 20), rng.uniform(0, 3)]
        code = float(rng.choice([2, 3]))
        series = [0.4 + 0.01 * k + rng.uniform(-0.002, 0.002) for k in range(5)]
        project.append((r, c, 20 + c * 1e-3, -17 - r * 1e-3, *cov, code, *series))
        donors.append((r + 20, c, 20 + c * 1e-3, -17.2 - r * 1e-3, *[v + 1e-6 for v in cov], code, *[v - 0.05 + rng.uniform(-0.002, 0.002) for v in series]))
    for i in range(150):
        cov = [rng.uniform(0.3, 0.6), rng.uniform(-0.01, 0.01), rng.uniform(100, 900), rng.uniform(0, 9), rng.uniform(10, 20), rng.uniform(0, 3)]
        donors.append((40 + i // 10, i % 10, 21 + i * 1e-3, -17.4, *cov, float(rng.choice([2, 3, 14])), *[rng.uniform(0.2, 0.6) for _ in range(5)]))
    return pixel_table(spark, project, "p"), pixel_table(spark, donors, "d")


def inputs(spark):
    p, d = planted(spark)
    cells = p.select("grid_row", "grid_col").union(d.select("grid_row", "grid_col")).distinct()
    start = cells.withColumn("value", F.lit(10.0))
    end = cells.withColumn("value", F.when(F.col("grid_row") < 20, 40.0).otherwise(F.lit(16.0) + F.col("grid_col") * 0.6))
    return pipeline.Inputs(p, d, carbon_start=start, carbon_end=end)


CFG = RunConfig(run_id="t", grid=GRID, match=MatchConfig(mode="caliper_first"), trend=TrendConfig(min_pairs=5), carbon=CarbonSpec(units="tC_ha"), baseline=BaselineConfig(), project_area_ha=100.0)


def test_whole_run(spark, tmp_path):
    out = pipeline.run(inputs(spark), RunConfig(**{**CFG.__dict__, "root": str(tmp_path)}))
    pairs = out.pairs.collect()
    assert len(pairs) == 16 and all(r["ref_grid_row"] >= 20 and not r["reuse_exceeded"] for r in pairs)  # the edge of 36 cells is left out
    assert out.selection.compliant and out.manifest["lock_status"] == "LOCKED" and out.manifest["sha256"]
    b = out.baseline.first()
    assert b["project_mean"] == pytest.approx(5.0) and 1.0 <= b["mean"] <= 1.5 and b["surplus_yr"] > 0 and b["period_years"] == 6
    saved = tables.read_json(spark, f"{tmp_path}/t_extfull/manifest.json")
    assert saved["total_ha"] == pytest.approx(out.manifest["total_ha"]) and out.cells.count() == 16
    assert tables.read_json(spark, f"{tmp_path}/none.json") is None


def test_extent_comparison_records_failures(spark):
    c, failed = pipeline.compare_extents(inputs(spark), CFG, ("full", "bad"))
    assert [r["extent"] for r in c.collect()] == ["full"] and failed[0].name == "bad"


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 1.5, float("nan")), (2, None, 2.0)], "a long, b double, c double")
    for kind in ("parquet", "csv"):
        back = tables.load(spark, tables.save(df, f"{tmp_path}/x", kind))
        assert sorted((r["a"], r["b"], r["c"]) for r in back.collect()) == [(1, 1.5, None), (2, None, 2.0)]
    assert tables.find(spark, str(tmp_path), "x").endswith("x.parquet") and tables.find(spark, str(tmp_path), "y") is None
    tables.write_json(spark, f"{tmp_path}/m.json", {"a": 1})
    assert json.load(open(f"{tmp_path}/m.json")) == {"a": 1}
    assert tables.checksums(spark, str(tmp_path), "m.json").first()["length"] == len('{\n  "a": 1\n}')
    tables.remove(spark, f"{tmp_path}/m.json")
    assert not tables.exists(spark, f"{tmp_path}/m.json")
    assert tables.resolve_band(["AGB", "b"], "agb") == "AGB" and tables.resolve_band(["AGB", "b"], None, 2) == "b"
    with pytest.raises(ValueError):
        tables.resolve_band(["a"], "x")


def test_tiles(spark, tmp_path):
    p, _ = planted(spark)
    p.coalesce(1).write.parquet(f"{tmp_path}/a/one")
    p.withColumn("extra", F.lit(1)).coalesce(1).write.parquet(f"{tmp_path}/b/two")
    found = tables.find_tiles(spark, [str(tmp_path), f"{tmp_path}/a", f"{tmp_path}/none"], "*.parquet")
    assert len(found) == 2 and found == sorted(found)
    both = tables.load_tiles(spark, [f"{tmp_path}/a/one", f"{tmp_path}/b/two"])
    assert both.count() == 36 and "extra" in both.columns


def lzw(data):
    """Encoder by the specification: a code of the longest known string, one code early to the next width."""
    start = {bytes([i]): i for i in range(256)}
    table, width, out, omega = dict(start), 9, [(256, 9)], b""
    for byte in data:
        more = omega + bytes([byte])
        if more in table:
            omega = more
            continue
        out.append((table[omega], width))
        table[more] = len(table) + 2
        omega = bytes([byte])
        if len(table) + 2 == 4094:
            out.append((256, width))
            table, width = dict(start), 9
        elif len(table) + 2 > (1 << width) - 1:
            width += 1
    if omega:
        out.append((table[omega], width))
        table[b"end"] = len(table) + 2
        width += len(table) + 2 > (1 << width) - 1
    out.append((257, width))
    bits = "".join(f"{c:0{w}b}" for c, w in out)
    return int(bits.ljust(-(-len(bits) // 8) * 8, "0"), 2).to_bytes(-(-len(bits) // 8), "big")


def tiff(path, data, nodata, names, rows_per_strip=3, packed="deflate", predictor=1, big=False):
    """A striped file written by hand from the public specification."""
    h, w, bands = data.shape
    strips = []
    for a in range(0, h, rows_per_strip):
        part = data[a : a + rows_per_strip].astype(">f4" if predictor == 3 else "<f4")
        if predictor == 3:
            planes = part.reshape(len(part), w * bands, 1).view(np.uint8).transpose(0, 2, 1).reshape(len(part), 4 * w, bands)
            part = np.diff(planes.astype(int), axis=1, prepend=0).astype(np.uint8)
        strips.append({"deflate": zlib.compress, "lzw": lzw, "none": bytes}[packed](part.tobytes()))
    meta = ("<GDALMetadata>" + "".join(f'<Item name="DESCRIPTION" sample="{i}" role="description">{n}</Item>' for i, n in enumerate(names)) + "</GDALMetadata>").encode() + b"\0"
    at, offsets = 16 if big else 8, []
    for s in strips:
        offsets.append(at)
        at += len(s)
    place, wide, head = ("Q", 8, 8) if big else ("I", 4, 2)
    tags = [(256, "I", [w]), (257, "I", [h]), (258, "H", [32] * bands), (259, "H", [{"deflate": 8, "lzw": 5, "none": 1}[packed]]), (262, "H", [1]), (273, place, offsets), (277, "H", [bands]), (278, "I", [rows_per_strip]), (279, "I", [len(s) for s in strips]), (284, "H", [1]), (317, "H", [predictor]), (339, "H", [3] * bands), (33550, "d", [30.0, 30.0, 0.0]), (33922, "d", [0, 0, 0, 100.0, 900.0, 0]), (42112, "s", meta), (42113, "s", str(nodata).encode() + b"\0")]
    code = {"H": 3, "I": 4, "d": 12, "s": 2, "Q": 16}
    extra, entries, base = b"", b"", at + head + (4 + 2 * wide) * len(tags) + wide
    for tag, kind, v in tags:
        raw = bytes(v) if kind == "s" else struct.pack(f"<{len(v)}{kind}", *v)
        n = len(raw) if kind == "s" else len(v)
        inline = raw.ljust(wide, b"\0") if len(raw) <= wide else struct.pack(f"<{place}", base + len(extra))
        extra += raw if len(raw) > wide else b""
        entries += struct.pack(f"<HH{place}", tag, code[kind], n) + inline
    with open(path, "wb") as f:
        f.write(b"II" + (struct.pack("<HHHQ", 43, 8, 0, at) if big else struct.pack("<HI", 42, at)))
        f.write(b"".join(strips) + struct.pack("<Q" if big else "<H", len(tags)) + entries + struct.pack(f"<{place}", 0) + extra)


@pytest.mark.parametrize("packed, predictor, big", [("deflate", 1, False), ("none", 1, False), ("lzw", 1, False), ("deflate", 3, False), ("lzw", 3, True), ("none", 1, True)])
def test_geotiff(spark, tmp_path, packed, predictor, big):
    data = np.arange(7 * 5 * 2, dtype=np.float32).reshape(7, 5, 2)
    data[2, 3, 1] = -9999
    data[4, 1, 0] = np.nan
    tiff(f"{tmp_path}/x.tif", data, -9999, ["NDVI_t0", "elevation"], packed=packed, predictor=predictor, big=big)
    spark.dataSource.register(geotiff.GeoTiffSource)
    df = spark.read.format("cells").option("path", f"{tmp_path}/x.tif").option("blockRows", "3").load()
    assert df.columns == ["grid_row", "grid_col", "NDVI_t0", "elevation"]
    got = {(r[0], r[1]): r[2:] for r in df.collect()}
    assert len(got) == 33 and got[(6, 4)] == (68.0, 69.0) and (2, 3) not in got and (4, 1) not in got
    with open(f"{tmp_path}/x.tif", "rb") as f:
        assert geotiff.read_header(f).transform == (100.0, 900.0, 30.0, 30.0)
    tiff(f"{tmp_path}/y.tif", data[:, :, :1], -9999, ["NDVI_t0"])
    both = geotiff.load_files(spark, str(tmp_path))
    assert both.columns == ["source_tile", "grid_row", "grid_col", "NDVI_t0", "elevation"]
    assert {(r[1], r[2]): tuple(r[3:]) for r in both.where("source_tile = 'x'").collect()} == got
    assert both.where("source_tile = 'y' and elevation is null").count() == 34


def test_lzw_round_trip():
    rng = np.random.default_rng(5)
    for raw in (b"", b"a", b"aaaaaaa" * 900, rng.bytes(30_000), bytes(rng.integers(0, 3, 60_000, dtype=np.uint8))):
        assert geotiff._lzw(lzw(raw)) == raw
    with pytest.raises(ValueError):
        geotiff._lzw(b"\x80\x3f\xff\xff")


def test_streaming_equals_batch(spark, tmp_path):
    rows = [(i % 3, f"2024-01-01 00:{i:02d}:00", float(i)) for i in range(40)] + [(0, "2024-01-01 09:00:00", 0.0)]
    df = spark.createDataFrame(rows, "cell int, t string, v double").withColumn("ts", F.to_timestamp("t"))
    df.coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in")
    q = observations.windowed_means(stream, ["cell"], "ts", "v").writeStream.format("memory").queryName("means").outputMode("append").option("checkpointLocation", f"{tmp_path}/ck").start()
    q.processAllAvailable()
    q.stop()
    got = {(r["cell"], r["start"].minute): (r["mean"], r["n"]) for r in spark.table("means").collect()}
    want = {}
    for c, t, v in rows[:-1]:
        want.setdefault((c, int(t[14:16]) // 10 * 10), []).append(v)
    assert got == {k: (sum(v) / len(v), len(v)) for k, v in want.items()}
