"""Polygon shapefiles: a source split by the record index, and a sink whose parts merge at commit.

A layer is a table (poly_id, ring_id, edge_id, x0, y0, x1, y1) of edges, with the record's attributes
on request. The index (.shx) tells where each record lies, so a task reads a stretch of whole records by
offset; files in stores without ranges come as one value each (`load_edges`; the format's
limit is 2 GB a file). Null shapes, shapes without points and rings of fewer than three edges give nothing.

The sink takes (poly_id, ring_id, edge_id, x0, y0, x1, y1) grouped by polygon. Tasks write their records to parts
of their own; the commit numbers them, moves offsets on and joins the parts to .shp, .shx, .dbf and .prj. A
failed write leaves no file.

`load_edges` and `save_edges` do the same in Arrow batches: for a data source of Python the driver keeps two
processes for each of five steps (about 35 MB each), besides its own.
"""

from __future__ import annotations

import io
import os
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

from terrapair.functions import projection
from terrapair.sources import stores

# Fixed values of the format.
FILE_CODE, VERSION, HEADER = 9994, 1000, 100
NULL, POLYGONS = 0, (5, 15, 25)
#: Bytes of records that a task reads at least.
SPLIT = 8 << 20
#: Bytes of an index, or of records, that are held at a time.
INDEX_PIECE = 8 << 20
#: Rows of attributes that a task reads.
ATTRIBUTE_ROWS = 100_000
EDGES = "poly_id long, ring_id int, edge_id int, x0 double, y0 double, x1 double, y1 double"


def read_index(raw: bytes) -> np.ndarray:
    """(offset, bytes of content) of each record, from the index file."""
    if len(raw) < HEADER or struct.unpack(">i", raw[:4])[0] != FILE_CODE:
        raise ValueError("not a shapefile index")
    return _places(raw[HEADER:])


def _places(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw[: len(raw) // 8 * 8], ">i4").astype(np.int64).reshape(-1, 2) * 2


def rings_of(content: bytes) -> list[np.ndarray]:
    """The rings of one record's content, each an array of points."""
    kind = struct.unpack("<i", content[:4])[0]
    if kind == NULL:
        return []
    if kind not in POLYGONS:
        raise ValueError(f"shape type {kind} is no polygon")
    parts, points = struct.unpack("<ii", content[36:44])
    first = np.frombuffer(content, "<i4", parts, 44)
    xy = np.frombuffer(content, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
    ends = np.append(first[1:], points)
    return [xy[a:b] for a, b in zip(first.tolist(), ends.tolist()) if b - a >= 4]


def _edges(records: Iterator[tuple[int, bytes]]) -> Iterator[pa.RecordBatch]:
    cols: list[list[np.ndarray]] = [[] for _ in range(7)]
    held = 0

    def flush() -> pa.RecordBatch:
        kinds = (np.int64, np.int32, np.int32, *(np.float64,) * 4)
        out = pa.record_batch([pa.array(np.concatenate(c).astype(k)) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in EDGES.split(", ")])
        for c in cols:
            c.clear()
        return out

    for poly, content in records:
        for ring, xy in enumerate(rings_of(content)):
            n = len(xy) - 1
            for c, v in zip(cols, (np.full(n, poly), np.full(n, ring), np.arange(n), xy[:-1, 0], xy[:-1, 1], xy[1:, 0], xy[1:, 1])):
                c.append(v)
            held += n
        if held > 50_000:
            yield flush()
            held = 0
    if held:
        yield flush()


@dataclass
class _Stretch(InputPartition):
    first: int
    last: int


class ShapefileSource(DataSource):
    """format("shapefile"): polygons as edges, from a path or URI of any store of `stores`."""

    @classmethod
    def name(cls) -> str:
        return "shapefile"

    def schema(self) -> str:
        return EDGES

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], int(self.options.get("splitBytes", SPLIT)))

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Writer(self.options["path"], self.options.get("crs", ""), overwrite)


def _base(path: str) -> str:
    return re.sub(r"^file:/+", "/", re.sub(r"\.shp$", "", path))


class _Reader(DataSourceReader):
    def __init__(self, path: str, split: int):
        self.base, self.split = _base(path), split

    def partitions(self) -> list[_Stretch]:
        """Stretches of about `split` bytes of records; the index is gone through in pieces."""
        cuts, n, total = [0], 0, 0
        with stores.opened(f"{self.base}.shx") as f:
            read_index(f.read(HEADER))
            while len(raw := f.read(INDEX_PIECE)) >= 8:
                upto = np.cumsum(_places(raw)[:, 1] + 8)
                marks = np.arange(-(-total // self.split) * self.split, total + upto[-1], self.split) - total
                cuts += (n + np.searchsorted(upto, marks)).tolist()
                n, total = n + len(upto), total + int(upto[-1])
        cuts = sorted({*cuts, n})
        return [_Stretch(a, b) for a, b in zip(cuts[:-1], cuts[1:])] or [_Stretch(0, 0)]

    def read(self, part: _Stretch) -> Iterator[pa.RecordBatch]:
        with stores.opened(f"{self.base}.shx") as f:
            f.seek(HEADER + 8 * part.first)
            index = _places(f.read(8 * (part.last - part.first)))

        def records() -> Iterator[tuple[int, bytes]]:
            with stores.opened(f"{self.base}.shp") as f:
                for i, (at, size) in enumerate(index.tolist()):
                    f.seek(at + 8)
                    yield part.first + i, f.read(size)

        yield from _edges(records())


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(poly_id, content) of the records of whole files, by the headers in them."""
    for batch in batches:
        for raw in batch.column(0):
            view = memoryview(raw.as_buffer())
            at, i = HEADER, 0
            while at + 8 <= len(view):
                size = 2 * struct.unpack(">i", view[at + 4 : at + 8])[0]
                yield pa.record_batch([pa.array([i], pa.int64()), pa.array([bytes(view[at + 8 : at + 8 + size])], pa.binary())], names=["poly_id", "content"])
                at, i = at + 8 + size, i + 1


def _planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, first, last): stretches of records of each file."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            parts = _Reader(path, SPLIT).partitions()
            yield pa.record_batch([pa.array([path] * len(parts), pa.string()), pa.array([p.first for p in parts], pa.int64()), pa.array([p.last for p in parts], pa.int64())], names=["path", "first", "last"])


def _edge_stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, first, last in zip(*(x.to_pylist() for x in batch.columns)):
            yield from _Reader(path, SPLIT).read(_Stretch(first, last))


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from _edges(zip(batch.column(0).to_pylist(), (x.as_py() for x in batch.column(1))))


def load_edges(spark: SparkSession, path: str, ranges: bool | None = None) -> DataFrame:
    """The same table from any store that Spark reads.

    With an index, and where the store can be read by ranges (`ranges` overrides that), by stretches of records; else as
    one value, whose records are dealt out before they are parsed.
    """
    from terrapair.sources import tables

    base = re.sub(r"\.shp$", "", path)
    files = spark.read.format("binaryFile").load(f"{base}.shp")
    if ranges is None:
        ranges = tables.exists(spark, f"{base}.shx") and stores.seekable(files)
    if ranges:
        # the path as Spark resolved it, so that both look into the same store
        plan = files.select("path").mapInArrow(_planned, "path string, first long, last long")
        return plan.repartition(max(1, plan.count())).mapInArrow(_edge_stretches, EDGES)
    return files.select("content").mapInArrow(_whole, "poly_id long, content binary").repartition("poly_id").mapInArrow(_parsed, EDGES)


def crs_of(wkt: str) -> str | None:
    """EPSG code of a projection file's text: UTM on WGS 84, web Mercator or geographic; None for others."""
    text = wkt.upper()
    if m := re.search(r"UTM[_ ]ZONE[_ ](\d{1,2})([NS])", text):
        return f"EPSG:{(32600 if m[2] == 'N' else 32700) + int(m[1])}"
    if "MERCATOR_AUXILIARY_SPHERE" in text or "PSEUDO-MERCATOR" in text:
        return "EPSG:3857"
    if text.lstrip().startswith(("GEOGCS", "GEOGCRS")):
        return "EPSG:4326"
    if "TRANSVERSE_MERCATOR" in text and (m := re.search(r'CENTRAL_MERIDIAN"\s*,\s*(-?[\d.]+)', text)) and re.search(r'SCALE_FACTOR"\s*,\s*0?\.9996', text):
        south = re.search(r'FALSE_NORTHING"\s*,\s*1(?:0{7}|E7)', text)
        return f"EPSG:{(32700 if south else 32600) + int((float(m[1]) + 183) / 6)}"
    return None


def read_crs(spark: SparkSession, path: str) -> str | None:
    from terrapair.sources import tables

    prj = re.sub(r"\.shp$", "", path) + ".prj"
    if not tables.exists(spark, prj):
        return None
    return crs_of(spark.read.text(prj, wholetext=True).first()[0])


def reproject(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Edge ends from one CRS to another, by Column expressions over longitude and latitude."""
    if source == target:
        return edges

    def moved(x: str, y: str) -> tuple:
        lon, lat = F.col(x), F.col(y)
        if source == "EPSG:3857":
            lon, lat = projection.from_web_mercator(lon, lat)
        elif source != "EPSG:4326":
            lon, lat = projection.from_utm(lon, lat, source)
        if target == "EPSG:4326":
            return lon, lat
        return projection.to_web_mercator(lon, lat) if target == "EPSG:3857" else projection.to_utm(lon, lat, target)

    (x0, y0), (x1, y1) = moved("x0", "y0"), moved("x1", "y1")
    return edges.select("poly_id", "ring_id", "edge_id", x0.alias("x0"), y0.alias("y0"), x1.alias("x1"), y1.alias("y1"))


def load_mask(spark: SparkSession, path: str, crs: str, assume: str | None = None) -> DataFrame:
    """Edges of a shapefile in the CRS of a grid. Without a projection file `assume` must name its CRS."""
    found = read_crs(spark, path) or assume
    if found is None:
        raise ValueError(f"{path}: no known projection; name it with assume=")
    return reproject(load_edges(spark, path), found, crs)


def _field(raw: bytes, kind: str):
    text = raw.decode("utf-8", "replace").strip(" \x00")
    if kind in "NF":
        try:
            return float(text) if text else None
        except ValueError:
            return None
    if kind == "L":
        return {"Y": True, "T": True, "N": False, "F": False}.get(text.upper())
    return text or None


def _layout(raw: bytes) -> tuple[int, int, int, list[tuple[str, str, int]]]:
    """(records, bytes before them, bytes of one, (name, kind, width) of the fields) of a .dbf file's first bytes."""
    n, head, size = struct.unpack("<IHH", raw[4:12])
    fields, at = [], 32
    while raw[at] != 0x0D:
        fields.append((raw[at : at + 11].split(b"\0")[0].decode(), chr(raw[at + 11]), raw[at + 16]))
        at += 32
    return n, head, size, fields


def _rows(raw: bytes, size: int, fields: list[tuple[str, str, int]]) -> list:
    """A tuple a record of `size` bytes, or None for a deleted one."""
    rows: list = []
    for i in range(len(raw) // size):
        row, p = raw[i * size : (i + 1) * size], 1
        out = []
        for _, kind, width in fields:
            out.append(_field(row[p : p + width], kind))
            p += width
        rows.append(None if row[:1] == b"*" else tuple(out))
    return rows


def read_attributes(raw: bytes) -> tuple[list[tuple[str, str]], list[tuple]]:
    """((name, kind) of the fields, a row a record or None for a deleted one) of a .dbf file."""
    n, head, size, fields = _layout(raw)
    return [(f, k) for f, k, _ in fields], _rows(raw[head : head + n * size], size, fields)


def _attributes(f, first: int, last: int | None) -> Iterator[pa.RecordBatch]:
    """(poly_id, values) of the records first to last, 10,000 at a time."""
    start = f.read(32)
    n, head, size, fields = _layout(start + f.read(struct.unpack("<H", start[8:10])[0] - 32))
    f.seek(head + first * size)
    end = n if last is None else min(n, last)
    for at in range(first, end, 10_000):
        have = [(at + i, r) for i, r in enumerate(_rows(f.read(size * min(10_000, end - at)), size, fields)) if r is not None]
        maps = [[(x, None if v is None else f"{v:.0f}" if isinstance(v, float) and v.is_integer() else str(v)) for (x, _, _), v in zip(fields, r)] for _, r in have]
        yield pa.record_batch([pa.array([i for i, _ in have], pa.int64()), pa.array(maps, pa.map_(pa.string(), pa.string()))], names=["poly_id", "values"])


def load_attributes(spark: SparkSession, path: str, ranges: bool | None = None) -> DataFrame:
    """(poly_id, values map<string, string>) of the records that aren't deleted.

    Records are of one length, so that tasks read stretches of them, where the store can be read by ranges (`ranges` overrides that).
    """
    base = re.sub(r"\.shp$", "", path)
    kinds = "poly_id long, values map<string,string>"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column(0):
                yield from _attributes(io.BytesIO(raw.as_buffer()), 0, None)

    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                with stores.opened(at) as f:
                    first = np.arange(0, max(1, struct.unpack("<I", f.read(8)[4:])[0]), ATTRIBUTE_ROWS)
                yield pa.record_batch([pa.array([at] * len(first), pa.string()), pa.array(first, pa.int64())], names=["path", "first"])

    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, first in zip(*(x.to_pylist() for x in batch.columns)):
                with stores.opened(at) as f:
                    yield from _attributes(f, first, first + ATTRIBUTE_ROWS)

    files = spark.read.format("binaryFile").load(f"{base}.dbf")
    if ranges is None:
        ranges = stores.seekable(files)
    if not ranges:
        return files.select("content").mapInArrow(whole, kinds)
    plan = files.select("path").mapInArrow(planned, "path string, first long")
    return plan.repartition(max(1, plan.count())).mapInArrow(stretches, kinds)


# writing


def polygon_content(rings: list[np.ndarray]) -> bytes:
    """A polygon record's content: shells clockwise, holes the other way, rings closed."""
    xy = np.concatenate(rings)
    first = np.cumsum([0, *map(len, rings[:-1])])
    box = (*xy.min(0), *xy.max(0))
    return struct.pack("<i4d2i", 5, *box, len(rings), len(xy)) + first.astype("<i4").tobytes() + xy.astype("<f8").tobytes()


@dataclass
class _Part(WriterCommitMessage):
    """A task's records: those at `path` without their numbers, and beside them (poly_id, bytes of content) of each."""

    path: str
    least: int | None
    n: int
    size: int
    box: tuple[float, float, float, float]

    def pieces(self) -> Iterator[tuple[np.ndarray, np.ndarray, bytearray]]:
        """(ids, sizes, records) of as many records at a time as a piece holds, one at least."""
        with open(self.path, "rb") as body, open(f"{self.path}.part", "rb") as index:
            while raw := index.read(16 * 50_000):
                ids, sizes = np.frombuffer(raw, np.int64).reshape(-1, 2).T
                upto = np.cumsum(sizes + 8)
                a = before = 0
                while a < len(ids):
                    b = max(a + 1, int(np.searchsorted(upto, before + INDEX_PIECE, "right")))
                    yield ids[a:b], sizes[a:b], bytearray(body.read(int(upto[b - 1]) - before))
                    a, before = b, int(upto[b - 1])


class _Writer(DataSourceWriter):
    def __init__(self, path: str, crs: str, overwrite: bool):
        self.base, self.crs, self.overwrite = _base(path), crs, overwrite
        self.run = uuid.uuid4().hex

    def write(self, rows) -> WriterCommitMessage:
        return self.write_corners((r["poly_id"], r["ring_id"], r["x0"], r["y0"]) for r in rows)

    def write_corners(self, corners: Iterable[tuple[int, int, float, float]]) -> _Part:
        """Corners (poly_id, ring_id, x, y) come in the order of their edges: a polygon's are consecutive."""
        path = f"{self.base}.{self.run}-{uuid.uuid4().hex}.part"
        part = _Part(path, None, 0, 0, (np.inf, np.inf, -np.inf, -np.inf))
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        with open(path, "wb") as f, open(f"{path}.part", "wb") as index:

            def put(poly: int, rings: list[list[tuple[float, float]]]) -> None:
                closed = [np.array([*r, r[0]] if r[0] != r[-1] else r) for r in rings]
                body = polygon_content(closed)
                f.write(struct.pack(">2i", 0, len(body) // 2) + body)
                index.write(struct.pack("=2q", poly, len(body)))
                part.least = poly if part.least is None else part.least
                part.n, part.size = part.n + 1, part.size + len(body) + 8
                xy = np.concatenate(closed)
                part.box = (*np.minimum(part.box[:2], xy.min(0)), *np.maximum(part.box[2:], xy.max(0)))

            poly, ring, rings = None, None, []
            for of, at, x, y in corners:
                if of != poly:
                    if rings:
                        put(poly, rings)
                    poly, ring, rings = of, None, []
                if at != ring:
                    ring = at
                    rings.append([])
                rings[-1].append((x, y))
            if rings:
                put(poly, rings)
        return part

    def commit(self, messages) -> None:
        parts = sorted((m for m in messages if m is not None and m.n), key=lambda m: m.least)
        count, total = sum(m.n for m in parts), HEADER + sum(m.size for m in parts)
        if total >= 1 << 31:
            self.abort(messages)
            raise ValueError("a shapefile holds less than 2 GB")
        if not self.overwrite and os.path.exists(f"{self.base}.shp"):
            self.abort(messages)
            raise FileExistsError(f"{self.base}.shp")
        box = np.array([m.box for m in parts]).reshape(-1, 4)
        box = (*box[:, :2].min(0), *box[:, 2:].max(0)) if len(box) else (0.0,) * 4

        def head(size: int) -> bytes:
            return struct.pack(">7i", FILE_CODE, 0, 0, 0, 0, 0, size // 2) + struct.pack("<2i8d", VERSION, 5, *box, 0, 0, 0, 0)

        new = {k: f"{self.base}.{self.run}.{k}" for k in ("shp", "shx", "dbf")}
        os.makedirs(os.path.dirname(self.base) or ".", exist_ok=True)
        with open(new["shp"], "wb") as shp, open(new["shx"], "wb") as shx, open(new["dbf"], "wb") as dbf:
            shp.write(head(total)), shx.write(head(HEADER + 8 * count))
            dbf.write(struct.pack("<B3BIHH20x", 3, 126, 1, 1, count, 65, 20) + struct.pack("<11sc4xBB14x", b"POLY_ID", b"N", 19, 0) + b"\x0d")
            n, at = 0, HEADER
            for m in parts:
                for ids, sizes, records in m.pieces():
                    start = np.cumsum(sizes + 8) - sizes - 8
                    number = np.arange(n + 1, n + 1 + len(ids)).astype(">i4").view(np.uint8).reshape(-1, 4)
                    np.frombuffer(records, np.uint8)[start[:, None] + np.arange(4)] = number
                    shp.write(records)
                    shx.write(np.stack([(at + start) // 2, sizes // 2], 1).astype(">i4").tobytes())
                    dbf.write(b"".join(b" %19d" % i for i in ids.tolist()))
                    n, at = n + len(ids), at + len(records)
            dbf.write(b"\x1a")
        for k, path in new.items():
            os.replace(path, f"{self.base}.{k}")
        if self.crs:
            with open(f"{self.base}.prj", "w") as f:
                f.write(projection_text(self.crs))
        self.abort(messages)

    def abort(self, messages) -> None:
        folder, name = os.path.split(f"{self.base}.{self.run}")
        for x in os.listdir(folder or ".") if os.path.isdir(folder or ".") else ():
            if x.startswith(name):
                os.remove(os.path.join(folder, x))


def projection_text(crs: str) -> str:
    """The text of a projection file."""
    geographic = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
    code = int(crs.split(":")[1])
    if code == 4326:
        return geographic
    zone, south = code % 100, code >= 32700
    ways = f'PARAMETER["False_Easting",500000.0],PARAMETER["False_Northing",{10000000.0 if south else 0.0}],PARAMETER["Central_Meridian",{zone * 6 - 183}.0],PARAMETER["Scale_Factor",0.9996],PARAMETER["Latitude_Of_Origin",0.0]'
    return f'PROJCS["WGS_1984_UTM_Zone_{zone}{"S" if south else "N"}",{geographic},PROJECTION["Transverse_Mercator"],{ways},UNIT["Meter",1.0]]'


def save_edges(edges: DataFrame, path: str, crs: str = "", mode: str = "overwrite") -> None:
    """Write polygons to a shapefile at a path that the driver and all executors can open; mode is overwrite or append (to no file)."""
    if mode not in ("overwrite", "append"):
        raise ValueError(f"mode {mode} of a shapefile")
    writer = _Writer(path, crs, mode == "overwrite")
    kinds = "path string, least long, n long, size long, box array<double>"

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = writer.write_corners(c for b in batches for c in zip(*(b.column(i).to_pylist() for i in (0, 1, 3, 4))))
        have = ([part.path], [part.least], [part.n], [part.size], [list(map(float, part.box))])
        yield pa.record_batch([pa.array(v, k) for v, k in zip(have, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.float64())))], names=[k.split()[0] for k in kinds.split(", ")])

    rows = edges.select(*(F.col(c).cast("long") for c in ("poly_id", "ring_id", "edge_id")), *(F.col(c).cast("double") for c in ("x0", "y0")))
    rows = rows.repartitionByRange("poly_id").sortWithinPartitions("poly_id", "ring_id", "edge_id")
    try:
        messages = [_Part(r["path"], r["least"], r["n"], r["size"], tuple(r["box"])) for r in rows.mapInArrow(parts, kinds).collect()]  # a row a task
        writer.commit(messages)
    except BaseException:
        writer.abort([])
        raise
