"""GeoTIFF rasters as tables: strips and tiles, classic and BigTIFF, uncompressed, deflate or LZW.

``spark.dataSource.register(GeoTiffSource)`` then
``spark.read.format("cells").option("path", file).load()`` gives a row for each valid cell with
grid_row, grid_col and a double column a band. A partition is a block of rows, of which
only its own strips are read; the path may be a URI of any store of `stores`. `load_files` reads
many files, in stretches of rows planned from their headers. Written from the public TIFF 6.0, BigTIFF
and GeoTIFF specifications.
"""

from __future__ import annotations

import io
import re
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from terrapair.sources import stores

_TYPES = {1: "B", 2: "s", 3: "H", 4: "I", 5: "II", 6: "b", 8: "h", 9: "i", 11: "f", 12: "d", 13: "I", 16: "Q", 17: "q", 18: "Q"}
BLOCK_ROWS = 2048
#: Decoded bytes of the rows that a task of `load_files` reads.
PART_BYTES = 64 << 20
#: Tasks of one `load_files`; with more stretches a task takes several.
MAX_TASKS = 20_000


#: Places and sizes of strips and tiles.
_PLACES = (273, 279, 324, 325)
#: Cells of one batch, about.
BATCH = 1 << 16


@dataclass
class Placed:
    """A list of numbers that stays in the file, of which a part is read."""

    at: int
    dtype: np.dtype

    def read(self, f, first: int, n: int) -> list[int]:
        f.seek(self.at + first * self.dtype.itemsize)
        return np.frombuffer(f.read(n * self.dtype.itemsize), self.dtype).tolist()


@dataclass
class Header:
    order: str
    tags: dict[int, tuple]

    def one(self, tag: int, default=None):
        return self.tags[tag][0] if tag in self.tags else default

    @property
    def size(self) -> tuple[int, int]:
        return self.one(257), self.one(256)

    @property
    def block_rows(self) -> int:
        """Rows of a strip or tile."""
        return self.one(323) if 324 in self.tags else min(self.one(278, self.size[0]), self.size[0])

    @property
    def bands(self) -> int:
        return self.one(277, 1)

    @property
    def dtype(self) -> np.dtype:
        kind = {1: "u", 2: "i", 3: "f"}[self.one(339, 1)]
        return np.dtype(f"{self.order}{kind}{self.one(258, 1) // 8}")

    @property
    def nodata(self) -> float | None:
        raw = b"".join(self.tags.get(42113, ())).rstrip(b"\0 ")
        return float(raw) if raw else None

    @property
    def names(self) -> list[str]:
        text = b"".join(self.tags.get(42112, ())).decode("utf-8", "replace")
        found = {int(m[1]): m[2] for m in re.finditer(r'<Item name="DESCRIPTION" sample="(\d+)"[^>]*>([^<]*)</Item>', text)}
        return [found.get(i, f"band_{i + 1}") for i in range(self.bands)]

    @property
    def transform(self) -> tuple[float, float, float, float] | None:
        """(x0, y0, dx, dy) of the upper left corner."""
        if 33550 not in self.tags or 33922 not in self.tags:
            return None
        (dx, dy, *_), (i, j, _, x, y, _) = self.tags[33550], self.tags[33922][:6]
        return x - i * dx, y + j * dy, dx, dy


def read_header(f) -> Header:
    raw = f.read(16)
    order = {b"II": "<", b"MM": ">"}.get(raw[:2])
    kind = struct.unpack(order + "H", raw[2:4])[0] if order else 0
    if kind not in (42, 43):
        raise ValueError("not a TIFF file")
    big = kind == 43
    # places and counts have 4 bytes, or 8 in a BigTIFF, whose entries are longer by as much
    word, count, wide = ("Q", "Q", 8) if big else ("I", "H", 4)
    f.seek(struct.unpack_from(order + word, raw, 8 if big else 4)[0])
    tags: dict[int, tuple] = {}
    n_entries = struct.unpack(order + count, f.read(struct.calcsize(count)))[0]
    entries = [f.read(4 + 2 * wide) for _ in range(n_entries)]
    for e in entries:
        tag, kind, n = struct.unpack_from(f"{order}HH{word}", e)
        code = _TYPES.get(kind)
        if code is None:
            continue
        size = struct.calcsize(order + code) * n
        if tag in _PLACES and size > wide:
            tags[tag] = Placed(struct.unpack_from(order + word, e, 4 + wide)[0], np.dtype(order + {"H": "u2", "I": "u4", "Q": "u8"}[code]))
            continue
        data = e[4 + wide : 4 + wide + size]
        if size > wide:
            f.seek(struct.unpack_from(order + word, e, 4 + wide)[0])
            data = f.read(size)
        tags[tag] = tuple(struct.unpack(f"{order}{n}s", data)) if code == "s" else tuple(struct.unpack(f"{order}{n * len(code)}{code[0]}", data))
    return Header(order, tags)


def _lzw(data: bytes) -> bytes:
    """TIFF's LZW: codes of 9 to 12 bits, most significant first, one code early to the next width."""
    out, start = bytearray(), [bytes([i]) for i in range(256)] + [b"", b""]
    table, width, before = list(start), 9, b""
    held = bits = 0
    for byte in data:
        held, bits = (held << 8 | byte) & 0xFFFFFF, bits + 8
        if bits < width:
            continue
        bits -= width
        code = held >> bits & (1 << width) - 1
        if code == 257:
            break
        if code == 256:
            table, width, before = list(start), 9, b""
            continue
        if code > len(table) or (code == len(table) and not before):
            raise ValueError("damaged LZW data")
        entry = table[code] if code < len(table) else before + before[:1]
        if before:
            table.append(before + entry[:1])
        out += entry
        before = entry
        if width < 12 and len(table) >= (1 << width) - 1:
            width += 1
    return bytes(out)


def _unpack(data: bytes, h: Header, rows: int, width: int, bands: int) -> np.ndarray:
    compression = h.one(259, 1)
    if compression in (8, 32946):
        data = zlib.decompress(data)
    elif compression == 5:
        data = _lzw(data)
    elif compression != 1:
        raise ValueError(f"TIFF compression {compression} is not supported")
    predictor = h.one(317, 1)
    if predictor == 3:
        # bytes of a row stand by significance, as differences to those of the pixel before
        size = h.dtype.itemsize
        planes = np.frombuffer(data, np.uint8, rows * width * bands * size).reshape(rows, size * width, bands)
        planes = np.cumsum(planes, axis=1, dtype=np.uint8).reshape(rows, size, width * bands)
        return np.ascontiguousarray(planes.transpose(0, 2, 1)).view(h.dtype.newbyteorder(">")).reshape(rows, width, bands).astype(h.dtype)
    x = np.frombuffer(data, h.dtype, rows * width * bands).reshape(rows, width, bands)
    if predictor == 2:
        x = np.cumsum(x, axis=1, dtype=h.dtype)
    elif predictor != 1:
        raise ValueError(f"TIFF predictor {predictor} is not supported")
    return x


def _part(f, h: Header, tag: int, first: int, n: int) -> list[int]:
    return h.tags[tag].read(f, first, n) if isinstance(h.tags[tag], Placed) else h.tags[tag][first : first + n]


def _stored(f, h: Header) -> Iterator[int]:
    """For each row of strips or tiles the decoded bytes of those that it has; absent tiles, which share a place, count once."""
    height, width = h.size
    planes, per = (h.bands, 1) if h.one(284, 1) == 2 else (1, h.bands)
    tiled = 324 in h.tags
    bw = h.one(322) if tiled else width
    across, down = -(-width // bw), -(-height // h.block_rows)
    rows = max(1, BATCH // across)
    for r in range(0, down, rows):
        k, found = min(rows, down - r), 0
        for p in range(planes):
            at, size = (np.array(_part(f, h, tag, (p * down + r) * across, k * across), np.int64).reshape(k, across) for tag in ((324, 325) if tiled else (273, 279)))
            at = np.sort(np.where(size > 0, at, -1), axis=1)
            found = found + (np.diff(at, axis=1, prepend=-1) != 0).sum(1)
        yield from (found * (h.block_rows * bw * per * h.dtype.itemsize)).tolist()


def _blocks(f, h: Header, first: int, last: int) -> Iterator[tuple[int, int, np.ndarray | None]]:
    """(row, column, [rows, columns, bands]) of the strips or tiles with rows in [first, last), cut to them and to the raster.

    None stands for a tile like one that had no valid cell: absent tiles share a place.
    """
    height, width = h.size
    planes, per = (h.bands, 1) if h.one(284, 1) == 2 else (1, h.bands)
    tiled = 324 in h.tags
    bh, bw = h.block_rows, h.one(322) if tiled else width
    across, down = -(-width // bw), -(-height // bh)
    empty: set[tuple[int, ...]] = set()
    for r in range(first // bh, -(-last // bh)):
        rows = bh if tiled else min(bh, height - r * bh)
        a, b = max(first, r * bh), min(last, r * bh + rows, height)
        line = [[_part(f, h, tag, (p * down + r) * across, across) for tag in ((324, 325) if tiled else (273, 279))] for p in range(planes)]
        for c in range(across):
            at = tuple(places[c] for places, _ in line)
            if at in empty or not any(sizes[c] for _, sizes in line):
                yield a, c * bw, None
                continue
            wide = min(bw, width - c * bw)
            out = np.empty((b - a, wide, h.bands), h.dtype)
            whole = True
            for p, (places, sizes) in enumerate(line):
                f.seek(places[c])
                block = _unpack(f.read(sizes[c]), h, rows, bw, per)
                out[:, :, p * per : p * per + per] = block[a - r * bh : b - r * bh, :wide]
                whole = whole and not _valid(block, h).any()
            if whole:
                empty.add(at)
            yield a, c * bw, out


def _valid(x: np.ndarray, h: Header) -> np.ndarray:
    """Which of [rows, columns, bands] are finite and have data in all bands."""
    ok = np.isfinite(x).all(2)
    return ok if h.nodata is None else ok & (x != h.nodata).all(2)


def read_rows(f, h: Header, first: int, last: int) -> np.ndarray:
    """Rows [first, last) as [rows, columns, bands]; only the blocks that hold them are read."""
    floats = h.dtype.kind == "f"
    fits = h.nodata is not None and (floats or (h.nodata.is_integer() and np.iinfo(h.dtype).min <= h.nodata <= np.iinfo(h.dtype).max))
    out = np.full((last - first, h.size[1], h.bands), h.nodata if fits else np.nan if floats else 0, h.dtype)
    for r, c, x in _blocks(f, h, first, last):
        if x is not None:
            out[r - first : r - first + x.shape[0], c : c + x.shape[1]] = x
    return out


class _Rows(InputPartition):
    def __init__(self, path: str, first: int, last: int):
        self.path, self.first, self.last = path, first, last


class GeoTiffSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "cells"

    def _header(self) -> Header:
        with stores.opened(self.options["path"]) as f:
            return read_header(f)

    def schema(self) -> str:
        return "grid_row int, grid_col int, " + ", ".join(f"`{n}` double" for n in self._header().names)

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options["path"], self._header(), int(self.options.get("blockRows", BLOCK_ROWS)))


class _Reader(DataSourceReader):
    def __init__(self, path: str, header: Header, block: int):
        self.path, self.header, self.block = path, header, block

    def partitions(self) -> list[_Rows]:
        height = self.header.size[0]
        return [_Rows(self.path, a, min(height, a + self.block)) for a in range(0, height, self.block)]

    def read(self, part: _Rows) -> Iterator[pa.RecordBatch]:
        with stores.opened(part.path) as f:
            yield from _cells(f, read_header(f), part.first, part.last)


def _cells(f, h: Header, first: int, last: int) -> Iterator[pa.RecordBatch]:
    """Valid cells of rows [first, last): a strip or tile at a time is decoded, however wide the raster is."""
    held: list[list[np.ndarray]] = []
    n = 0

    def flush() -> pa.RecordBatch:
        columns = [np.concatenate(x) for x in zip(*held)]
        held.clear()
        return pa.record_batch([pa.array(x) for x in columns], names=["grid_row", "grid_col", *h.names])

    for top, left, x in _blocks(f, h, first, last):
        if x is None:
            continue
        r, c = np.nonzero(_valid(x, h))
        if len(r):
            held.append([(r + top).astype(np.int32), (c + left).astype(np.int32), *(x[r, c, b].astype(np.float64) for b in range(h.bands))])
            n += len(r)
        if n >= BATCH:
            yield flush()
            n = 0
    if held:
        yield flush()


def _named(names: list[str], path: str, cells: pa.RecordBatch) -> pa.RecordBatch:
    """Cells with the file's name, and null for bands that it lacks."""
    tile = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
    have = [cells.column(cells.schema.get_field_index(n)) if n in cells.schema.names else pa.nulls(cells.num_rows, pa.float64()) for n in names]
    return pa.record_batch([pa.array([tile] * cells.num_rows, pa.string()), cells.column(0), cells.column(1), *have], names=["source_tile", "grid_row", "grid_col", *names])


def _planned(part_bytes: int):
    """Stretches of rows of each file: whole rows of its blocks, of about part_bytes once what is there is decoded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with stores.opened(path) as f:
                    h = read_header(f)
                    first, held = [0], 0
                    for i, n in enumerate(_stored(f, h)):
                        if held and held + n > part_bytes:
                            first.append(i * h.block_rows)
                            held = 0
                        held += n
                k = len(first)
                yield pa.record_batch([pa.array([path] * k, pa.string()), pa.array([h.names] * k, pa.list_(pa.string())), pa.array(first, pa.int32()), pa.array([*first[1:], h.size[0]], pa.int32())], names=["path", "names", "first", "last"])

    return run


def _stretches(names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first, last in zip(*(batch.column(i).to_pylist() for i in range(3))):
                with stores.opened(path) as f:
                    for cells in _cells(f, read_header(f), first, last):
                        yield _named(names, path, cells)

    return run


def _whole(names: list[str] | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                f = io.BytesIO(content.as_buffer())
                h = read_header(f)
                if names is None:
                    yield pa.record_batch([pa.array([h.names], pa.list_(pa.string()))], names=["names"])
                    continue
                for cells in _cells(f, h, 0, h.size[0]):
                    yield _named(names, path.as_py(), cells)

    return run


def load_files(spark: SparkSession, paths: str | list[str], pattern: str = "*.tif", part_bytes: int = PART_BYTES, ranges: bool | None = None) -> DataFrame:
    """Valid cells of files or folders in any store that Spark reads, with source_tile.

    Where the store can be read by ranges (`stores.seekable`; `ranges` overrides it), tasks plan the files from their
    headers, and each stretch of rows is a task of its own that fetches only its strips or tiles: the size of a
    file doesn't matter. From other stores a file is one task and one value (2 GB at most). Bands
    that a file lacks are null; only names of bands and a count come to the driver. No files give no rows.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(paths)
    if ranges is None:
        ranges = stores.seekable(files)
    if ranges:
        plan = files.select("path").mapInArrow(_planned(part_bytes), "path string, names array<string>, first int, last int")
        found, n = plan.agg(F.flatten(F.collect_set("names")), F.count(F.lit(1))).first()
        names = sorted(set(found))
        rows = plan.select("path", "first", "last").repartition(max(1, min(n, MAX_TASKS))).mapInArrow
        return rows(_stretches(names), _cell_schema(names))
    whole = files.select("path", "content")
    found = whole.mapInArrow(_whole(None), "names array<string>").selectExpr("explode(names) name").distinct().orderBy("name")
    names = [r[0] for r in found.collect()]  # a handful of bands
    return whole.mapInArrow(_whole(names), _cell_schema(names))


def _cell_schema(names: list[str]) -> str:
    return "source_tile string, grid_row int, grid_col int" + "".join(f", `{n}` double" for n in names)
