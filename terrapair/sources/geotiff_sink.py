"""Tables of cells to a tiled GeoTIFF: tiles are encoded where they are gathered, the commit adds the header.

A block of tiles gives its overview tiles too. Tasks write tiles to parts of their own, and beside them where each lies. The commit
joins the parts and writes a BigTIFF directory for the raster and one for each
overview. Places without a cell hold the nodata value; tiles without any share one empty tile. The path must be one
that the driver and all executors can open. A failed write leaves no file.
"""

from __future__ import annotations

import os
import re
import shutil
import struct
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapair.config import Grid

NODATA = -9999.0
#: Cells on a side of a block that gives its overview tiles too, at most; a tile may be larger.
BLOCK = 1024
#: A tile, and the rows and columns that the raster must have for its cells; level -1 stands for cells that are no place of a raster.
_TILES = "level int, tr int, tc int, data binary, height long, width long"


def _encoded(tile: int, bands: Sequence[str], first: int, more: int):
    """Tiles of a block's cells, which are those of level `first`, and of as many levels `more` of means over them."""

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        if any(k is None or not k >= 0 for k in key):
            return pd.DataFrame({"level": [-1], "tr": [0], "tc": [0], "data": [b""], "height": [0], "width": [0]})
        br, bc = (int(k) for k in key)
        r, c = rows["r"].to_numpy(np.int64), rows["c"].to_numpy(np.int64)
        height, width = (0, 0) if first else (r.max() + 1, c.max() + 1)
        r, c = r - (br * tile << more), c - (bc * tile << more)
        v = rows[list(bands)].to_numpy(float)
        has = ~np.isnan(v)
        out = []
        for k in range(more + 1):
            n = tile << more - k
            at = (r >> k) * n + (c >> k)
            x = np.full((n * n, len(bands)), NODATA)
            if k == 0:
                x[at] = np.where(has, v, NODATA)
            for b in range(len(bands) if k else 0):
                count = np.bincount(at, has[:, b], n * n)
                some = count > 0
                x[some, b] = np.bincount(at, np.where(has[:, b], v[:, b], 0), n * n)[some] / count[some]
            x, across = x.reshape(n, n, len(bands)), 1 << more - k
            for i, j in (divmod(int(t), across) for t in np.unique(at // n // tile * across + at % n // tile)):
                piece = x[i * tile : (i + 1) * tile, j * tile : (j + 1) * tile]
                out.append((first + k, br * across + i, bc * across + j, zlib.compress(piece.astype("<f8").tobytes()), height, width))
        return pd.DataFrame(out, columns=["level", "tr", "tc", "data", "height", "width"])

    return run


def tiles(cells: DataFrame, bands: Sequence[str], tile: int, overviews: int) -> DataFrame:
    """(level, tr, tc, data, height, width): compressed tiles; level k has the means of 2**k by 2**k cells.

    A group is one block's distinct cells, so that its size is bounded by the block's: a tile, or as many as have overview tiles in
    common while these are no more than BLOCK cells on a side. Overviews beyond that are grouped by tile, each from the cells.
    """
    value = lambda f: [f(F.col(f"`{b}`").cast("double")).alias(b) for b in bands]
    base = cells.groupBy("grid_row", "grid_col").agg(*value(F.max))
    more = max(k for k in range(overviews + 1) if k == 0 or tile << k <= BLOCK)

    def encoded(df: DataFrame, first: int, more: int) -> DataFrame:
        at = df.withColumns({"br": F.expr(f"cast(floor(r / {tile << more}) as int)"), "bc": F.expr(f"cast(floor(c / {tile << more}) as int)")})
        return at.groupBy("br", "bc").applyInPandas(_encoded(tile, list(bands), first, more), _TILES)

    out = encoded(base.select(F.col("grid_row").alias("r"), F.col("grid_col").alias("c"), *bands), 0, more)
    for k in range(more + 1, overviews + 1):
        known = base.where("grid_row >= 0 and grid_col >= 0")
        small = known.groupBy(F.shiftright("grid_row", k).alias("r"), F.shiftright("grid_col", k).alias("c")).agg(*value(F.avg))
        out = out.unionByName(encoded(small, k, 0))
    return out


class _Writer:
    """Parts of tiles, and beside each (level, tr, tc, offset, size) of its tiles; both go when the raster is there."""

    def __init__(self, path: str):
        self.path, self.run = path, uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(path, height, width, bad): a row a task."""
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        path = f"{self.path}.{self.run}-{uuid.uuid4().hex}.part"
        height = width = bad = 0
        with open(path, "wb") as f, open(f"{path}.places", "wb") as places:
            for batch in batches:
                for level, tr, tc, data, h, w in zip(*(x.to_pylist() for x in batch.columns)):
                    if level < 0:
                        bad += 1
                        continue
                    height, width = max(height, h), max(width, w)
                    places.write(struct.pack("=5q", level, tr, tc, f.tell(), len(data)))
                    f.write(data)
        yield pa.record_batch([pa.array([path], pa.string()), *(pa.array([x], pa.int64()) for x in (height, width, bad))], names=["path", "height", "width", "bad"])

    def commit(self, parts: Sequence[str], height: int, width: int, tile: int, levels: int, names: list[str], transform: tuple[float, ...], epsg: int) -> None:
        x0, y0, dx, dy = transform
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        new = f"{self.path}.{self.run}.tif"
        with open(new, "wb") as f:
            f.write(struct.pack("<2sHHHQ", b"II", 43, 8, 0, 0))
            empty = zlib.compress(np.full((tile, tile, len(names)), NODATA).astype("<f8").tobytes())
            nothing = (f.tell(), len(empty))
            f.write(empty)
            bases = []
            for part in parts:
                bases.append(f.tell())
                with open(part, "rb") as body:
                    shutil.copyfileobj(body, f)
            link = 8  # where the offset of the next directory goes
            for level in range(levels + 1):
                h, w = -(-height // (1 << level)), -(-width // (1 << level))
                across = -(-w // tile)
                places = np.tile(np.array([nothing], np.int64), (-(-h // tile) * across, 1))
                for part, base in zip(parts, bases):
                    with open(f"{part}.places", "rb") as index:
                        while raw := index.read(40 << 16):
                            k, r, c, at, n = np.frombuffer(raw, np.int64).reshape(-1, 5).T
                            here = k == level
                            places[r[here] * across + c[here]] = np.stack([base + at[here], n[here]], 1)
                link = self._directory(f, link, level, h, w, tile, names, places, (x0, y0, dx * (1 << level), dy * (1 << level)), epsg)
        os.replace(new, self.path)

    @staticmethod
    def _directory(f, link: int, level: int, height: int, width: int, tile: int, names: list[str], places: np.ndarray, at: tuple[float, ...], epsg: int) -> int:
        """Write one directory with its values and let the one before point to it."""
        n = len(names)
        items = "".join(f'<Item name="DESCRIPTION" sample="{i}" role="description">{x}</Item>' for i, x in enumerate(names))
        geographic = epsg == 4326
        keys = [1, 1, 0, 3, 1024, 0, 1, 2 if geographic else 1, 1025, 0, 1, 1, 2048 if geographic else 3072, 0, 1, epsg]
        x0, y0, dx, dy = at
        # (tag, type, values): 2 text, 3 and 4 and 16 whole numbers of 2, 4 and 8 bytes, 12 doubles
        tags = [
            (254, "I", [int(level > 0)]), (256, "I", [width]), (257, "I", [height]), (258, "H", [64] * n), (259, "H", [8]), (262, "H", [1]), (277, "H", [n]), (284, "H", [1]),
            (322, "I", [tile]), (323, "I", [tile]), (324, "Q", places[:, 0]), (325, "Q", places[:, 1]), (338, "H", [0] * (n - 1)), (339, "H", [3] * n),
            (33550, "d", [dx, dy, 0.0]), (33922, "d", [0.0, 0.0, 0.0, x0, y0, 0.0]), (34735, "H", keys),
            (42112, "s", f"<GDALMetadata>{items}</GDALMetadata>".encode() + b"\0"), (42113, "s", f"{NODATA:g}".encode() + b"\0"),
        ]
        kinds = {"s": 2, "H": 3, "I": 4, "Q": 16, "d": 12}
        entries = []
        for tag, code, values in tags:
            if not len(values):
                continue
            raw = values if code == "s" else values.astype("<u8").tobytes() if isinstance(values, np.ndarray) else struct.pack(f"<{len(values)}{code}", *values)
            if len(raw) > 8:
                place = f.tell()
                f.write(raw)
                raw = struct.pack("<Q", place)
            entries.append(struct.pack("<HHQ", tag, kinds[code], len(values)) + raw.ljust(8, b"\0"))
        here = f.tell()
        f.write(struct.pack("<Q", len(entries)) + b"".join(entries))
        after = f.tell()
        f.write(struct.pack("<Q", 0))
        f.seek(link)
        f.write(struct.pack("<Q", here))
        f.seek(0, os.SEEK_END)
        return after

    def clear(self) -> None:
        folder, name = os.path.split(f"{self.path}.{self.run}")
        for x in os.listdir(folder or ".") if os.path.isdir(folder or ".") else ():
            if x.startswith(name):
                os.remove(os.path.join(folder, x))


def save_raster(cells: DataFrame, path: str, grid: Grid, bands: Sequence[str], tile: int = 256, overviews: int = 0) -> None:
    """Write cells (grid_row, grid_col, *bands) as a tiled GeoTIFF of doubles with overviews of means.

    The raster reaches from the grid's corner to the farthest row and column; rows and columns must not be
    negative or null. A repeated cell has its greatest values, a null or a value that isn't finite is nodata.
    """
    from terrapair.functions.columns import finite

    if bad := [b for b in bands if set(b) & set('<>&\n"')]:
        raise ValueError(f"band names for a raster: {bad}")
    clean = cells.select("grid_row", "grid_col", *(finite(F.col(f"`{b}`").cast("double")).alias(b) for b in bands))
    writer = _Writer(re.sub(r"^file:/+", "/", path))
    try:
        parts = tiles(clean, bands, tile, overviews).mapInArrow(writer.write, "path string, height long, width long, bad long").collect()  # a row a task
        if any(p["bad"] for p in parts):
            raise ValueError("rows and columns of a raster count from 0")
        height, width = (max((p[x] for p in parts), default=0) or 1 for x in ("height", "width"))
        writer.commit([p["path"] for p in parts], height, width, tile, overviews, list(bands), (grid.x0, grid.y0, grid.dx, grid.dy), int(grid.crs.split(":")[1]))
    finally:
        writer.clear()
