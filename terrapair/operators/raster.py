"""Cell geometry: rasterised polygons, masks, morphology, components, nearest distance, slope."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrapair.config import Grid
from terrapair.functions.columns import finite

CELL = ("grid_row", "grid_col")
#: Cells on a side of the blocks that neighbours are looked up in, at least.
BLOCK = 512


def apart(df: DataFrame) -> DataFrame:
    """A side of a join that grows with the data: joined by sorted rows. A table's size on disk is a fraction of that of its rows,
    which a broadcast would gather in the driver."""
    return df.hint("merge")


def edge_spans(edges: DataFrame, grid: Grid) -> DataFrame:
    """Spans (grid_row, col_start, col_end) of cells whose centre is inside the polygons.

    Every edge is exploded to the rows whose centre line it crosses (half-open in y, so
    a shared vertex counts once); the crossings of a (polygon, row), sorted, pair up to spans by
    the even-odd rule. Holes need nothing special. Work grows with polygon height in rows,
    not with area, and a group is one polygon's crossings of one row.
    """
    top = F.ceil((F.lit(grid.y0) - F.greatest("y0", "y1")) / grid.dy - 0.5)
    bottom = F.ceil((F.lit(grid.y0) - F.least("y0", "y1")) / grid.dy - 0.5) - 1
    crossed = edges.where("y0 <> y1").withColumn("grid_row", F.explode(F.when(bottom >= top, F.sequence(top, bottom)).otherwise(F.array().cast("array<bigint>"))))
    yc = F.lit(grid.y0) - (F.col("grid_row") + 0.5) * grid.dy
    x = F.col("x0") + (yc - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    rows = crossed.select("poly_id", "grid_row", x.alias("x")).groupBy("poly_id", "grid_row").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    pairs = F.transform(F.sequence(F.lit(0), (F.size("xs") / 2).cast("int") - 1), lambda i: F.struct(F.get("xs", i * 2).alias("a"), F.get("xs", i * 2 + 1).alias("b")))
    spans = rows.where(F.size("xs") >= 2).select("poly_id", F.col("grid_row").cast("int").alias("grid_row"), F.explode(pairs).alias("s"))
    # centres x0 + (col + .5) dx with a <= centre < b
    start = F.ceil((F.col("s.a") - grid.x0) / grid.dx - 0.5).cast("int")
    end = (F.ceil((F.col("s.b") - grid.x0) / grid.dx - 0.5) - 1).cast("int")
    return spans.select("poly_id", "grid_row", start.alias("col_start"), end.alias("col_end")).where("col_end >= col_start")


def rasterize(edges: DataFrame, grid: Grid, rows: int | None = None, cols: int | None = None) -> DataFrame:
    """Distinct (mask_row, mask_col) inside any polygon; cut to the grid's size if given."""
    s = edge_spans(edges, grid)
    if cols is not None:
        s = s.withColumns({"col_start": F.greatest("col_start", F.lit(0)), "col_end": F.least("col_end", F.lit(cols - 1))}).where("col_end >= col_start")
    if rows is not None:
        s = s.where(F.col("grid_row").between(0, rows - 1))
    return s.select(F.col("grid_row").alias("mask_row"), F.explode(F.sequence("col_start", "col_end")).alias("mask_col")).distinct()


def polygon_area_ha(edges: DataFrame, **more: Column) -> DataFrame:
    """(poly_id, area_ha) by the shoelace sum of rings with holes running the other way; `more` are further aggregates."""
    area = F.abs(F.sum(F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0"))) / 2 / 1e4
    return edges.groupBy("poly_id").agg(area.alias("area_ha"), *(v.alias(k) for k, v in more.items()))


def _in_blocks(cells: DataFrame, halo: int, work: Callable[[np.ndarray, pd.DataFrame], np.ndarray], columns: tuple[str, ...] = (), more: str = "") -> DataFrame:
    """`work` over blocks of cells with a halo: a task holds a block, and a cell goes to the blocks that it is in or near to.

    `work` gets the count of cells at each position of a block and its halo, and the block's rows with their positions r and c; it
    gives an array over them of what the block's own positions get, NaN for none. Rows and columns must not be null.
    """
    side = max(BLOCK, 4 * halo)

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(key[0]) * side - halo, int(key[1]) * side - halo
        r, c = rows["grid_row"].to_numpy() - r0, rows["grid_col"].to_numpy() - c0
        # the part of the block that has cells, and their halo
        top, left = max(int(r.min()) - halo, 0), max(int(c.min()) - halo, 0)
        high, wide = min(int(r.max()) + halo + 1, side + 2 * halo) - top, min(int(c.max()) + halo + 1, side + 2 * halo) - left
        r, c = r - top, c - left
        held = np.bincount(r * wide + c, minlength=high * wide).reshape(high, wide)
        out = work(held, rows.assign(r=r, c=c)).astype(float)
        y, x = np.nonzero(~np.isnan(out))
        own = (y + top >= halo) & (y + top < halo + side) & (x + left >= halo) & (x + left < halo + side)
        y, x = y[own], x[own]
        return pd.DataFrame({"grid_row": y + top + r0, "grid_col": x + left + c0, **({"value": out[y, x]} if more else {})})

    span = lambda c: F.explode(F.sequence(F.floor((F.col(c) - halo) / side), F.floor((F.col(c) + halo) / side)))
    dealt = cells.select(*CELL, *columns).withColumn("br", span("grid_row")).withColumn("bc", span("grid_col"))
    kinds = ", ".join(f"{c} {cells.schema[c].dataType.simpleString()}" for c in CELL)
    return dealt.groupBy("br", "bc").applyInPandas(run, kinds + more)


def _window(held: np.ndarray, reach: int, every: bool) -> np.ndarray:
    """Whether every, or any, position within `reach` rows and columns is held; nothing is held beyond the array."""
    for axis in (0, 1):
        pad = [(reach, reach) if i == axis else (0, 0) for i in (0, 1)]
        total = np.cumsum(np.pad(held.astype(np.int64), pad), axis=axis)
        total = np.concatenate([np.zeros_like(total.take([0], axis)), total], axis=axis)
        n = held.shape[axis]
        count = total.take(np.arange(2 * reach + 1, n + 2 * reach + 1), axis) - total.take(np.arange(n), axis)
        held = count == 2 * reach + 1 if every else count > 0
    return held


def dilate(cells: DataFrame, reach: int = 1) -> DataFrame:
    """Cells within `reach` rows and columns of a cell."""
    cells = cells.select(*CELL).distinct()
    return cells if reach < 1 else _in_blocks(cells, reach, lambda held, _: np.where(_window(held > 0, reach, False), 1.0, np.nan))


def erode(cells: DataFrame, reach: int = 1) -> DataFrame:
    """Cells all of whose neighbours within `reach` are cells."""
    cells = cells.select(*CELL).distinct()
    return cells if reach < 1 else _in_blocks(cells, reach, lambda held, _: np.where(_window(held > 0, reach, True), 1.0, np.nan))


def close(cells: DataFrame, reach: int) -> DataFrame:
    """Closing: dilation, then erosion, of a block with a halo that is wide enough for both."""
    cells = cells.select(*CELL).distinct()
    if reach < 1:
        return cells

    def work(held: np.ndarray, _: pd.DataFrame) -> np.ndarray:
        wide = _window(np.pad(held > 0, reach), reach, False)
        return np.where(_window(wide, reach, True)[reach:-reach, reach:-reach], 1.0, np.nan)

    return _in_blocks(cells, 2 * reach, work)


def _least(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least node of each node's component, of n nodes with edges a to b: roots are hooked to smaller ones."""
    root = np.arange(n)
    while len(a):
        a, b = root[a], root[b]
        apart = a != b
        a, b = a[apart], b[apart]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(up := root[root], root):
            root = up
    return root


def _labelled(key, rows: pd.DataFrame) -> pd.DataFrame:
    """A block's cells with the smallest cell key of their 4-connected and of their 8-connected neighbours within the block."""
    rows = rows.sort_values(list(CELL))
    r, c = (rows[x].to_numpy(np.int64) for x in CELL)
    top, left = r.min() - 1, c.min() - 1
    at = np.full((r.max() - top + 2, c.max() - left + 2), -1)
    at[r - top, c - left] = np.arange(len(r))
    pairs = []
    for dr, dc in ((0, 1), (1, 0), (1, 1), (1, -1)):
        other = at[r - top + dr, c - left + dc]
        pairs.append((np.flatnonzero(other >= 0), other[other >= 0]))
    sides = _least(*(np.concatenate([p[i] for p in pairs[:2]]) for i in (0, 1)), len(r))
    every = _least(*(np.concatenate([p[i] for p in pairs]) for i in (0, 1)), len(r))
    name = r * (1 << 32) + c
    return pd.DataFrame({"grid_row": r, "grid_col": c, "four": name[sides], "eight": name[every]})


def _spread(edges: DataFrame, store: Callable[[DataFrame], DataFrame], max_rounds: int) -> DataFrame:
    """(node, label): the least node of each component of edges (node, other); minima spread with path halving."""
    both = store(edges.union(edges.select("other", "node")).distinct())
    label = both.select("node", F.col("node").alias("label")).distinct()
    for _ in range(max_rounds):
        seen = both.join(apart(label.withColumnsRenamed({"node": "other", "label": "l"})), "other").groupBy("node").agg(F.min("l").alias("l"))
        spread = label.join(apart(seen), "node", "left").select("node", F.least("label", F.coalesce("l", "label")).alias("label"), F.col("label").alias("old"))
        # halving: a label's own label
        jump = spread.select(F.col("node").alias("label"), F.col("label").alias("up"))
        now = store(spread.join(apart(jump), "label", "left").select("node", F.least("label", F.coalesce("up", "label")).alias("label"), "old"))
        changed = now.where("label <> old").limit(1).count()
        label = now.select("node", "label")
        if not changed:
            return label
    raise RuntimeError("components did not converge")


def connected(cells: DataFrame, store: Callable[[DataFrame], DataFrame] | None = None, max_rounds: int = 200, kinds: tuple[str, ...] = ("four", "eight")) -> DataFrame:
    """(grid_row, grid_col, four, eight, inner): cells with the smallest cell key of their 4- and of their 8-connected component.

    Cells are dealt to blocks, whose cells are joined where they are. Only what meets at the sides of blocks is a graph, of block
    components, over which labels spread. `inner`: the 4-connected component lies in one block. `kinds` are the labels asked for.
    """
    store = store or (lambda df: df.checkpoint())
    side = BLOCK
    cells = cells.select(*(F.col(c).cast("int").alias(c) for c in CELL)).where("grid_row is not null and grid_col is not null").distinct()
    dealt = cells.withColumns({"br": F.floor(F.col("grid_row") / side), "bc": F.floor(F.col("grid_col") / side)})
    found = store(dealt.groupBy("br", "bc").applyInPandas(_labelled, "grid_row int, grid_col int, four long, eight long"))
    last = lambda c: F.pmod(F.col(c), F.lit(side)) == side - 1
    first = lambda c: F.pmod(F.col(c), F.lit(side)) == 0
    outer = found.where(last("grid_row") | last("grid_col") | first("grid_row") | first("grid_col"))
    here = outer.select(F.col("grid_row").alias("r"), F.col("grid_col").alias("c"), F.col("four").alias("f"), F.col("eight").alias("e"))
    steps = F.array(*[F.struct(F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for dr, dc in ((0, 1), (1, 0), (1, 1), (1, -1))])
    here = here.select("*", F.explode(steps).alias("s")).withColumns({"grid_row": F.col("r") + F.col("s.dr"), "grid_col": F.col("c") + F.col("s.dc")})
    block = lambda c: F.floor(F.col(c) / side)
    here = here.where((block("r") != block("grid_row")) | (block("c") != block("grid_col")))
    met = store(here.join(apart(outer), list(CELL)).select("f", "four", "e", "eight", (F.col("s.dr") * F.col("s.dc") == 0).alias("side")))
    out = found.withColumn("inner", F.lit(True))
    for kind, mine, some in (("four", "f", met.where("side")), ("eight", "e", met)):
        if kind in kinds:
            edges = some.select(F.col(mine).alias("node"), F.col(kind).alias("other")).distinct()
            whole = store(_spread(edges, store, max_rounds)).select(F.col("node").alias(kind), "label")
            out = out.join(apart(whole), kind, "left")
            inner = F.col("label").isNull() if kind == "four" else F.col("inner")
            out = out.select(*CELL, *(F.coalesce("label", kind).alias(k) if k == kind else k for k in ("four", "eight")), inner.alias("inner"))
    return out


def components(cells: DataFrame, store: Callable[[DataFrame], DataFrame] | None = None, max_rounds: int = 200, diagonal: bool = True) -> DataFrame:
    """(grid_row, grid_col, component) of 8-connected cells; a component is its smallest cell key.

    Without `diagonal` cells that share a corner only are not connected. `store` cuts the lineage of a round (default
    checkpoint()); see `connected`.
    """
    kind = "eight" if diagonal else "four"
    return connected(cells, store, max_rounds, (kind,)).select(*CELL, F.col(kind).alias("component"))


def keep_large_components(cells: DataFrame, grid: Grid, least_ha: float, store=None) -> DataFrame:
    """Cells of components of at least `least_ha`."""
    if least_ha <= 0:
        return cells
    parts = components(cells, store)
    big = parts.groupBy("component").agg((F.count(F.lit(1)) * grid.cell_ha).alias("ha")).where(F.col("ha") >= least_ha)
    return parts.join(big, "component", "left_semi").select(*CELL)


def nearest_distance(cells: DataFrame, targets: DataFrame, reach: float, cap: float, x: str = "x_utm", y: str = "y_utm") -> DataFrame:
    """Adds `distance`, to the nearest target within `reach`, else `cap`.

    Targets are put into square buckets of side `reach` and each is offered to the 9 buckets around
    it; the join is by bucket, so only near pairs meet, and minima are partial sums.
    """
    key = lambda c: F.floor(F.col(c) / reach)
    around = F.array(*[F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a in (-1, 0, 1) for b in (-1, 0, 1)])
    offered = targets.select(F.col(x).alias("tx"), F.col(y).alias("ty"), key(x).alias("kx"), key(y).alias("ky"), F.explode(around).alias("o"))
    offered = offered.select("tx", "ty", (F.col("kx") + F.col("o.dx")).alias("_bx"), (F.col("ky") + F.col("o.dy")).alias("_by"))
    positions = cells.select(x, y).distinct().withColumns({"_bx": key(x), "_by": key(y)})
    d = F.sqrt(F.pow(F.col(x) - F.col("tx"), F.lit(2)) + F.pow(F.col(y) - F.col("ty"), F.lit(2)))
    near = positions.join(offered, ["_bx", "_by"]).withColumn("d", d).where(F.col("d") <= reach).groupBy(x, y).agg(F.min("d").alias("distance"))
    return cells.join(near, [x, y], "left").withColumn("distance", F.coalesce("distance", F.lit(cap)))


def _block_distances(side: int, reach: int, dx: float, dy: float):
    """Squared distances of a block's cells to the sources in it and its halo, in two separable passes."""

    def near(key, there: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(key[0]) * side, int(key[1]) * side
        if not len(asked):
            return pd.DataFrame({"grid_row": [], "grid_col": [], "d2": []})
        # along columns: rows to the nearest source above or below, for the block's rows and the halo's columns
        high = side + 2 * reach
        held = np.zeros((high, high), bool)
        held[there["grid_row"].to_numpy() - r0 + reach, there["grid_col"].to_numpy() - c0 + reach] = True
        columns = np.flatnonzero(held.any(0))
        rows = np.arange(high)[:, None]
        far = 4 * high
        up = np.maximum.accumulate(np.where(held[:, columns], rows, -far), axis=0)
        down = np.minimum.accumulate(np.where(held[:, columns], rows, high + far)[::-1], axis=0)[::-1]
        steps = np.minimum(rows - up, down - rows)[reach : reach + side].astype(float)
        g = np.full((side, high), np.inf)
        g[:, columns] = np.where(steps <= reach, (steps * dy) ** 2, np.inf)
        # along rows: the least of g plus the way, by growing ways, until no farther column can be nearer
        r, c = asked["grid_row"].to_numpy() - r0, asked["grid_col"].to_numpy() - c0 + reach
        best = g[r, c]
        for k in range(1, reach + 1):
            way = (k * dx) ** 2
            if not (best > way).any():
                break
            best = np.minimum(best, np.minimum(g[r, c - k], g[r, c + k]) + way)
        return pd.DataFrame({"grid_row": asked["grid_row"], "grid_col": asked["grid_col"], "d2": np.where(np.isfinite(best), best, np.nan)})

    return near


def distance_to_cells(cells: DataFrame, sources: DataFrame, grid: Grid, reach_m: float, block: int = 512) -> DataFrame:
    """(grid_row, grid_col, distance): the exact distance between centres to the nearest source, null beyond `reach_m`.

    A distance transform over blocks of cells: sources are dealt to the blocks that they may be near to, a
    block and its halo being what a task holds, whatever their number. Only sources with a free neighbour
    are dealt, a cell that is a source has a distance of 0. Rows and columns must not be null.
    """
    cells, sources = cells.select(*CELL).distinct(), sources.select(*CELL).distinct()
    reach = int(max(reach_m / grid.dx, reach_m / grid.dy)) + 1
    side = max(block, reach // 4)
    edge = sources.join(erode(sources, 1), list(CELL), "left_anti")
    span = lambda c: F.sequence(F.floor((F.col(c) - reach) / side), F.floor((F.col(c) + reach) / side))
    dealt = edge.withColumn("br", F.explode(span("grid_row"))).withColumn("bc", F.explode(span("grid_col")))
    free = cells.join(sources, list(CELL), "left_anti")
    asked = free.withColumns({"br": F.floor(F.col("grid_row") / side), "bc": F.floor(F.col("grid_col") / side)})
    # cells of blocks that no source is near to have no distance, and blocks without cells to measure get no sources
    reached = dealt.select("br", "bc").distinct()
    beyond = asked.join(reached, ["br", "bc"], "left_anti").select(*CELL, F.lit(None).cast("double").alias("distance"))
    dealt = dealt.join(asked.select("br", "bc").distinct(), ["br", "bc"], "left_semi")
    asked = asked.join(reached, ["br", "bc"], "left_semi")
    asked = asked.select(*(F.col(c).alias(c) for c in asked.columns))  # both sides may come from one table
    found = dealt.groupBy("br", "bc").cogroup(asked.groupBy("br", "bc")).applyInPandas(_block_distances(side, reach, grid.dx, grid.dy), "grid_row int, grid_col int, d2 double")
    d = F.sqrt(finite(F.col("d2")))
    near = found.select(*CELL, F.when(d <= reach_m, d).alias("distance"))
    return near.unionByName(beyond).unionByName(cells.join(sources, list(CELL), "left_semi").withColumn("distance", F.lit(0.0)))


def terrain_slope(cells: DataFrame, grid: Grid, value: str = "elevation") -> DataFrame:
    """Adds slope_deg by Horn's 3x3 weights; null where a neighbour is missing.

    Neighbours meet in blocks of cells with a halo of one; positions that several rows share send them all.
    """
    wx = {(0, 1): 2, (-1, 1): 1, (1, 1): 1, (0, -1): -2, (-1, -1): -1, (1, -1): -1}  # weight of the neighbour at (dr, dc)
    wy = {(-1, 0): 2, (-1, -1): 1, (-1, 1): 1, (1, 0): -2, (1, -1): -1, (1, 1): -1}

    def work(held: np.ndarray, rows: pd.DataFrame) -> np.ndarray:
        high, wide = held.shape
        total = np.bincount(rows["r"] * wide + rows["c"], weights=rows["_v"], minlength=high * wide).reshape(high, wide)
        total, count = np.pad(total, 1), np.pad(held, 1)
        at = {(a, b): (slice(1 + a, 1 + a + high), slice(1 + b, 1 + b + wide)) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0)}
        gx, gy = (sum(w * total[at[k]] for k, w in ws.items()) for ws in (wx, wy))
        slope = np.degrees(np.arctan(np.sqrt((gx / (8 * grid.dx)) ** 2 + (gy / (8 * grid.dy)) ** 2)))
        return np.where(sum(count[k] for k in at.values()) == 8, slope, np.nan)

    sent = cells.where(F.col(value).isNotNull()).select(*CELL, F.col(value).cast("double").alias("_v"))
    slopes = _in_blocks(sent, 1, work, ("_v",), ", value double").withColumnRenamed("value", "slope_deg")
    return cells.join(slopes, list(CELL), "left")
