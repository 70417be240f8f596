"""Polygons of cells: masks to rings with holes, by joins over a table of boundary segments.

A segment is a maximal straight piece of boundary with the cells on its right. Segments link
to the one that starts where they end; rings are the cycles of these links, found and ordered by
pointer jumping, so that a ring of n segments takes about log2(n) joins and is never walked in one
task. Rings are simple: where a ring would touch itself at a corner it is cut in two.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapair.config import Grid
from terrapair.operators import raster

Store = Callable[[DataFrame], DataFrame]
#: Directions of segments, each a right turn after the one before.
EAST, SOUTH, WEST, NORTH = range(4)
_HALF = 1 << 29
#: Rounds of pointer jumping; rings of up to 2**MAX_ROUNDS segments.
MAX_ROUNDS = 60


def _checkpointed(df: DataFrame) -> DataFrame:
    return df.checkpoint()


def _islands(cells: DataFrame, line: str, along: str) -> DataFrame:
    """(line, a, b, part): runs of consecutive places of a line."""
    g = F.col(along) - F.row_number().over(Window.partitionBy(line).orderBy(along))
    runs = cells.select(line, along, "part", g.alias("g")).groupBy(line, "g")
    return runs.agg(F.min(along).alias("a"), F.max(along).alias("b"), F.min("part").alias("part"))


def _exposed(cells: DataFrame, line: str, along: str) -> tuple[DataFrame, DataFrame]:
    """Cells without a neighbour before, and without one after, in their line."""
    w = Window.partitionBy(line).orderBy(along)
    at = cells.withColumns({"_p": F.lag(along).over(w), "_n": F.lead(along).over(w)})
    before = at.where(F.col("_p").isNull() | (F.col("_p") < F.col(along) - 1))
    after = at.where(F.col("_n").isNull() | (F.col("_n") > F.col(along) + 1))
    return before.select("grid_row", "grid_col", "part"), after.select("grid_row", "grid_col", "part")


def boundary(cells: DataFrame) -> DataFrame:
    """(seg, dir, r0, c0, r1, c1, part) of cells (grid_row, grid_col, part).

    Corners are (row, col) of the grid's lines, cells lie on a segment's right. Sides between two
    cells never arise; seg is made of the first corner and the direction, which name a segment.
    """
    left, right = _exposed(cells, "grid_row", "grid_col")
    top, bottom = _exposed(cells, "grid_col", "grid_row")
    c = F.col
    sides = (
        (_islands(top, "grid_row", "grid_col"), EAST, c("grid_row"), c("a"), c("grid_row"), c("b") + 1),
        (_islands(bottom, "grid_row", "grid_col"), WEST, c("grid_row") + 1, c("b") + 1, c("grid_row") + 1, c("a")),
        (_islands(left, "grid_col", "grid_row"), NORTH, c("b") + 1, c("grid_col"), c("a"), c("grid_col")),
        (_islands(right, "grid_col", "grid_row"), SOUTH, c("a"), c("grid_col") + 1, c("b") + 1, c("grid_col") + 1),
    )
    out = None
    for df, way, r0, c0, r1, c1 in sides:
        one = df.select(F.lit(way).alias("dir"), *(x.cast("long").alias(n) for x, n in ((r0, "r0"), (c0, "c0"), (r1, "r1"), (c1, "c1"))), "part")
        out = one if out is None else out.unionByName(one)
    seg = F.shiftleft(F.col("r0") + _HALF, 33).bitwiseOR(F.shiftleft(F.col("c0") + _HALF, 2)).bitwiseOR(F.col("dir").cast("long"))
    return out.withColumn("seg", seg)


def links(segments: DataFrame, left: DataFrame | None = None) -> DataFrame:
    """(seg, next): at a corner where four segments meet a ring turns right, at those of `left` (r, c) left."""
    there = segments.select(F.col("r0").alias("r1"), F.col("c0").alias("c1"), F.col("seg").alias("next"), F.col("dir").alias("out"))
    both = segments.select("seg", "dir", "r1", "c1").join(raster.apart(there), ["r1", "c1"])
    turn = F.pmod(F.col("out") - F.col("dir"), F.lit(4))  # 1 right, 3 left
    if left is not None:
        both = both.join(raster.apart(left.select(F.col("r").alias("r1"), F.col("c").alias("c1"), F.lit(True).alias("_left"))), ["r1", "c1"], "left")
        turn = F.when(F.col("_left"), -turn).otherwise(turn)
    return both.groupBy("seg").agg(F.min_by("next", turn).alias("next"))


def ring_order(linked: DataFrame, store: Store = _checkpointed) -> DataFrame:
    """(seg, ring, pos) of the cycles of (seg, next): ring is the smallest seg, pos counts from it.

    After a round each segment knows the least of twice as many segments from it on, and how far on that is. If the
    stretch after that has the same least, both go round the whole ring. Then a segment is done and leaves; the
    others of its ring, which may still jump to it, follow in the next round at the latest.
    """
    now = store(linked.select("seg", "next", F.col("seg").alias("ring"), F.lit(0).cast("long").alias("ahead"), F.lit(False).alias("done")))
    closed = []
    for k in range(MAX_ROUNDS):
        far = now.select(F.col("seg").alias("next"), F.col("next").alias("jump"), F.col("ring").alias("there"), (F.col("ahead") + (1 << k)).alias("then"))
        less, same = F.col("there") < F.col("ring"), F.col("there") == F.col("ring")
        step = now.where("not done").join(raster.apart(far), "next").select("seg", F.col("jump").alias("next"), F.least("ring", "there").alias("ring"), F.when(less, F.col("then")).otherwise(F.col("ahead")).alias("ahead"), same.alias("done"))
        now = store(step)
        closed.append(now.where("done").select("seg", "ring", "ahead"))
        if not now.where("not done").limit(1).count():
            break
    else:
        raise RuntimeError("rings did not close")
    every = reduce(DataFrame.unionByName, closed)
    sizes = every.groupBy("ring").agg(F.count(F.lit(1)).alias("n"))
    return every.join(raster.apart(sizes), "ring").select("seg", "ring", F.pmod(F.col("n") - F.col("ahead"), F.col("n")).alias("pos"))


def rings(cells: DataFrame, store: Store = _checkpointed) -> DataFrame:
    """(part, ring, hole, pos, r, c): corners of the simple rings around cells (grid_row, grid_col, part).

    Parts must be 4-connected. Shells run clockwise on a map with north up, holes the other way.
    """
    segments = store(boundary(cells))
    order = store(ring_order(links(segments), store))
    at = segments.join(raster.apart(order), "seg")
    # a ring that passes a corner twice is two rings that touch there
    twice = at.groupBy("ring", F.col("r0").alias("r"), F.col("c0").alias("c")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("r", "c")
    twice = store(twice)
    if twice.limit(1).count():
        touching = at.join(raster.apart(twice), (F.col("r0") == F.col("r")) & (F.col("c0") == F.col("c"))).select("ring").distinct()
        again = store(at.join(raster.apart(touching), "ring", "left_semi").select(*segments.columns))
        order = store(ring_order(links(again, twice), store))
        at = at.join(raster.apart(touching), "ring", "left_anti").select(*segments.columns, "ring", "pos").unionByName(again.join(raster.apart(order), "seg").select(*segments.columns, "ring", "pos"))
    area = at.groupBy("ring").agg(F.sum(F.col("c0") * F.col("r1") - F.col("c1") * F.col("r0")).alias("twice"))
    return at.join(raster.apart(area), "ring").select("part", "ring", (F.col("twice") < 0).alias("hole"), "pos", F.col("r0").alias("r"), F.col("c0").alias("c"))


def _cycles(follow: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest place of each cycle of follow, and how far from it a place is; as `ring_order`."""
    ring, ahead, jump, k = np.arange(len(follow)), np.zeros(len(follow), np.int64), follow, 1
    while (less := ring[jump] < ring).any():
        ahead = np.where(less, ahead[jump] + k, ahead)
        ring, jump, k = np.minimum(ring, ring[jump]), jump[jump], 2 * k
    size = np.bincount(ring, minlength=len(ring))[ring]
    return ring, (size - ahead) % size


def _traced(key, rows: pd.DataFrame) -> pd.DataFrame:
    """`rings` of the parts that lie in one block: the same segments, links and order over arrays."""
    r, c = (rows[x].to_numpy(np.int64) for x in raster.CELL)
    top, left = r.min() - 1, c.min() - 1
    which = np.full((r.max() - top + 2, c.max() - left + 2), -1)
    which[r - top, c - left] = np.arange(len(r))
    held = which >= 0

    def runs(free: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        step = np.diff(np.pad(free.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        line, a = np.nonzero(step == 1)
        return line, a, np.nonzero(step == -1)[1]

    found = []
    for way, axis, shift in ((EAST, 0, 1), (WEST, 0, -1), (NORTH, 1, 1), (SOUTH, 1, -1)):
        free = held & ~np.roll(held, shift, axis)
        line, a, b = runs(free if axis == 0 else free.T)
        owner = which[line, a] if axis == 0 else which[a, line]
        place = line + (way in (WEST, SOUTH))
        start, end = (a, b) if way in (EAST, SOUTH) else (b, a)
        found.append((np.full(len(a), way), *((place, start, place, end) if axis == 0 else (start, place, end, place)), owner))
    way, r0, c0, r1, c1, owner = (np.concatenate(x).astype(np.int64) for x in zip(*found))
    name = lambda y, x, d: (y + top + _HALF << 33) | (x + left + _HALF << 2) | d
    seg = name(r0, c0, way)
    order = np.argsort(seg)
    seg, way, r0, c0, r1, c1, owner = (x[order] for x in (seg, way, r0, c0, r1, c1, owner))

    def turned(by: int) -> np.ndarray:
        want = name(r1, c1, (way + by) % 4)
        at = np.minimum(np.searchsorted(seg, want), len(seg) - 1)
        return np.where(seg[at] == want, at, -1)

    to_right, to_left = turned(1), turned(3)
    follow = np.where(to_right >= 0, to_right, to_left)
    ring, pos = _cycles(follow)
    by = np.lexsort((seg >> 2, ring))
    again = (ring[by][1:] == ring[by][:-1]) & (seg[by][1:] >> 2 == seg[by][:-1] >> 2)
    if again.any():
        twice = np.isin(name(r1, c1, 0) >> 2, seg[by][1:][again] >> 2)
        ring, pos = _cycles(np.where(twice & (to_left >= 0), to_left, follow))
    area = np.bincount(ring, c0 * r1 - c1 * r0, len(ring))[ring]
    of = {k: rows[k].to_numpy()[owner] for k in ("component", "part")}
    return pd.DataFrame({**of, "ring": seg[ring], "hole": area < 0, "pos": pos, "r": r0 + top, "c": c0 + left})


def mask_polygons(cells: DataFrame, grid: Grid, store: Store = _checkpointed) -> DataFrame:
    """(component, part, ring, hole, pos, x, y): the polygons of a mask's 8-connected components.

    A component is one multipolygon: its parts, 4-connected, are polygons that touch at corners at most.
    Components and parts are named by their smallest cell. Null rows or columns are no cells.

    Parts within a block of cells are traced where the block is; only the rings of parts that reach over blocks are found by joins.
    """
    found = store(raster.connected(cells, store).withColumnsRenamed({"four": "part", "eight": "component"}))
    block = lambda c: F.floor(F.col(c) / raster.BLOCK)
    kinds = "component long, part long, ring long, hole boolean, pos long, r long, c long"
    inner = found.where("inner").withColumns({"br": block("grid_row"), "bc": block("grid_col")})
    out = inner.drop("inner").groupBy("br", "bc").applyInPandas(_traced, kinds)
    wide = found.where("not inner")
    if not wide.isEmpty():
        of = wide.select("part", "component").distinct()
        out = out.unionByName(rings(wide.select("grid_row", "grid_col", "part"), store).join(raster.apart(of), "part").select(*out.columns))
    x, y = F.lit(grid.x0) + F.col("c") * grid.dx, F.lit(grid.y0) - F.col("r") * grid.dy
    return store(out.select("component", "part", "ring", "hole", "pos", x.alias("x"), y.alias("y")))


def ring_areas(vertices: DataFrame, *keys: str) -> DataFrame:
    """(*keys, ring, hole, n_vertices, length_m, area_m2) from the edges between consecutive corners."""
    e = edges_of(vertices, *keys)
    length = F.sqrt(F.pow(F.col("x1") - F.col("x0"), F.lit(2)) + F.pow(F.col("y1") - F.col("y0"), F.lit(2)))
    return e.groupBy(*keys, "ring", "hole").agg(F.count(F.lit(1)).alias("n_vertices"), F.sum(length).alias("length_m"), (F.abs(F.sum(F.col("x0") * F.col("y1") - F.col("x1") * F.col("y0"))) / 2).alias("area_m2"))


def edges_of(vertices: DataFrame, *keys: str) -> DataFrame:
    """(*keys, ring, hole, pos, x0, y0, x1, y1): each corner with the next one, the last with the first.

    A join on consecutive places, so that a ring's rows needn't meet in one task; a ring's first corner stands after its last one too.
    """
    corner = lambda place, x, y: (place.alias("_to"), x.alias("x1"), y.alias("y1"))
    first = vertices.groupBy("ring").agg(*corner(F.max("pos") + 1, F.min_by("x", "pos"), F.min_by("y", "pos")))
    there = vertices.where("pos > 0").select("ring", *corner(F.col("pos"), F.col("x"), F.col("y"))).unionByName(first)
    here = vertices.withColumn("_to", F.col("pos") + 1)
    return here.join(raster.apart(there), ["ring", "_to"]).select(*keys, "ring", "hole", "pos", F.col("x").alias("x0"), F.col("y").alias("y0"), "x1", "y1")


def to_edges(vertices: DataFrame, poly_id: str = "component") -> DataFrame:
    """The edge list (poly_id, ring_id, edge_id, x0, y0, x1, y1) that rasterising and sinks take."""
    e = edges_of(vertices, poly_id)
    return e.select(F.col(poly_id).alias("poly_id"), F.col("ring").alias("ring_id"), F.col("pos").alias("edge_id"), "x0", "y0", "x1", "y1")


def _number(c: Column) -> Column:
    """Without trailing zeros or an exponent."""
    return F.call_function("format_number", c, F.lit("0.######"))


def polygon_wkt(vertices: DataFrame, poly_id: str = "component") -> DataFrame:
    """(poly_id, n_parts, n_holes, wkt): a multipolygon a row, shells counter-clockwise, holes clockwise.

    A text holds its whole polygon, whose rings and parts are gathered for it.
    """
    point = F.concat_ws(" ", _number(F.col("x")), _number(F.col("y")))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("pos")).alias("o"), point.alias("p"))))
    ring = vertices.groupBy(poly_id, "part", "ring", "hole").agg(F.transform(listed, lambda v: v["p"]).alias("ps"))
    text = F.concat(F.lit("("), F.array_join(F.concat("ps", F.slice("ps", 1, 1)), ", "), F.lit(")"))
    one = ring.select(poly_id, "part", "ring", "hole", text.alias("t"))
    parts = one.groupBy(poly_id, "part").agg(F.array_sort(F.collect_list(F.struct("hole", "ring", "t"))).alias("rs"), F.count_if("hole").alias("holes"))
    body = F.concat(F.lit("("), F.array_join(F.transform("rs", lambda v: v["t"]), ", "), F.lit(")"))
    out = parts.groupBy(poly_id).agg(F.count(F.lit(1)).alias("n_parts"), F.sum("holes").alias("n_holes"), F.array_sort(F.collect_list(F.struct("part", body.alias("b")))).alias("bs"))
    return out.select(poly_id, "n_parts", "n_holes", F.concat(F.lit("MULTIPOLYGON ("), F.array_join(F.transform("bs", lambda v: v["b"]), ", "), F.lit(")")).alias("wkt"))


def _chord() -> Column:
    """Distance of (x, y) to the chord (ax, ay) - (bx, by), the same for both directions."""
    turned = F.struct("ax", "ay") > F.struct("bx", "by")
    px, py = F.when(turned, F.col("bx")).otherwise(F.col("ax")), F.when(turned, F.col("by")).otherwise(F.col("ay"))
    qx, qy = F.when(turned, F.col("ax")).otherwise(F.col("bx")), F.when(turned, F.col("ay")).otherwise(F.col("by"))
    dx, dy = qx - px, qy - py
    n = dx * dx + dy * dy
    t = F.when(n > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), ((F.col("x") - px) * dx + (F.col("y") - py) * dy) / n))).otherwise(F.lit(0.0))
    return F.sqrt(F.pow(F.col("x") - px - t * dx, F.lit(2)) + F.pow(F.col("y") - py - t * dy, F.lit(2)))


def _farthest(rows: DataFrame) -> DataFrame:
    """Per open piece (poly_id, ring_id, lo): its farthest corner from the chord."""
    return rows.groupBy("poly_id", "ring_id", "lo").agg(F.max(F.struct(_chord().alias("d"), "x", "y", "pos")).alias("f"))


def _parted(rows: DataFrame, at: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(corners that are kept now, the others in their new pieces): pieces are cut at `at`."""
    both = rows.join(at.select("poly_id", "ring_id", "lo", F.col("f.pos").alias("fp"), F.col("f.x").alias("fx"), F.col("f.y").alias("fy")), ["poly_id", "ring_id", "lo"])
    before = F.col("pos") < F.col("fp")
    kept = both.where("pos = fp").select("poly_id", "ring_id", "pos", "x", "y")
    pick = lambda a, b: F.when(before, a).otherwise(b)
    rest = both.where("pos <> fp").select(
        "poly_id", "ring_id", "pos", "x", "y", pick(F.col("lo"), F.col("fp")).alias("lo"), pick(F.col("fp"), F.col("hi")).alias("hi"),
        pick(F.col("ax"), F.col("fx")).alias("ax"), pick(F.col("ay"), F.col("fy")).alias("ay"), pick(F.col("fx"), F.col("bx")).alias("bx"), pick(F.col("fy"), F.col("by")).alias("by"),
    )
    return kept, rest


def _closed(kept: DataFrame) -> DataFrame:
    """Edges between the kept corners of each ring, by their places."""
    w = Window.partitionBy("poly_id", "ring_id").orderBy("pos")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = lambda c: F.coalesce(F.lead(c).over(w), F.first(c).over(every))
    return kept.select("poly_id", "ring_id", "pos", F.col("x").alias("x0"), F.col("y").alias("y0"), after("x").alias("x1"), after("y").alias("y1"))


def simplify(edges: DataFrame, tolerance: float, store: Store = _checkpointed) -> DataFrame:
    """Douglas-Peucker of all rings of (poly_id, ring_id, edge_id, x0, y0, x1, y1) at once, keeping their topology.

    A round finds the farthest corner of every open piece of every ring by one aggregate and cuts or
    closes the piece. Corners where more than two outlines meet stay, distances and ties don't depend on the
    direction, so an edge that two polygons share is simplified alike in both. Pieces that would cross others
    afterwards are cut on at their farthest corners until nothing crosses. A ring keeps three corners at
    least; rings must be simple (see `validity.repair`). Edges must be numbered from 0 along their ring.
    """
    from terrapair.operators import validity

    ring = ["poly_id", "ring_id"]
    if tolerance <= 0:
        return edges
    corners = store(edges.select(*ring, F.col("edge_id").cast("long").alias("pos"), F.col("x0").alias("x"), F.col("y0").alias("y")))
    ways = edges.select(F.struct("x0", "y0").alias("v"), F.struct("x1", "y1").alias("w")).union(edges.select(F.struct("x1", "y1"), F.struct("x0", "y0")))
    nodes = ways.distinct().groupBy("v").agg(F.count(F.lit(1)).alias("n")).where("n <> 2").select("v.*").toDF("x", "y")
    fixed = corners.join(nodes, ["x", "y"], "left_semi").select(*corners.columns)
    # the anchors of rings with one fixed corner or none: that one or the least, and the farthest from it
    first = corners.groupBy(*ring).agg(F.min(F.struct("x", "y", "pos")).alias("m"), F.count(F.lit(1)).alias("n"))
    have = fixed.groupBy(*ring).agg(F.count(F.lit(1)).alias("k"), F.min(F.struct("x", "y", "pos")).alias("h"))
    anchors = store(first.join(have, ring, "left").select(*ring, "n", F.coalesce("k", F.lit(0)).alias("k"), F.coalesce("h", "m").alias("a")))
    far = corners.join(anchors.where("k < 2"), ring)
    away = F.pow(F.col("x") - F.col("a.x"), F.lit(2)) + F.pow(F.col("y") - F.col("a.y"), F.lit(2))
    far = far.groupBy(*ring).agg(F.max(F.struct(away.alias("d"), "x", "y", "pos")).alias("f"))
    extra = far.select(*ring, "f.pos", "f.x", "f.y").union(anchors.where("k < 2").select(*ring, "a.pos", "a.x", "a.y"))
    fixed = fixed.union(extra).distinct()
    # places are counted from each ring's anchor on, so that no piece runs over the ring's end
    turn = lambda df: df.join(anchors, ring).withColumn("pos", F.pmod(F.col("pos") - F.col("a.pos"), F.col("n")))
    fixed = store(turn(fixed).select(*ring, "pos", "x", "y", "n"))
    w = Window.partitionBy(*ring).orderBy("pos")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pieces = fixed.select(*ring, F.col("pos").alias("lo"), F.coalesce(F.lead("pos").over(w), F.col("n")).alias("hi"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.coalesce(F.lead("x").over(w), F.first("x").over(every)).alias("bx"), F.coalesce(F.lead("y").over(w), F.first("y").over(every)).alias("by"))
    stretch = 1024
    dealt = pieces.withColumn("s", F.explode(F.sequence(F.expr(f"lo div {stretch}"), F.expr(f"(hi - 1) div {stretch}"))))
    inner = turn(corners).select(*ring, "pos", "x", "y").withColumn("s", F.expr(f"pos div {stretch}"))
    open_ = store(inner.join(dealt, [*ring, "s"]).where("pos > lo and pos < hi").drop("s"))
    kept, dropped = [fixed.select(*ring, "pos", "x", "y")], []
    while open_.limit(1).count():
        f = store(_farthest(open_))
        now, rest = _parted(open_, f.where(F.col("f.d") > tolerance))
        dropped.append(store(open_.join(f.where(F.col("f.d") <= tolerance), [*ring, "lo"], "left_semi").select(*open_.columns)))
        kept.append(store(now))
        open_ = store(rest.select(*open_.columns))
    gone = dropped[0] if dropped else open_
    for x in dropped[1:]:
        gone = gone.unionByName(x)
    stay = kept[0]
    for x in kept[1:]:
        stay = stay.unionByName(x)
    stay, gone = store(stay), store(gone)
    while True:
        now = store(_closed(stay).withColumn("e", F.monotonically_increasing_id()))
        size = now.agg(F.avg(F.greatest(F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0"))))).first()[0]
        if not size or not gone.limit(1).count():
            break
        # all polygons together, corners rounded as crossings are; an edge and its twin in another polygon are one
        near = now.withColumns({c: F.round(c, validity.DIGITS) + F.lit(0.0) for c in ("x0", "y0", "x1", "y1")})
        lines = store(validity._each_once(near))
        met = store(validity.crossings(lines, 2 * size))
        ends = lines.join(met.select("e").distinct(), "e", "left_semi").select("x0", "y0", "x1", "y1")
        hit = ends.union(ends.select("x1", "y1", "x0", "y0"))
        bad = near.join(hit.distinct(), ["x0", "y0", "x1", "y1"], "left_semi").select(*ring, F.col("pos").alias("lo"))
        thin = stay.groupBy(*ring).agg(F.count(F.lit(1)).alias("c")).where("c < 3").select(*ring)
        cut = gone.join(bad.distinct(), [*ring, "lo"], "left_semi").select(*gone.columns)
        most = _farthest(gone.join(thin, ring, "left_semi").select(*gone.columns))
        wide = most.groupBy(*ring).agg(F.max_by("lo", "f").alias("lo"), F.max("f").alias("f"))
        at = store(_farthest(cut).unionByName(wide.select(*ring, "lo", "f")).dropDuplicates([*ring, "lo"]))
        if not at.limit(1).count():
            break
        more, rest = _parted(gone, at)
        untouched = gone.join(at, [*ring, "lo"], "left_anti").select(*gone.columns)
        stay, gone = store(stay.unionByName(more)), store(rest.select(*gone.columns).unionByName(untouched))
    w = Window.partitionBy(*ring).orderBy("pos")
    return now.select(*ring, (F.row_number().over(w) - 1).alias("edge_id"), "x0", "y0", "x1", "y1")
