"""Validity repair: any closed edges to simple rings with the same even-odd interior.

Edges of a polygon meet in square tiles that they pass and are split where they cross or touch; pieces that
occur an even number of times cancel. Both directions of a piece are half-edges, which at each corner go
on to the next one clockwise: their cycles are the outlines of faces, found by pointer jumping. A ray from one
place of each cycle tells by the parity of what it crosses if the face on its left is inside. Cycles of
inner faces are the rings, shells counter-clockwise and holes clockwise; one that passes a corner twice
is cut in two there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrapair.functions.columns import is_finite
from terrapair.operators.polygons import Store, _checkpointed, ring_order

ENDS = ("x0", "y0", "x1", "y1")
#: Decimals of a corner, and rounds of splitting until pieces cross no more.
DIGITS = 6
ROUNDS = 6


def _snapped(edges: DataFrame, digits: int) -> DataFrame:
    good = is_finite(F.col("x0")) & is_finite(F.col("y0")) & is_finite(F.col("x1")) & is_finite(F.col("y1"))
    at = edges.where(F.col("poly_id").isNotNull() & good).select("poly_id", *((F.round(F.col(c), digits) + F.lit(0.0)).alias(c) for c in ENDS))
    return at.where("x0 <> x1 or y0 <> y1")


def _odd(edges: DataFrame) -> DataFrame:
    """Undirected pieces that occur an odd number of times, from their smaller end to the larger."""
    turned = F.struct("x0", "y0") > F.struct("x1", "y1")
    ends = [F.when(turned, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in (("x0", "x1"), ("y0", "y1"), ("x1", "x0"), ("y1", "y0"))]
    one = edges.select("poly_id", *ends).groupBy("poly_id", *ENDS).agg(F.count(F.lit(1)).alias("n"))
    return one.where("n % 2 = 1").drop("n")


def _each_once(edges: DataFrame) -> DataFrame:
    """All polygons' edges as those of one, each piece once."""
    turned = F.struct("x0", "y0") > F.struct("x1", "y1")
    ends = [F.when(turned, F.col(b)).otherwise(F.col(a)).alias(a) for a, b in (("x0", "x1"), ("y0", "y1"), ("x1", "x0"), ("y1", "y0"))]
    return edges.where("x0 <> x1 or y0 <> y1").select("e", *ends).groupBy(*ENDS).agg(F.min("e").alias("e")).withColumn("poly_id", F.lit(0))


def _tiles(edges: DataFrame, side: float) -> DataFrame:
    """A row for each tile that an edge passes: columns of tiles first, then those its part in a column passes."""
    tile = lambda c: F.floor(c / side)
    a, b = F.least("x0", "x1"), F.greatest("x0", "x1")
    at = edges.withColumn("tx", F.explode(F.sequence(tile(a), tile(b))))
    slope = (F.col("y1") - F.col("y0")) / (F.col("x1") - F.col("x0"))
    left, right = F.greatest(a, F.col("tx") * side), F.least(b, (F.col("tx") + 1) * side)
    upright = F.col("x0") == F.col("x1")
    ya = F.when(upright, F.col("y0")).otherwise(F.col("y0") + (left - F.col("x0")) * slope)
    yb = F.when(upright, F.col("y1")).otherwise(F.col("y0") + (right - F.col("x0")) * slope)
    # a little wider, for what rounding moves over a tile's edge
    low, high = F.least(ya, yb) - side * 1e-6, F.greatest(ya, yb) + side * 1e-6
    return at.withColumn("ty", F.explode(F.sequence(tile(low), tile(high))))


def crossings(edges: DataFrame, side: float, digits: int = DIGITS) -> DataFrame:
    """(e, x, y): places inside edge `e` where another edge of its polygon crosses or touches it.

    Collinear edges that overlap are split at each other's ends.
    """
    at = _tiles(edges, side)
    p = at.select("poly_id", "tx", "ty", *(F.col(c).alias(f"p{c}") for c in ("e", *ENDS)))
    q = at.select("poly_id", "tx", "ty", *(F.col(c).alias(f"q{c}") for c in ("e", *ENDS)))
    both = p.join(q, ["poly_id", "tx", "ty"]).where("pe < qe")
    c = F.col
    rx, ry, sx, sy = c("px1") - c("px0"), c("py1") - c("py0"), c("qx1") - c("qx0"), c("qy1") - c("qy0")
    wx, wy = c("qx0") - c("px0"), c("qy0") - c("py0")
    both = both.withColumns({"d": rx * sy - ry * sx, "a": wx * sy - wy * sx, "b": wx * ry - wy * rx})
    t, u = c("a") / c("d"), c("b") / c("d")
    hit = F.when(c("d") != 0, (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1))
    place = F.when(hit, F.struct((F.round(c("px0") + t * rx, digits) + F.lit(0.0)).alias("x"), (F.round(c("py0") + t * ry, digits) + F.lit(0.0)).alias("y")))

    def end(of: str, k: int, on: str) -> Column:
        """An end of one edge that lies on the other, for parallel ones."""
        x, y = c(f"{of}x{k}"), c(f"{of}y{k}")
        inside = x.between(F.least(f"{on}x0", f"{on}x1"), F.greatest(f"{on}x0", f"{on}x1")) & y.between(F.least(f"{on}y0", f"{on}y1"), F.greatest(f"{on}y0", f"{on}y1"))
        return F.when((c("d") == 0) & (c("b") == 0) & inside, F.struct(c(f"{on}e").alias("e"), x.alias("x"), y.alias("y")))

    def met(of: str) -> Column:
        return F.when(place.isNotNull(), F.struct(c(f"{of}e").alias("e"), place["x"].alias("x"), place["y"].alias("y")))

    found = both.select(F.explode(F.array_compact(F.array(met("p"), met("q"), *(end(a, k, b) for a, b in ("pq", "qp") for k in (0, 1))))).alias("v")).select("v.*")
    return found.distinct().join(edges.select("e", *ENDS), "e").where("not (x = x0 and y = y0) and not (x = x1 and y = y1)").select("e", "x", "y")


def split(edges: DataFrame, digits: int, store: Store) -> DataFrame:
    """Undirected pieces of (poly_id, x0, y0, x1, y1) that cross nowhere and occur once."""
    now = store(_odd(_snapped(edges, digits)))
    for _ in range(ROUNDS):
        now = store(now.withColumn("e", F.monotonically_increasing_id()))
        size = now.agg(F.avg(F.greatest(F.abs(F.col("x1") - F.col("x0")), F.abs(F.col("y1") - F.col("y0"))))).first()[0]
        if not size:
            break
        cuts = store(crossings(now, 2 * size, digits))
        if not cuts.limit(1).count():
            break
        stops = now.select("poly_id", "e", F.col("x0").alias("x"), F.col("y0").alias("y")).union(now.select("poly_id", "e", "x1", "y1"))
        stops = stops.union(now.select("poly_id", "e").join(cuts, "e").select("poly_id", "e", "x", "y"))
        # ends are in order, so the way along an edge is that of (x, y)
        lines = now.select("e", F.col("y0").alias("_a"), F.col("y1").alias("_b"))
        stops = stops.join(lines, "e").withColumn("_y", F.when(F.col("_b") < F.col("_a"), -F.col("y")).otherwise(F.col("y")))
        w = Window.partitionBy("e").orderBy("x", "_y")
        pieces = stops.select("poly_id", F.col("x").alias("x0"), F.col("y").alias("y0"), F.lead("x").over(w).alias("x1"), F.lead("y").over(w).alias("y1"))
        now = store(_odd(pieces.where("x1 is not null and (x0 <> x1 or y0 <> y1)")))
    else:
        raise RuntimeError("edges still cross")
    return now.select("poly_id", *ENDS)


def _next(halves: DataFrame, clockwise: bool) -> DataFrame:
    """(seg, next) of half-edges (poly_id, seg, twin, x0, y0, x1, y1): the one after the twin at its corner."""
    w = Window.partitionBy("poly_id", "x0", "y0").orderBy(F.desc("angle") if clockwise else "angle")
    every = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    angle = F.atan2(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))
    turned = halves.withColumn("angle", angle).select("seg", F.coalesce(F.lead("seg").over(w), F.first("seg").over(every)).alias("next"))
    return halves.select("seg", "twin").join(turned.withColumnRenamed("seg", "twin"), "twin").select("seg", "next")


def _inside(cycles: DataFrame, pieces: DataFrame) -> DataFrame:
    """Rings whose left side is inside: one place of each against the pieces left of it, by bands of rows."""
    level = F.col("y0") == F.col("y1")
    at = cycles.where(~level).groupBy("poly_id", "ring").agg(F.min(F.struct("seg", *ENDS)).alias("s")).select("poly_id", "ring", "s.*")
    size = pieces.agg(F.avg(F.abs(F.col("y1") - F.col("y0")))).first()[0] or 1.0
    band = lambda y: F.floor(y / (2 * size))
    mx, my = (F.col("x0") + F.col("x1")) / 2, (F.col("y0") + F.col("y1")) / 2
    # the parity on the left of a half-edge that runs up is that of the pieces beyond; one that runs down is crossed too
    asked = at.select("poly_id", "ring", mx.alias("mx"), my.alias("my"), (F.col("y1") < F.col("y0")).cast("int").alias("own"), *(F.col(c).alias(f"o{c}") for c in ENDS)).withColumn("band", band(F.col("my")))
    low, high = F.least("y0", "y1"), F.greatest("y0", "y1")
    there = pieces.where(~level).withColumn("band", F.explode(F.sequence(band(low), band(high))))
    met = asked.join(there, ["poly_id", "band"], "left")
    x = F.col("x0") + (F.col("my") - F.col("y0")) / (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0"))
    same = ((F.col("ox0") == F.col("x0")) & (F.col("oy0") == F.col("y0")) & (F.col("ox1") == F.col("x1")) & (F.col("oy1") == F.col("y1"))) | ((F.col("ox0") == F.col("x1")) & (F.col("oy0") == F.col("y1")) & (F.col("ox1") == F.col("x0")) & (F.col("oy1") == F.col("y0")))
    beyond = (low <= F.col("my")) & (F.col("my") < high) & (x < F.col("mx")) & ~same
    n = met.groupBy("ring").agg((F.count_if(F.coalesce(beyond, F.lit(False))) + F.max("own")).alias("n"))
    return n.where("n % 2 = 1").select("ring")


def repair(edges: DataFrame, store: Store = _checkpointed, digits: int = DIGITS) -> DataFrame:
    """Edges (poly_id, ring_id, edge_id, x0, y0, x1, y1) of simple rings with the even-odd interior of `edges`.

    Null and non-finite edges and ones without a length are dropped; corners are rounded to `digits` decimals. A
    polygon without an interior has no edges. Rings are named anew, shells run counter-clockwise.
    """
    pieces = store(split(edges.select("poly_id", *ENDS), digits, store).withColumn("e", F.monotonically_increasing_id()))
    there = pieces.select("poly_id", (F.col("e") * 2).alias("seg"), (F.col("e") * 2 + 1).alias("twin"), *ENDS)
    back = pieces.select("poly_id", (F.col("e") * 2 + 1).alias("seg"), (F.col("e") * 2).alias("twin"), F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("x0").alias("x1"), F.col("y0").alias("y1"))
    halves = store(there.union(back))
    cycles = store(halves.join(ring_order(_next(halves, True), store), "seg"))
    kept = store(cycles.join(_inside(cycles, pieces), "ring", "left_semi"))
    # a cycle that passes a corner twice: there it goes on with the other of the outgoing half-edges
    twice = kept.groupBy("ring", "x0", "y0").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("ring", "x0", "y0")
    twice = store(twice)
    if twice.limit(1).count():
        out = kept.join(twice, ["ring", "x0", "y0"]).withColumn("angle", F.atan2(F.col("y1") - F.col("y0"), F.col("x1") - F.col("x0"))).select("ring", "x0", "y0", "seg", "angle")
        come = kept.join(twice.select("ring", F.col("x0").alias("x1"), F.col("y0").alias("y1")), ["ring", "x1", "y1"])
        come = come.select("ring", F.col("x1").alias("x0"), F.col("y1").alias("y0"), F.col("seg").alias("into"), F.atan2(F.col("y0") - F.col("y1"), F.col("x0") - F.col("x1")).alias("back"))
        # counter-clockwise from where it came
        turn = F.pmod(F.col("angle") - F.col("back"), F.lit(2 * 3.141592653589793))
        swapped = come.join(out, ["ring", "x0", "y0"]).groupBy("into").agg(F.min_by("seg", turn).alias("other"))
        plain = kept.select("seg", "ring", F.col("pos") + 1).toDF("seg", "ring", "_to")
        sizes = kept.groupBy("ring").agg((F.max("pos") + 1).alias("_n"))
        plain = plain.join(sizes, "ring").withColumn("_to", F.when(F.col("_to") < F.col("_n"), F.col("_to")).otherwise(F.lit(0)))
        plain = plain.join(kept.select("ring", F.col("pos").alias("_to"), F.col("seg").alias("next")), ["ring", "_to"]).select("seg", "next")
        linked = plain.join(swapped.withColumnRenamed("into", "seg"), "seg", "left").select("seg", F.coalesce("other", "next").alias("next"))
        kept = kept.drop("ring", "pos").join(ring_order(linked, store), "seg")
    return kept.select("poly_id", F.col("ring").alias("ring_id"), F.col("pos").alias("edge_id"), *ENDS)
