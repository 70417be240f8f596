"""Connected components of a distributed edge list, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrapair.llm import _store, hot

MAX_ROUNDS = 60


def _star(edges: DataFrame, large: bool, many: bool) -> DataFrame:
    """Connect each node's larger (or smaller) neighbours to its smallest one.

    Minima are partial sums before the shuffle; `many`: a node may have so many neighbours that
    its edges are not shuffled for the join back (see `hot`).
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    minima = lambda x: x.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = minima(both)
    at = hot.joined(both, "a", "b", minima) if many else both.join(least, "a")
    if large:
        out = at.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = at.where("b <= a").select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.where("m < a").select("a", F.col("m").alias("b")))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) of every node of the edges (a, b), label the smallest node reachable.

    Rounds end when the edges stay the same, which their count and an order-free checksum show.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = held = _store.stored(edges, "components")
    before, n = None, edges.count()
    for _ in range(MAX_ROUNDS):
        many = n >= hot.ROWS // 2
        # looking for hot nodes reads the edges once more, so that they must be a table
        large = _store.stored(_star(edges, True, many), "stars") if many else _star(edges, True, False)
        now = _store.stored(_star(large, False, many), "components")
        if many:
            _store.drop_stored(large)
        _store.drop_stored(held)
        edges = held = now
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if state == before:
            roots = now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).union(roots)
        before, n = state, state[0]
    raise RuntimeError("components did not converge")
