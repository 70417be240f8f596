"""Rows joined with an aggregate of their own key, where one key may hold any share of the rows.

A shuffle by the key puts all rows of a key into one task, and adaptive execution can't split a join whose one side
is an aggregate of the same exchange. So keys that hold very many rows are found on a hash sample. Their
aggregate is made of partial sums and broadcast: their rows are not shuffled at all. All other keys, and
those that the sample misses, go through the shuffle. Which way a key takes changes no row of the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key with about so many rows is hot.
ROWS = 100_000
#: One of so many rows is looked at.
SHARE = 64
#: Hot keys that are broadcast at most, those with the most rows.
KEYS = 50_000


def hot_keys(rows: DataFrame, key: str, by: str) -> list[int]:
    """Keys with about ROWS rows or more. Rows are sampled by the hash of `by`, which tells rows of a key apart."""
    few = rows.where(F.pmod(F.xxhash64(by, F.lit(11)), F.lit(SHARE)) == 0).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = few.where(F.col("n") >= max(1, ROWS // SHARE)).orderBy(F.desc("n"), key).limit(KEYS)
    return [r[0] for r in found.select(key).collect()]


def joined(rows: DataFrame, key: str, by: str, aggregate: Callable[[DataFrame], DataFrame], plain: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """`rows` joined with aggregate(rows), which has a row a key or none; `plain` is how to do so for keys that aren't hot."""
    plain = plain or (lambda x: x.join(aggregate(x), key))
    keys = hot_keys(rows, key, by)
    if not keys:
        return plain(rows)
    hot = F.broadcast(rows.sparkSession.createDataFrame([(k,) for k in keys], rows.select(key).schema))
    held = rows.join(hot, key, "left_semi")
    return held.join(F.broadcast(aggregate(held)), key).unionByName(plain(rows.join(hot, key, "left_anti")))
