"""Figures that are ties at their last digit don't hang on the order in which they were summed."""

import random
from datetime import datetime
from decimal import ROUND_HALF_UP, Decimal

import duckdb

from terrapair.plans import catalog


def test_rates_that_are_ties(spark, tmp_path):
    """16 controls over two years: a mean of an odd total has a 5 as its seventh decimal."""
    rng, rows, want = random.Random(5), [], {}
    for source in "ANR":
        total = 0
        for s in range(32):
            start, end = rng.randrange(1, 51), rng.randrange(1, 51)
            if s == 30:  # the last control makes the total odd
                end = start + 1 - total % 2
            total += (end - start) * (s % 2 == 0)
            rows += [(source, s, 0, 1995, float(start)), (source, s, 0, 1997, float(end))]
        assert total % 2
        want[source] = float((Decimal(total) * Decimal("0.329") / 16).quantize(Decimal("0.000001"), ROUND_HALF_UP))
    rows = [(a, s, p, datetime(y, 6, 1), q) for a, s, p, y, q in rows]
    rng.shuffle(rows)
    spark.createDataFrame(rows, "l_returnflag string, l_suppkey long, l_partkey long, l_shipdate timestamp, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = {r["source"]: r["rate"] for r in catalog.QUERIES["source_period_batch"](spark, str(tmp_path)).collect()}
    duck = duckdb.connect()
    duck.execute(f"create view lineitem as select * from '{tmp_path}/lineitem.parquet/*.parquet'")
    sql = {r[0]: r[1] for r in duck.execute(f"select source, rate from ({catalog.ORACLE_SQL['source_period_batch']})").fetchall()}
    assert got == want and sql == want
