"""The extents' verdicts against their SQL on a table where an extent goes through its prefixes."""

import os

import duckdb
import pytest

from terrapair.plans import catalog
from tests.test_queries import plain

PART = "/root/testdata/sf0.1/part.parquet"


@pytest.mark.skipif(not os.path.exists(PART), reason="no test tables")
def test_an_extent_that_needs_a_prefix_equals_its_sql(spark):
    duck = duckdb.connect()
    duck.execute(f"create view part as select * from '{PART}'")
    df = catalog.QUERIES["extent_matching"](spark, os.path.dirname(PART))
    got = sorted(tuple(map(plain, r)) for r in df.collect())
    want = sorted(tuple(map(plain, r)) for r in duck.execute(catalog.ORACLE_SQL["extent_matching"]).fetchall())
    assert got == want and any(r[4] < r[3] for r in got)  # fewer selected than matched
