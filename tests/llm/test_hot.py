"""Keys that hold a large share of all rows."""

from pyspark.sql import functions as F

from terrapair.llm import components, hot, jaccard_join
from tests.llm import brute
from tests.llm.test_llm import corpus, frame, got


def token_rows(spark, n=40_000):
    """Token 7 in half of the rows, token -1 in a tenth, all others in one or two."""
    return spark.range(0, n, 1, 16).selectExpr("case when id % 2 = 0 then 7 when id % 10 = 1 then -1 else id div 4 + 100 end token", "id cid")


def test_rows_of_hot_keys_are_spread(spark, monkeypatch):
    rows = token_rows(spark)
    want = {(r["token"], r["cid"], r["df"]) for r in jaccard_join._shared(rows, True).collect()}
    monkeypatch.setattr(hot, "ROWS", 2000)
    assert set(hot.hot_keys(rows, "token", "cid")) == {7, -1}
    out = jaccard_join._shared(rows, True)
    assert {(r["token"], r["cid"], r["df"]) for r in out.collect()} == want and (7, 0, 20_000) in want
    tasks = out.where("token in (7, -1)").groupBy(F.spark_partition_id()).count().toPandas()["count"]
    assert len(tasks) == 16 and tasks.max() <= 1500  # of 24,000 rows of two tokens
    lone = jaccard_join._shared(rows, False)
    assert {(r["token"], r["cid"]) for r in lone.collect()} == {x[:2] for x in want}


def test_more_hot_keys_than_are_broadcast(spark, monkeypatch):
    rows = token_rows(spark, 8000)
    want = {tuple(r) for r in jaccard_join._shared(rows, True).collect()}
    for name, value in (("ROWS", 2), ("SHARE", 1), ("KEYS", 1)):
        monkeypatch.setattr(hot, name, value)
    assert hot.hot_keys(rows, "token", "cid") == [7]
    assert {tuple(r) for r in jaccard_join._shared(rows, True).collect()} == want
    assert jaccard_join._shared(rows.limit(0), True).count() == 0


def test_jaccard_with_every_shared_key_hot(spark, monkeypatch):
    docs = corpus()
    for name, value in (("ROWS", 2), ("SHARE", 1)):
        monkeypatch.setattr(hot, name, value)
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 400)
    monkeypatch.setattr(jaccard_join, "ROUNDS", 1)
    out = jaccard_join.jaccard_components(frame(spark, docs), 4, 85)
    assert got(out, "doc_id", "n_shingles", "component_id") == brute.jaccard(docs, 4, 85)


def test_components_of_a_star(spark, monkeypatch):
    monkeypatch.setattr(hot, "ROWS", 64)
    edges = spark.range(1, 3000).selectExpr("id a", "case when id % 3 = 0 then id - 1 else 0 end b")
    labels = {r["node"]: r["label"] for r in components.components(edges).collect()}
    assert labels == dict.fromkeys(range(3000), 0)
