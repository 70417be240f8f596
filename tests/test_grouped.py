"""Quantiles of groups, checksums of files of any size, rows without a place, queries that SQL can't express."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from terrapair.functions import quantiles
from terrapair.operators import baseline, matching
from terrapair.plans import extract_queries, match_queries
from terrapair.plans.pipeline import shared_store
from terrapair.sources import stores, tables

SF = "/root/testdata/sf0.001"


def plain(values, q):
    return float(np.quantile(np.array(values, float), q))


@pytest.mark.parametrize("keep", [1, 7, 10_000])
def test_grouped_quantiles_equal_numpy(spark, keep):
    """A group with nine tenths of the rows, heavy ties, a null key, missing and infinite values, single rows."""
    rng = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in rng.normal(size=900)]
    rows += [("ties", float(v)) for v in rng.integers(0, 3, 60)] + [("same", 4.25)] * 20
    rows += [(None, float(v)) for v in rng.normal(size=31)] + [("one", -7.0), ("two", 1.0), ("two", 2.0)]
    rows += [("hot", None), ("hot", float("nan")), (None, float("inf")), ("empty", None), ("empty", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = {"low": 0.0, "quarter": 0.25, "mid": 0.5, "late": 0.93, "top": 1.0}
    got = {r["g"]: r for r in quantiles.grouped_quantiles(df, ["g"], "v", shares, keep=keep, store=shared_store(spark)).collect()}
    want = {}
    for g, v in rows:
        if v is not None and math.isfinite(v):
            want.setdefault(g, []).append(v)
    assert set(got) == set(want)  # a group without values has no row
    for g, values in want.items():
        assert [got[g][c] for c in shares] == pytest.approx([plain(values, q) for q in shares.values()], abs=1e-12), g


def test_grouped_quantiles_of_several_keys_and_of_no_rows(spark):
    df = spark.createDataFrame([(1, None, 1.0), (1, None, 3.0), (1, "a", 5.0), (None, "a", 7.0)], "x int, y string, v double")
    got = {(r["x"], r["y"]): r["m"] for r in quantiles.grouped_quantiles(df, ["x", "y"], "v", {"m": 0.5}, keep=1, store=shared_store(spark)).collect()}
    assert got == {(1, None): 2.0, (1, "a"): 5.0, (None, "a"): 7.0}
    none = quantiles.grouped_quantiles(df.where("false"), ["x"], "v", {"m": 0.5}, store=shared_store(spark))
    assert none.columns == ["x", "m"] and none.count() == 0


def test_no_task_sorts_a_whole_group(spark, monkeypatch):
    """The last step gets brackets of at most `keep` values, whatever the group's size."""
    df = spark.range(20_000).select(F.lit("g").alias("g"), F.pmod(F.col("id") * 7919, F.lit(20_011)).cast("double").alias("v"))
    seen = []
    true = quantiles._sorted_statistics

    def watched(rows, brackets, keys):
        seen.append(quantiles._inside(rows, brackets, keys).count())
        return true(rows, brackets, keys)

    monkeypatch.setattr(quantiles, "_sorted_statistics", watched)
    got = quantiles.grouped_quantiles(df, ["g"], "v", {"m": 0.5}, keep=100, store=shared_store(spark)).first()["m"]
    assert got == plain([i * 7919 % 20_011 for i in range(20_000)], 0.5)
    assert len(seen) >= 2 and max(seen) <= 200  # two order statistics may lie in two brackets


def test_interval_of_groups_is_the_interval_of_each(spark):
    rng = np.random.default_rng(8)
    rows = [(g, float(d), float(i % 9), float(i % 5), f"{i % 4}") for g in ("a", "b", None) for i, d in enumerate(rng.normal(size=25))]
    df = spark.createDataFrame(rows, "g string, delta_tC_ha_yr double, ref_lon double, ref_lat double, block_id string")
    numbers, texts = ["n_rows", "n_unique", "mean", "median", "sd", "n_blocks", "block_sd", "ci", "lower", "upper"], ["ci_source", "block_status", "uncbsl_status"]
    got = {r["g"]: r for r in baseline.control_interval(df, by=("g",), store=shared_store(spark)).collect()}
    assert set(got) == {"a", "b", None}
    for g in got:
        one = baseline.control_interval(df.where(F.col("g").eqNullSafe(F.lit(g)))).first()
        assert [got[g][c] for c in numbers] == pytest.approx([one[c] for c in numbers], rel=1e-9), g
        assert [got[g][c] for c in texts] == [one[c] for c in texts], g


def test_checksums_of_files_in_pieces(spark, tmp_path, monkeypatch):
    files = {"a.bin": b"", "b c.bin": b"x" * 10, "deep/c%20d.bin": bytes(range(256)) * 40_000, "skipped.txt": b"no"}
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)

    def sums():
        return {r["path"].split(str(tmp_path) + "/")[1]: (r["length"], r["sha256"]) for r in tables.checksums(spark, str(tmp_path), "*.bin").collect()}

    want = {n: (len(d), hashlib.sha256(d).hexdigest()) for n, d in files.items() if n.endswith(".bin") and d}
    assert sums() == want
    monkeypatch.setattr(stores, "seekable", lambda files: False)  # a store without ranges
    assert sums() == want


def test_rows_without_a_place_have_no_neighbours(spark):
    """Missing and infinite covariates on both sides, for broadcast donors, boxes and the SQL form."""
    bad = [None, float("nan"), float("inf")]
    p = spark.createDataFrame([(i, float(i % 7), float(i % 3)) for i in range(30)] + [(100 + i, x, 1.0) for i, x in enumerate(bad)], "proj_idx long, a double, b double")
    d = spark.createDataFrame([(i, i / 10, float(i % 5)) for i in range(200)] + [(1000 + i, 1.0, x) for i, x in enumerate(bad)], "donor_idx long, a double, b double")
    metric = matching.Metric(("a", "b"), np.zeros(2), np.ones(2), np.eye(2))
    names = ["proj_idx", "donor_idx", "distance", "rank"]
    one, boxes, sql = (sorted(map(tuple, x.select(*names).collect())) for x in (matching.knn(p, d, metric, 4), matching.knn(p, d, metric, 4, block_rows=50), matching.knn_sql(p, d, metric, 4)))
    assert one == boxes == sql and len(one) == 30 * 4
    assert {x[0] for x in one} == set(range(30)) and max(x[1] for x in one) < 200


def test_enforced_reuse_query_equals_greedy(spark):
    """The registered query over its whole table, against the pairs gone through one by one."""
    done, uses, want = set(), set(), []
    cand = match_queries.run(spark, SF, "caliper_first").candidates.where("passed")
    for dist, p, d in sorted((r["distance"], r["p_proj_idx"], r["d_donor_idx"]) for r in cand.select("distance", "p_proj_idx", "d_donor_idx").collect()):
        if p not in done and d not in uses:
            done.add(p), uses.add(d)
            want.append((p, d))
    got = match_queries.enforced_reuse_match(spark, SF).collect()
    assert want and sorted((r["proj_idx"], r["donor_idx"]) for r in got) == sorted(want)


def test_file_checksums_query_equals_hashlib(spark):
    with open(f"{SF}/region.parquet", "rb") as f:
        data = f.read()
    assert [tuple(r) for r in extract_queries.file_checksums(spark, SF).collect()] == [(len(data), hashlib.sha256(data).hexdigest())]
