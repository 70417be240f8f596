"""Nearest donors within calipers and enforced reuse, without all pairs of a caliper's width."""

import random

import numpy as np
import pytest

from terrapair.config import MatchConfig
from terrapair.operators import matching
from terrapair.plans.pipeline import shared_store

LIMITS = [matching.Caliper("a", 2.0), matching.Caliper("b", 1.0), matching.Caliper("c", 1.5)]
METRIC = matching.Metric(("z", "a"), np.array([1.0, 2.0]), np.array([3.0, 2.0]), np.array([[1.0, 0.0], [0.3, 1.0]]))


def tables(spark, n, m, grid):
    """Rows with ties on a grid, missing values on both sides, and two tenures."""
    rng = random.Random(n)
    value = lambda hi: rng.choice([None, float("nan")]) if rng.random() < 0.06 else rng.randrange(hi * grid) / grid
    p = [(i, rng.choice("xy"), value(9), value(5), value(4), float(rng.randrange(6)), rng.choice([None, "s"])) for i in range(n)]
    d = [(1000 + i, rng.choice("xy"), value(9), value(5), value(4), float(rng.randrange(6)), rng.choice([None, "s"])) for i in range(m)]
    cols = "cls string, a double, b double, c double, z double, tenure_status string"
    return spark.createDataFrame(p, f"proj_idx long, {cols}"), spark.createDataFrame(d, f"donor_idx long, {cols}")


def brute(p, d):
    """(distance, proj_idx, donor_idx) of all pairs within class, tenure and calipers, both with a place."""
    out = []
    for x in p.collect():
        for y in d.collect():
            placed = all(v is not None and v == v for r in (x, y) for v in (r["a"], r["z"]))
            near = all(x[c.column] is None or (y[c.column] is not None and abs(y[c.column] - x[c.column]) <= c.tolerance) for c in LIMITS)
            if placed and near and (x["cls"], x["tenure_status"]) == (y["cls"], y["tenure_status"]):
                diff = np.array([(x["z"] - y["z"]) / 3.0, (x["a"] - y["a"]) / 2.0]) @ METRIC.lower
                out.append((round(float(np.sqrt((diff**2).sum())), 9), x["proj_idx"], y["donor_idx"]))
    return sorted(out)


@pytest.mark.parametrize("k, bin_rows", [(1, 100_000), (7, 100_000), (7, 20)])
def test_nearest_within_equals_brute_force(spark, monkeypatch, k, bin_rows):
    monkeypatch.setattr(matching, "BALL", 8)
    monkeypatch.setattr(matching, "TOGETHER", 5)
    p, d = tables(spark, 120, 500, 2)
    want: dict[int, list] = {}
    for dist, x, y in brute(p, d):
        want.setdefault(x, []).append((dist, y))
    got: dict[int, list] = {}
    for r in matching.nearest_within(p, d, LIMITS, "cls", METRIC, k, tenure="tenure_status", bin_rows=bin_rows).collect():
        got.setdefault(r["p_proj_idx"], []).append((r["match_rank"], r["distance"], r["d_donor_idx"]))
    assert {x: [y for _, *y in sorted(v)] for x, v in got.items()} == {x: [[dist, y] for dist, y in v[:k]] for x, v in want.items()}
    assert len(got) > 60


def test_caliper_first_pairs_do_not_pass_through_all_pairs(spark, monkeypatch):
    """2,000 donors within every project's calipers: what leaves the search are the nearest ones."""
    p = spark.createDataFrame([(i, "x", float(i)) for i in range(200)], "proj_idx long, cls string, a double")
    d = spark.createDataFrame([(1000 + i, "x", i / 10 + 0.01) for i in range(2000)], "donor_idx long, cls string, a double")
    metric = matching.Metric(("a",), np.zeros(1), np.ones(1), np.eye(1))
    m = matching.match(p, d, ["a"], [matching.Caliper("a", 300.0)], "cls", MatchConfig(mode="caliper_first"), metric)
    assert {r["p_proj_idx"]: r["d_donor_idx"] for r in m.pairs.collect()} == {i: 1000 + 10 * i for i in range(200)}
    plan = m.pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "FlatMapCoGroupsInArrow" in plan and m.candidates.count() == 400_000


@pytest.mark.parametrize("max_reuse", [1, 3])
def test_enforced_reuse_within_calipers_equals_greedy(spark, max_reuse):
    """Few donors for many projects, so that first lists are used up and grow."""
    p, d = tables(spark, 150, 90, 2)
    done, uses, want = set(), {}, []
    for _, x, y in brute(p, d):
        if x not in done and uses.get(y, 0) < max_reuse:
            done.add(x)
            uses[y] = uses.get(y, 0) + 1
            want.append((x, y))
    out = matching.enforce_reuse_within(p, d, LIMITS, "cls", METRIC, max_reuse, shared_store(spark, "within"), "tenure_status", first=1, growth=2)
    assert sorted((r["p_proj_idx"], r["d_donor_idx"]) for r in out.collect()) == sorted(want) and len(want) > 30


def test_enforced_reuse_query_asks_for_few_candidates(spark, monkeypatch):
    from terrapair.plans import match_queries

    seen = []
    whole = matching.enforce_reuse
    monkeypatch.setattr(matching, "enforce_reuse", lambda cand, *args, **kw: seen.append(cand.groupBy("p_proj_idx").count().agg({"count": "max"}).first()[0]) or whole(cand, *args, **kw))
    match_queries.enforced_reuse_match(spark, "/root/testdata/sf0.01").collect()
    assert seen and seen[0] <= matching.FIRST_CANDIDATES


def test_box_search_gives_back_a_bounded_number_of_neighbours(spark, monkeypatch):
    """A task's queries are bounded by what it gives back, k rows each; the neighbours are the same."""
    rng = np.random.default_rng(4)
    p = spark.createDataFrame([(i, *map(float, rng.normal(size=2))) for i in range(60)], "proj_idx long, a double, b double")
    d = spark.createDataFrame([(i, *map(float, rng.normal(size=2))) for i in range(300)], "donor_idx long, a double, b double")
    metric = matching.Metric(("a", "b"), np.zeros(2), np.ones(2), np.eye(2))
    asked = []
    search = matching._leaf_search
    monkeypatch.setattr(matching, "FOUND", 100)
    monkeypatch.setattr(matching, "_leaf_search", lambda q, d, k, dims, rows: asked.append(rows * k) or search(q, d, k, dims, rows))
    names = ["proj_idx", "donor_idx", "rank"]
    one, boxes = (sorted(map(tuple, x.select(*names).collect())) for x in (matching.knn(p, d, metric, 20), matching.knn(p, d, metric, 20, block_rows=100)))
    assert one == boxes and asked and max(asked) <= 100
