"""The best postings of many profiles, beside all cosines."""

import numpy as np
import pytest

from postrank.operators import similarity
from postrank.operators.similarity import best_for_profiles

DIM = 6


@pytest.fixture
def tables(spark):
    rng = np.random.default_rng(3)
    postings = [(i, rng.integers(-3, 4, DIM).astype(float).tolist()) for i in range(400)]
    postings += [(1000, [0.0] * DIM), (1001, None), (1002, [1.0] * (DIM - 1)), (1003, postings[5][1]), (1004, postings[5][1])]
    profiles = [(i, rng.integers(-3, 4, DIM).astype(float).tolist()) for i in range(30)] + [(50, None), (51, [0.0] * DIM)]
    schema = "id long, v array<double>"
    return postings, profiles, spark.createDataFrame(postings, schema), spark.createDataFrame(profiles, schema)


def brute(postings, profiles, k):
    usable = lambda rows: [(i, np.array(v, float)) for i, v in rows if v and len(v) == DIM and any(v)]
    out = []
    for p, u in usable(profiles):
        scored = sorted((-round(float(u @ v / (np.linalg.norm(u) * np.linalg.norm(v))), 7), i) for i, v in usable(postings))
        out += [(p, r, i) for r, (_, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(postings, profiles, k):
    best = best_for_profiles(postings, profiles, k, DIM, "id", "v", "id", "v").collect()
    return sorted((r["profile_id"], r["rank"], r["posting_id"]) for r in best)


@pytest.mark.parametrize("k", [1, 7, 1000])
def test_equals_all_cosines(tables, k, monkeypatch):
    monkeypatch.setattr(similarity, "DECIMALS", 7)
    postings, profiles, left, right = tables
    assert found(left, right, k) == brute(postings, profiles, k)


def test_blocks_change_nothing(tables, monkeypatch):
    monkeypatch.setattr(similarity, "DECIMALS", 7)
    postings, profiles, left, right = tables
    monkeypatch.setattr(similarity, "BLOCK_BYTES", 60 * DIM * 4)
    monkeypatch.setattr(similarity, "PRODUCTS", 100)
    assert found(left, right, 5) == brute(postings, profiles, 5)


def test_no_cross_join_and_no_broadcast(tables):
    _, _, left, right = tables
    plan = best_for_profiles(left, right, 5, DIM, "id", "v", "id", "v")._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "WindowGroupLimit" in plan
    assert not any(x in plan for x in ("NestedLoop", "Cartesian", "Broadcast"))


def test_empty_sides(tables):
    _, _, left, right = tables
    assert found(left.limit(0), right, 3) == [] and found(left, right.limit(0), 3) == []
