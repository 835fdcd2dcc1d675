import zlib
from collections import Counter

import numpy as np
import pytest

from postrank.llm import sharding
from postrank.llm.queries import QUERIES
from postrank.storage import scratch_dir
from tests.llm.conftest import EDGES, SF_DIR, document, needs_tables


def laid_out(rows, shards):
    """Slots without gaps, counts at most one apart."""
    places = {s: sorted(slot for x, slot in rows if x == s) for s in range(shards)}
    assert sum(map(len, places.values())) == len(rows)
    assert all(p == list(range(len(p))) for p in places.values())
    assert max(map(len, places.values())) - min(map(len, places.values())) <= 1


@pytest.mark.parametrize("shards", [1, 3, 16])
def test_edges(docs, spark, shards):
    table = sharding.write_shards(docs(), scratch_dir(spark, "t"), shards)
    assert table.columns == [*docs().columns, "_slot", "_shard"]
    got = table.collect()
    laid_out([(r._shard, r._slot) for r in got], shards)
    assert Counter(tuple(r)[:-2] for r in got) == Counter(EDGES)


def test_empty(docs, spark):
    assert sharding.write_shards(docs([]), scratch_dir(spark, "t")).count() == 0


def test_many_buckets(docs, spark, monkeypatch):
    """Equal rows, a third of all, spread like any others, and the order is shuffled."""
    monkeypatch.setattr(sharding, "BUCKET_ROWS", 40)
    rows = [document(7, "same") if i % 3 == 0 else document(i, f"text {i}") for i in range(1000)]
    got = sharding.write_shards(docs(rows), scratch_dir(spark, "t"), 16).collect()
    laid_out([(r._shard, r._slot) for r in got], 16)
    assert Counter(tuple(r)[:-2] for r in got) == Counter(rows)
    assert all(5 < sum(r.text == "same" for r in got if r._shard == s) < 40 for s in range(16))
    order = [r.doc_id for r in sorted(got, key=lambda r: (r._shard, r._slot)) if r.text != "same"]
    assert abs(np.corrcoef(order, range(len(order)))[0, 1]) < 0.15


def test_same_each_time(docs, spark):
    rows = [document(i, f"text {i}") for i in range(200)]
    runs = [sharding.write_shards(docs(rows), scratch_dir(spark, "t")).collect() for _ in range(2)]
    assert sorted(map(tuple, runs[0]), key=str) == sorted(map(tuple, runs[1]), key=str)


def test_fisher_yates_is_fair():
    seen = Counter(tuple(sharding.fisher_yates(3, (1, i))) for i in range(6000))
    assert len(seen) == 6 and all(850 < n < 1150 for n in seen.values())


@needs_tables
def test_query_on_given_tables(spark, given):
    texts = {r.doc_id: (r.text or "").encode() for r in given("documents").collect()}
    got = QUERIES["op8_sharding"](spark, SF_DIR).collect()
    laid_out([(r.shard, r.slot) for r in got], 16)
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {d: (len(t) + 1, zlib.crc32(t)) for d, t in texts.items()}
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)} and len(got) == len(texts)
