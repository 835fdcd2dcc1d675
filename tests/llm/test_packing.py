import random

import numpy as np
import pytest
from hypothesis import given as over
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postrank.llm import packing
from postrank.llm.queries import QUERIES
from tests.llm.conftest import EDGES, SF_DIR, document, needs_tables


def slow_fill(sizes, lengths, opening):
    """Best-fit decreasing by looking at every bin; of equal ones, the one last filled."""
    bins, clock = [], 0  # [capacity, used, last filled]
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fitting = [b for b in bins if b[0] - b[1] >= sizes[i]]
        if fitting:
            room = min(b[0] - b[1] for b in fitting)
            chosen = max((b for b in fitting if b[0] - b[1] == room), key=lambda b: b[2])
        else:
            chosen = [max(opening, min(n for n in lengths if n >= sizes[i])), 0, 0]
            bins.append(chosen)
        chosen[1] += sizes[i]
        clock += 1
        chosen[2] = clock
    return [(min(n for n in lengths if n >= b[1]), b[1]) for b in bins]


@settings(max_examples=60, deadline=None)
@over(st.lists(st.integers(1, 40), max_size=60))
def test_best_fit_equals_search(sizes):
    lengths = (8, 16, 40)
    where, bins = packing.best_fit(np.array(sizes, int), lengths)
    used = np.bincount(where, weights=sizes, minlength=len(bins)) if sizes else []
    trials = [slow_fill(sizes, lengths, o) for o in lengths]
    assert sorted(zip(bins.tolist(), map(int, used))) in [sorted(t) for t in trials]
    total = lambda t: sum(packing.cost(c) for c, _ in t)
    assert sum(map(packing.cost, bins.tolist())) == pytest.approx(min(map(total, trials)))


def check(rows, lengths, tokens):
    """Bins hold what they can, in the smallest length; every document is whole."""
    bins, parts = {}, {}
    for r in rows:
        bins.setdefault((r.bin_group, r.bin), []).append(r)
        parts.setdefault(r.doc_id, []).append((r.piece, r.start, r.size))
    for members in bins.values():
        members.sort(key=lambda r: r.position)
        at = 0
        for r in members:
            assert r.position == at
            at += r.size
        assert members[0].capacity == min(n for n in lengths if n >= at) and len({r.capacity for r in members}) == 1
    assert set(parts) == set(tokens)
    for doc, pieces in parts.items():
        assert sum(p[2] for p in pieces) == sum(tokens[doc])


def test_groups_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 30)
    random.seed(2)
    rows = [(i, i, random.choice([1, 3, 17, 64, 100, 200])) for i in range(200)]
    out = packing.pack(spark.createDataFrame(rows, "row long, doc_id long, tokens long"), (16, 32, 64)).collect()
    check(out, (16, 32, 64), {d: [t] for _, d, t in rows})
    assert len({r.bin_group for r in out}) > 3
    starts = sorted((r.piece, r.start, r.size) for r in out if r.doc_id == next(d for _, d, t in rows if t == 200))
    assert starts == [(0, 0, 64), (1, 64, 64), (2, 128, 64), (3, 192, 8)]


def test_little_is_wasted(spark):
    random.seed(3)
    rows = [(i, i, random.randint(1, 3000)) for i in range(3000)]
    out = packing.pack(spark.createDataFrame(rows, "row long, doc_id long, tokens long"))
    space = out.select("bin_group", "bin", "capacity").distinct().agg(F.sum("capacity")).first()[0]
    assert sum(r[2] for r in rows) / space > 0.98


def test_edges(docs):
    out = packing.pack_documents(docs()).collect()
    tokens = {}
    for r in EDGES:
        tokens.setdefault(r[0], []).append(len((r[1] or "").encode().split()) + 1)
    check(out, packing.LENGTHS, tokens)
    assert packing.pack_documents(docs([])).count() == 0
    assert packing.pack_documents(docs([document(None, None)])).first().asDict() == {
        "bin_group": 0, "bin": 0, "capacity": 512, "position": 0, "doc_id": None, "piece": 0, "start": 0, "size": 1,
    }


@needs_tables
def test_query_on_given_tables(spark, given):
    tokens = {r.doc_id: [len(r.text.encode().split()) + 1] for r in given("documents").collect()}
    check(QUERIES["op5_best_fit_packing"](spark, SF_DIR).collect(), packing.LENGTHS, tokens)


def test_large_ids_beside_null(docs):
    big = (1 << 62) + 1
    rows = [document(big, "a b"), document(big + 1, "c d e"), document(None, "f")]
    out = packing.pack_documents(docs(rows)).collect()
    assert {(r.doc_id, r.size) for r in out} == {(big, 3), (big + 1, 4), (None, 2)}
