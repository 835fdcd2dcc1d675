import pytest

import corpus_pipeline
from postrank.llm import queries
from tests.llm.conftest import EDGES, SF_DIR, document, needs_tables, same_columns
from tests.llm.test_simhash import hard, similar_pairs, slow_components


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "temperature_mixing", "best_fit_packing",
    ]


@pytest.mark.parametrize("rows", [EDGES, [], [document(None, None, None, None)]], ids=["edges", "empty", "nulls"])
def test_each_stage_on_edges(spark, docs, rows):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs(rows), "unused")
        if name != "best_fit_packing":
            same_columns(docs(), out)
        assert out.count() <= max(len(rows) * 3, 1)


@needs_tables
def test_run(spark, given):
    docs = given("documents")
    packed = corpus_pipeline.run(spark, SF_DIR)
    kept = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    normal = {}
    for d in kept:
        assert normal.setdefault("".join(texts[d].split()), d) == d
    assert 0.7 * len(normal) < len(kept) <= len({"".join(t.split()) for t in texts.values()})


@needs_tables
@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_sql(spark, name):
    check = pytest.importorskip("harness.check")
    db = check.connect(SF_DIR)
    ours = queries.QUERIES[name](spark, SF_DIR)
    cursor = db.execute(queries.ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(ours.columns)
    assert check.rows_of(ours.columns, ours.collect()) == check.rows_of(columns, cursor.fetchall())


def test_run_keeps_one_of_each_near_group(spark, docs, tmp_path):
    """All pairs at 0.8: block edits, tails, scattered edits and an original with many variants."""
    texts = [t for t in hard() if (t or "").strip()]
    docs([document(i, t) for i, t in enumerate(texts)]).write.parquet(f"{tmp_path}/documents.parquet")
    truth = similar_pairs(texts)
    root = slow_components(list(range(len(texts))), lambda x, y: (y, x) in truth)
    kept = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}
    groups = len(set(root))
    assert {root[d] for d in kept} == set(root) and len(kept) - groups <= 0.05 * (len(texts) - groups)
