"""Rows that fail checks: which, why, and what becomes of them in a run."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from postrank.config import RankingConfig
from postrank.operators.quality import (
    ERROR, WARN, accepted_values, failing_rows, not_blank, not_null, ranges, run_checks, split_rows, unique, with_failures,
)
from postrank.plans.runs import Paths, quarantine_path, run_silver
from postrank.sources.bronze import FOLDERS
from postrank.sources.runlog import read_log
from tests.conftest import AS_OF

ROWS = [
    ("1", "Jooble", 5.0, "u", "a"), ("2", "Elsewhere", 5.0, " ", "b"), ("2", "Adzuna", 500.0, None, "c"), (None, "Adzuna", None, "u", "d"),
    (None, None, 1.0, "u", "e"), ("3", "Adzuna", 1.0, "u", "f"),
]
CHECKS = lambda: not_null({"job_id": ERROR, "source_name": WARN}) + accepted_values("source_name") + ranges({"score": (0, 100)}) + not_blank("url")


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "job_id string, source_name string, score double, url string, name string")


def test_every_row_has_what_it_fails(rows):
    marked = with_failures(rows, CHECKS(), {"job_id": ERROR})
    assert marked.columns == [*rows.columns, "failed", "errors"]
    found = {r["name"]: (r["failed"], r["errors"]) for r in marked.collect()}
    assert found == {
        "a": ([], []), "f": ([], []),
        "b": (["accepted_values(source_name)", "not_blank(url)", "unique(job_id)"], ["accepted_values(source_name)", "unique(job_id)"]),
        "c": (["range(score)", "not_blank(url)", "unique(job_id)"], ["range(score)", "unique(job_id)"]),
        "d": (["not_null(job_id)"], ["not_null(job_id)"]),
        "e": (["not_null(job_id)", "not_null(source_name)"], ["not_null(job_id)"]),
    }


def test_counts_agree_with_the_report(rows):
    failing = failing_rows(rows, CHECKS(), {"job_id": ERROR}).withColumn("one", F.explode("failed")).groupBy("one").count()
    report = run_checks(rows, CHECKS()).unionByName(unique(rows, "job_id")).filter("failing > 0").collect()
    want = {f"{r['check']}({r['column']})": r["failing"] for r in report}
    got = {r["one"]: r["count"] for r in failing.collect()}
    assert got.pop("unique(job_id)") == 2 and want.pop("unique(job_id)") == 1  # rows here, keys there
    assert got == want


def test_split(rows):
    kept, bad = split_rows(with_failures(rows, CHECKS(), {"job_id": ERROR}))
    assert kept.columns == rows.columns and sorted(r["name"] for r in kept.collect()) == ["a", "f"]
    assert sorted(r["name"] for r in bad.collect()) == ["b", "c", "d", "e"]


def test_no_checks_and_no_rows(rows):
    assert failing_rows(rows, []).count() == 0
    assert failing_rows(rows.limit(0), CHECKS(), {"job_id": ERROR}).count() == 0


def test_one_pass_without_a_shuffle_of_whole_rows(rows):
    plan = failing_rows(rows, CHECKS())._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


@pytest.fixture
def paths(tmp_path):
    for folder in FOLDERS.values():
        (Path(tmp_path) / "bronze" / folder).mkdir(parents=True)
        (Path(tmp_path) / "bronze" / folder / "none.json").write_text('{"count": 0, "results": [], "keyword": "none"}')
    root = Path(tmp_path) / "bronze" / FOLDERS["Jooble"]
    jobs = [
        {"id": "1", "title": "Data Engineer", "snippet": "python", "location": "Nantes", "link": "https://x/1", "updated": "2025-01-30T00:00:00Z"},
        {"id": None, "title": "Data Analyst", "snippet": "dbt", "location": "Paris", "link": "https://x/2", "updated": "2025-01-30T00:00:00Z"},
    ]
    (root / "a.json").write_text(json.dumps({"count": 2, "results": jobs, "keyword": "data"}))
    return Paths(f"{tmp_path}/bronze", f"{tmp_path}/silver", f"{tmp_path}/gold", f"{tmp_path}/log")


def test_a_run_keeps_what_fails_beside_the_table(spark, paths):
    cfg = RankingConfig(as_of=AS_OF, vector_dim=8)
    with pytest.raises(ValueError, match="job_id"):
        run_silver(spark, cfg, paths)
    held = spark.read.parquet(quarantine_path(paths)).collect()
    assert [(r["title"], r["errors"]) for r in held] == [("Data Analyst", ["not_null(job_id)"])]
    rows, *_ = run_silver(spark, cfg, paths, set_aside=True)
    assert rows == 1 and [r["title"] for r in spark.read.parquet(paths.silver).collect()] == ["Data Engineer"]
    assert spark.read.parquet(quarantine_path(paths)).count() == 1
    assert [r["status"] for r in read_log(spark, paths.log).orderBy("status").collect()] == ["FAILED", "SUCCESS"]


def test_a_clean_run_leaves_an_empty_quarantine(spark, paths):
    cfg = RankingConfig(as_of=AS_OF, vector_dim=8)
    path = Path(paths.bronze) / "jooble" / "a.json"
    path.write_text(path.read_text().replace("null", '"2"'))
    assert run_silver(spark, cfg, paths)[0] == 2
    assert spark.read.parquet(quarantine_path(paths)).count() == 0
