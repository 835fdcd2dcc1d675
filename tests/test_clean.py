import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from postrank.operators import clean
from postrank.operators.dedupe import dedupe_by_both, dedupe_by_fingerprint, dedupe_by_id, dedupe_by_url, keep_latest
from postrank.schemas import SILVER_COLUMNS, require_columns
from tests.conftest import DEFAULTS


def test_columns_of_a_cleaned_posting(staged, cfg):
    silver = clean.build_silver(staged({"description": "A job in Nantes using Python and AWS.", "salary_info": "45k"}), cfg)
    assert tuple(silver.columns) == SILVER_COLUMNS
    row = silver.first()
    assert row["extracted_skills"] == ["python", "aws"] and row["salary_min_numeric"] == 45000
    assert row["data_quality_score"] == 0.75 and len(row["description_vector"]) == cfg.vector_dim
    assert str(row["ingestion_date"]) == "2025-02-01" and str(row["published_at"]) == "2025-01-01 00:00:00"
    kinds = dict(silver.dtypes)
    assert kinds["description_vector"] == "array<float>" and kinds["exp_min_required"] == "double"
    assert kinds["salary_min_numeric"] == "int" and kinds["ingestion_date"] == "date"


def test_missing_columns_are_named(staged, cfg):
    with pytest.raises(ValueError, match="missing required columns after the union of sources: title, url"):
        clean.build_silver(staged({}).drop("url", "title"), cfg)
    assert require_columns(staged({}), ["title"]).columns


def test_same_job_from_two_sources_is_one_row(staged, cfg):
    df = staged({"job_id": "1", "created_at": "2025-01-01T00:00:00Z"},
                {"job_id": "2", "source_name": "Jooble", "created_at": "2025-01-02T00:00:00Z"})
    assert [r["job_id"] for r in clean.distinct_postings(df, cfg).collect()] == ["2"]


def test_newest_wins(staged, cfg):
    df = staged({"job_id": "old", "created_at": "2024-01-01T00:00:00Z"}, {"job_id": "new"})
    assert [r["job_id"] for r in clean.build_silver(df, cfg).collect()] == ["new"]


def test_quality_weights_and_flags(staged, cfg):
    sources = ["France Travail", "JSearch", "Adzuna", "Jooble"]
    df = staged(*[{"job_id": str(i), "title": f"T{i}", "source_name": s} for i, s in enumerate(sources)],
                {"job_id": "j", "title": "Junior Data Engineer",
                 "description": "Great junior position with remote work possible."})
    rows = {r["title"]: r for r in clean.build_silver(df, cfg).collect()}
    assert [rows[f"T{i}"]["data_quality_score"] for i in range(4)] == [1.0, 1.0, 0.75, 0.75]
    junior = rows["Junior Data Engineer"]
    assert junior["is_junior"] and not junior["is_red_flag"] and junior["is_remote"]


def test_markup_stays_in_the_description_only(staged, cfg):
    row = clean.build_silver(staged({"description": "<b>py</b>thon&nbsp;<i>sql</i>..."}), cfg).first()
    assert row["description"] == "<b>py</b>thon <i>sql</i>" and row["extracted_skills"] == ["sql"]


def test_ties_are_settled_the_same_way_whatever_the_layout(staged, cfg):
    rows = [{"url": u, "description": d} for u in ("b", "a", None) for d in ("2", "1")]
    picks = set()
    for parts in (1, 2, 5):
        df = clean.normalise(staged(*rows), cfg).repartition(parts)
        picks |= {(r["url"], r["description"]) for r in dedupe_by_id(df).collect()}
        rows.reverse()
    digest = lambda d: hashlib.md5("\x1f".join((DEFAULTS["title"], DEFAULTS["company_name"], d)).encode()).hexdigest()
    assert picks == {("a", min("12", key=digest))}


def test_rows_without_a_key_stay(staged, cfg):
    df = clean.normalise(staged({"job_id": None}, {"job_id": None, "title": "B"}), cfg)
    assert dedupe_by_id(df).count() == 2 and dedupe_by_id(df, keyless="one").count() == 1
    bare = {"title": None, "company_name": None, "location": None}
    df = clean.normalise(staged(bare, bare | {"job_id": "2"}, {}), cfg)
    assert dedupe_by_fingerprint(df).count() == 3 and dedupe_by_fingerprint(df, keyless="one").count() == 2
    df = df.withColumns({"url": F.lit(None).cast("string"), "job_id": F.lit(None).cast("string"), "ingestion_date": F.lit(1)})
    assert dedupe_by_url(df).count() == 3 and dedupe_by_url(df, keyless="one").count() == 1


def test_equal_rows_leave_one(staged, cfg):
    assert clean.build_silver(staged({}, {}, {}), cfg).count() == 1


def test_url_groups_fall_back_to_the_id(spark):
    rows = [("1", "u", "2025-01-02", 1), ("2", "u", "2025-01-03", 1), ("3", None, "2025-01-01", 1),
            ("3", None, "2025-01-01", 2), ("u", None, "2025-01-01", 1)]
    df = spark.createDataFrame(rows, "job_id string, url string, published_at string, ingestion_date int")
    df = df.withColumns({"source_name": F.lit("s"), "description": F.lit("d")})
    kept = {(r["job_id"], r["ingestion_date"]) for r in dedupe_by_url(df).collect()}
    assert kept == {("2", 1), ("3", 2)}


def test_hot_key_against_brute_force(spark):
    """A third of all rows share one key; nothing is lost or doubled."""
    rng = random.Random(3)
    rows = [(0 if i % 3 == 0 else rng.randrange(400), rng.randrange(50), i) for i in range(6000)]
    best = defaultdict(lambda: (-1, 0))
    for k, t, i in rows:
        best[k] = max(best[k], (t, -i))
    df = spark.createDataFrame(rows, "k int, t int, i int").repartition(6)
    got = {r["k"]: (r["t"], -r["i"]) for r in keep_latest(df, ["k"], ["t"], ["i"]).collect()}
    assert got == dict(best)


def test_each_dedupe_limits_groups_before_its_shuffle(staged, cfg):
    df = dedupe_by_both(clean.normalise(staged({}), cfg).withColumn("row", F.lit(1)), "row")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("1, Partial") == 2 and plan.count("1, Final") == 2
    assert plan.count("LeftSemi") == 1


def test_windows_and_sorts_see_no_text(staged, cfg, spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        silver = clean.normalise(staged({}), cfg).withColumns({"row": F.lit(1), "ingestion_date": F.lit(1)})
        for df in (dedupe_by_id(silver, "row"), dedupe_by_both(silver, "row"), dedupe_by_url(silver, "row")):
            lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
            windows = [line for line in lines if "Window" in line or "hashpartitioning" in line or "Sort [" in line]
            assert windows and not any("description" in line for line in windows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_costly_work_comes_after_the_dedupes(staged, cfg):
    plan = clean.build_silver(staged({}), cfg)._jdf.queryExecution().executedPlan().toString()
    python, pattern, last_dedupe = plan.index("ArrowEvalPython"), plan.index("terraform"), plan.index("WindowGroupLimit")
    assert python < last_dedupe and pattern < last_dedupe
