import json

import pytest
from pyspark.sql import functions as F

from postrank.__main__ import main
from postrank.config import RankingConfig
from postrank.plans.runs import Paths, ingest, run, run_gold, run_silver
from postrank.sources.profile import build_profiles, write_profiles
from postrank.sources.runlog import latest_run, read_log
from postrank.sources.bronze import stage_written
from postrank.sources.tables import read_silver

AS_OF = "2025-01-03 00:00:00"
JOBS = [
    ("jooble", {"id": 1, "title": "Data Engineer Junior", "company": "SCOP Verte", "location": "44 - Nantes", "link": "a",
                "snippet": "python, dbt, spark, aws, télétravail, mentorat, b corp", "updated": "2025-01-02"}),
    ("adzuna", {"id": 1, "title": "data engineer junior", "company": {"display_name": "Scop Verte"}, "description": "x",
                "location": {"display_name": "Nantes"}, "created": "2025-01-01", "redirect_url": "b"}),
    ("jsearch", {"job_id": "s", "job_title": "Stage Data", "employer_name": "Banque", "job_apply_link": "c",
                 "job_description": "stage", "job_city": "Nantes", "job_posted_at_datetime_utc": "2025-01-02"}),
    ("france_travail", {"id": "f", "intitule": "Data Analyst", "description": "3 ans d'expérience, sql",
                        "dateCreation": "2025-01-02T10:00:00Z"}),
]


@pytest.fixture
def paths(tmp_path):
    for source, job in JOBS:
        folder = tmp_path / "bronze" / source / "2025" / "01" / "02"
        folder.mkdir(parents=True)
        (folder / "data_120000.json").write_text(json.dumps({"count": 1, "results": [job]}, indent=2))
    return Paths(*[str(tmp_path / name) for name in ("bronze", "silver", "gold", "log")])


def test_whole_run(spark, paths):
    cfg = RankingConfig(as_of=AS_OF, vector_dim=64)
    profiles = build_profiles(spark.createDataFrame([("me", "junior python dbt spark")], "profile_id string, text string"), 64)
    profiles = profiles.withColumn("ideal_vector", F.from_json("ideal_vector", "array<double>"))
    result = run(spark, cfg, paths, profiles)
    assert result.postings == 3
    assert result.per_source == {"France Travail": 1, "JSearch": 1, "Adzuna": 1, "Jooble": 1}
    assert result.rejected == []
    assert sorted(set(result.warnings)) == ["not_blank(url): 1", "not_null(url): 1"]
    assert [r["title"] for r in result.ranking.collect()] == ["Data Engineer Junior"]
    assert tuple(latest_run(read_log(spark, paths.log)).first()) == ("SUCCESS", AS_OF, 3)
    gold = {r["job_id"]: r for r in spark.read.parquet(paths.gold).collect()}
    assert sorted(gold) == ["1", "f", "s"] and gold["1"]["source_name"] == "Jooble"
    assert gold["s"]["negative_labels"] == "🚫 Stage/Alternance | 🏦 Secteur Sensible"
    assert gold["f"]["company_name"] == "Non renseigné" and gold["f"]["exp_min_required"] == 3
    assert spark.sql("SELECT count(*), count(job_location) FROM staged_postings").first()[0] == 3
    assert [r["city"] for r in spark.sql("SELECT city FROM ranked_postings").collect()] == ["Nantes"]
    assert run(spark, cfg, paths, profiles).postings == 3


def test_command_line(spark, paths, tmp_path, capsys):
    texts = spark.createDataFrame([("me", "junior python dbt spark")], "profile_id string, text string")
    write_profiles(build_profiles(texts, 384), f"{tmp_path}/profiles")
    main(["--bronze", paths.bronze, "--silver", paths.silver, "--gold", paths.gold, "--log", paths.log,
          "--profiles", f"{tmp_path}/profiles", "--as-of", AS_OF])
    out = capsys.readouterr().out
    assert "3 postings" in out and "not_null(url): 1" in out and "Data Engineer Junior" in out


def test_custom_embedder_and_failure_log(spark, paths):
    cfg = RankingConfig(as_of=AS_OF, vector_dim=2)
    length = lambda text: F.array(F.length(text).cast("float"), F.lit(1.0).cast("float"))
    assert run_silver(spark, cfg, paths, embed=length)[0] == 3
    assert all(len(r["description_vector"]) == 2 for r in read_silver(spark, paths.silver).collect())

    with pytest.raises(Exception, match="no such column|cannot be resolved|UNRESOLVED"):
        run_silver(spark, cfg, paths, embed=lambda text: F.col("no_such_column"))
    last = read_log(spark, paths.log).filter("status = 'FAILED'").first()
    assert "no_such_column" in last["error_message"] and last["records_count"] == 0


def test_broken_payloads_are_counted(spark, paths, capsys):
    from pathlib import Path

    for name, text in (("x.json", "oops"), ("y.json", '{"results": 3}'), ("z.json", '{"results": "t"}')):
        (Path(paths.bronze) / "jooble" / name).write_text(text)
    cfg = RankingConfig(as_of=AS_OF, vector_dim=8)
    rows, staged, rejected, _ = run_silver(spark, cfg, paths)
    assert rows == 3 and sum(staged.values()) == 4
    assert rejected == [("Jooble", "fields of another kind", 2), ("Jooble", "not a JSON object", 1)]


def test_failing_checks_leave_the_old_tables(spark, paths, monkeypatch):
    import os

    cfg = RankingConfig(as_of=AS_OF, vector_dim=8)
    profiles = spark.createDataFrame([("me", [1.0] * 8)], "profile_id string, ideal_vector array<double>")
    run(spark, cfg, paths, profiles)
    before = {p: sorted(map(tuple, spark.read.parquet(p).drop("description_vector").collect()), key=str) for p in (paths.silver, paths.gold)}
    bad = RankingConfig(as_of=AS_OF, vector_dim=8, source_quality={"Jooble": 7.0})
    run_silver(spark, bad, paths)
    with pytest.raises(ValueError, match="data_quality_score"):
        run_gold(spark, bad, paths, profiles)
    assert sorted(map(tuple, spark.read.parquet(paths.gold).drop("description_vector").collect()), key=str) == before[paths.gold]
    run_silver(spark, cfg, paths)
    monkeypatch.setattr("postrank.plans.runs.build_silver", lambda staged, cfg, embed, row: _without_id(staged, cfg, embed, row))
    with pytest.raises(ValueError, match="job_id"):
        run_silver(spark, cfg, paths)
    assert sorted(map(tuple, spark.read.parquet(paths.silver).drop("description_vector").collect()), key=str) == before[paths.silver]
    last = read_log(spark, paths.log).filter("status = 'FAILED'").first()
    assert "job_id" in last["error_message"] and os.path.isdir(paths.silver)


def _without_id(staged, cfg, embed, row):
    from postrank.operators.clean import build_silver

    return build_silver(staged, cfg, embed, row).withColumn("job_id", F.lit(None).cast("string"))


def test_profile_errors_come_before_the_work(spark, paths):
    cfg = RankingConfig(as_of=AS_OF, vector_dim=8)
    run_silver(spark, cfg, paths)
    with pytest.raises(ValueError, match="profile me has 3 numbers, not 8"):
        run_gold(spark, cfg, paths, spark.createDataFrame([("me", [1.0] * 3)], "profile_id string, ideal_vector array<double>"))


def test_pages_to_postings(spark, tmp_path):
    pages = [
        ("jooble", "Data", 1, '{"totalCount": 9, "jobs": [{"id": 1, "title": "A"}, {"id": 2, "title": "B", "x": {"y": 1}}]}'),
        ("jooble", "Data", 2, '{"jobs": [{"id": 3, "title": "C"}]}'), ("jooble", "Data", 3, '{"jobs": []}'),
        ("jooble", "Data", 4, '{"jobs": [{"id": 4}]}'), ("jsearch", "Data", 1, '{"data": [{"job_id": "j"}]}'),
        ("adzuna", "Data", 1, '{"results": "not_a_list"}'), ("adzuna", "Data", 2, '{"results": [{"id": "late"}]}'), ("adzuna", "Dev", 1, "oops"),
    ]
    raw = spark.createDataFrame(pages, "source string, keyword string, page int, payload string")
    raw = raw.withColumn("ingested_at", F.to_timestamp(F.lit("2025-01-02 03:04:05")))
    bad = ingest(raw, f"{tmp_path}/bronze", ["source", "keyword"])
    assert sorted((r["keyword"], r["problem"], r["payload"]) for r in bad.collect()) == [
        ("Data", "results is not a list", '{"results": "not_a_list"}'), ("Dev", "not a JSON object", "oops")]
    staged = stage_written(spark, f"{tmp_path}/bronze").collect()
    assert sorted((r["job_id"], r["title"], r["source_name"]) for r in staged) == [
        ("1", "A", "Jooble"), ("2", "B", "Jooble"), ("3", "C", "Jooble"), ("j", None, "JSearch")]
