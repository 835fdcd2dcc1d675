import json
import os
import shutil
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from postrank.schemas import STAGED_COLUMNS
from postrank.sources import bronze, pages, profile, runlog, tables
from postrank.storage import clear, publish, scratch_dir, written

RESULTS = {
    "adzuna": {"id": 12, "title": "T", "company": {"display_name": "C"}, "description": "d", "salary_min": 45000,
               "location": {"display_name": "L"}, "created": "2025-01-01T00:00:00Z", "redirect_url": "u"},
    "france_travail": {"id": "ft", "intitule": "T", "description": "d", "lieuTravail": {"libelle": "44 - NANTES"},
                       "salaire": {"libelle": "38k", "minimum": 38000, "autre": {"a": [1]}}, "dateCreation": "2025-01-01",
                       "origineOffre": {"urlOrigine": "u"}},
    "jsearch": {"job_id": "js", "job_title": "T", "employer_name": "C", "job_description": "d", "job_city": "Nantes",
                "job_country": "FR", "job_posted_at_datetime_utc": "2025-01-01", "job_apply_link": "u"},
    "jooble": {"id": -5, "title": "T", "company": "C", "snippet": "d", "location": "L", "salary": "45k",
               "updated": "2025-01-01", "link": "u"},
}
WANT = {
    "adzuna": ("12", "T", "C", "d", "L", "45000.0", "2025-01-01T00:00:00Z", "u", "Adzuna"),
    "france_travail": ("ft", "T", "Non renseigné", "d", "44 - NANTES", '{"libelle":"38k","minimum":38000,"autre":{"a":[1]}}', "2025-01-01", "u",
                       "France Travail"),
    "jsearch": ("js", "T", "C", "d", "Nantes, FR", None, "2025-01-01", "u", "JSearch"),
    "jooble": ("-5", "T", "C", "d", "L", "45k", "2025-01-01", "u", "Jooble"),
}


def put(root: Path, source: str, name: str, payload) -> None:
    """One pretty-printed object per file below a dated folder."""
    path = root / source / "2025" / "01" / "02" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(payload if isinstance(payload, str) else json.dumps(payload, indent=1, ensure_ascii=False))


@pytest.fixture
def bronze_root(tmp_path):
    for source, result in RESULTS.items():
        put(tmp_path, source, "data_engineer_120000.json",
            {"count": 1, "results": [result], "keyword": "Data Engineer", "ingested_at": "2025-01-02"})
        put(tmp_path, source, "empty_120000.json", {"count": 0, "results": [], "keyword": "x"})
        put(tmp_path, source, "none_120000.json", {"keyword": "x"})
    return tmp_path


@pytest.mark.parametrize("source", RESULTS)
def test_staging(spark, bronze_root, source):
    name = {folder: s for s, folder in bronze.FOLDERS.items()}[source]
    df = bronze.STAGERS[name](spark, f"{bronze_root}/{source}")
    assert tuple(df.columns) == STAGED_COLUMNS and all(kind == "string" for _, kind in df.dtypes)
    assert [tuple(r) for r in df.collect()] == [WANT[source]]


def test_missing_fields_are_null(spark, tmp_path):
    put(tmp_path, "adzuna", "a.json", {"results": [{"id": "1"}, {"id": "2", "unknown": [1]}]})
    rows = bronze.stage_adzuna(spark, f"{tmp_path}/adzuna").collect()
    assert sorted(r["job_id"] for r in rows) == ["1", "2"] and rows[0]["title"] is None


def test_union_keeps_every_row(spark, bronze_root):
    df = bronze.stage_all(spark, str(bronze_root))
    assert sorted(map(tuple, df.collect()), key=str) == sorted(WANT.values(), key=str)
    assert df.union(df).count() == 8
    with pytest.raises(Exception, match="title"):
        bronze.union_sources([df, df.drop("title")]).collect()


def test_written_envelopes_read_back(spark, tmp_path):
    result = F.struct(F.lit("7").alias("id"), F.lit("T\nx").alias("title"), F.lit("u").alias("link"))
    envelopes = spark.range(3).select(
        F.lit("jooble").alias("source"), F.lit("Data Engineer").alias("keyword"),
        F.to_timestamp(F.lit("2025-01-02 03:04:05")).alias("ingested_at"), F.array(result, result).alias("results"))
    root = f"{tmp_path}/bronze"
    bronze.write_envelopes(envelopes, root)
    folder = Path(root) / "source=jooble" / "year=2025" / "month=01" / "day=02"
    line = json.loads(next(folder.glob("part-*")).read_text().splitlines()[0])
    assert line["file_key"] == "data_engineer_030405" and line["ingested_at"] == "2025-01-02T03:04:05"
    rows = bronze.stage_jooble(spark, f"{root}/source=jooble", multi_line=False).collect()
    assert len(rows) == 6 and {(r["job_id"], r["title"], r["url"]) for r in rows} == {("7", "T\nx", "u")}


def test_written_payloads_of_raw_results(spark, tmp_path):
    """Items of any fields go to Bronze as they came; texts are refused."""
    items = F.from_json(F.lit('[{"id":"1","title":"A","x":{"y":[1,null]}},{"id":2}]'), "array<variant>")
    rows = spark.range(1).select(
        F.lit("adzuna").alias("source"), F.lit("k").alias("keyword"), F.to_timestamp(F.lit("2025-01-02 03:04:05")).alias("ingested_at"),
        items.alias("results"))
    bronze.write_envelopes(rows, f"{tmp_path}/b")
    assert {(r["job_id"], r["title"]) for r in bronze.stage_written(spark, f"{tmp_path}/b").collect()} == {("1", "A"), ("2", None)}
    text = (next((tmp_path / "b").rglob("part-*"))).read_text()
    assert json.loads(text)["results"][0] == {"id": "1", "title": "A", "x": {"y": [1, None]}}
    with pytest.raises(ValueError, match="VARIANT"):
        bronze.write_envelopes(rows.withColumn("results", F.array(F.lit("a"))), f"{tmp_path}/b")
    assert bronze.stage_written(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.parametrize("multi_line", [True, False])
def test_rejected_payloads(spark, tmp_path, multi_line):
    good = {"results": [RESULTS["jooble"]], "keyword": "k", "file_key": "k_1"}
    bad = ['{"results": "x"}', "oops", "[1]"]
    (tmp_path / "jooble").mkdir()
    for i, text in enumerate([json.dumps(good), *bad] if multi_line else ["\n".join([json.dumps(good), "", *bad])]):
        (tmp_path / "jooble" / f"{i}.json").write_text(text)
    found = bronze.rejected_payloads(spark, f"{tmp_path}/jooble", "Jooble", multi_line).collect()
    assert sorted((r["problem"], r["payload"]) for r in found) == [
        ("fields of another kind", '{"results": "x"}'), ("not a JSON object", "[1]"), ("not a JSON object", "oops")]
    assert bronze.stage_jooble(spark, f"{tmp_path}/jooble", multi_line).count() == 1
    keys = bronze.file_keys(spark, f"{tmp_path}/jooble", "Jooble", multi_line).collect()
    assert [tuple(r) for r in keys] == [("k", "k_1", None, 1)]


def normalized(spark, *rows):
    return pages.normalize_envelopes(spark.createDataFrame(list(rows), "source string, payload string"))


@pytest.mark.parametrize("source, payload, count, results", [
    ("adzuna", '{"count": 7, "results": [{"id": 1}]}', 7, '[{"id":1}]'),
    ("adzuna", '{"results": [{"id": 1}]}', 0, '[{"id":1}]'),
    ("france_travail", '{"nbResultats": 3, "resultats": []}', 3, "[]"),
    ("france_travail", "{}", 0, "[]"),
    ("jooble", '{"jobs": [1, 2]}', 2, "[1,2]"),
    ("jooble", '{"totalCount": 9, "jobs": [1, 2]}', 9, "[1,2]"),
    ("jsearch", '{"count": 9, "data": [1]}', 1, "[1]"),
])
def test_envelope_shapes(spark, source, payload, count, results):
    row = normalized(spark, (source, payload)).first()
    assert (row["count"], row["problem"]) == (count, None) and [v.toPython() for v in row["results"]] == json.loads(results)


@pytest.mark.parametrize("source, payload, problem", [
    ("jooble", '{"jobs": "not_a_list"}', "results is not a list"), ("jooble", '{"jobs": null}', "results is not a list"),
    ("adzuna", '{"results": {"a": 1}}', "results is not a list"), ("adzuna", "oops", "not a JSON object"),
    ("adzuna", "[1]", "not a JSON object"), ("adzuna", None, "not a JSON object"), ("other", "{}", "unknown source"),
    (None, "{}", "unknown source"),
])
def test_quarantine(spark, source, payload, problem):
    good, bad = pages.quarantine(normalized(spark, (source, payload), ("jooble", '{"jobs": []}')))
    assert [r["problem"] for r in bad.collect()] == [problem] and good.count() == 1


def assembled(spark, *rows):
    df = spark.createDataFrame(list(rows), "k string, page int, count long, results array<string>")
    got = {}
    for r in sorted(pages.assemble_pages(df.repartition(3), ["k"]).collect(), key=lambda r: (str(r["k"]), r["page"])):
        total, results = got.setdefault(r["k"], (r["count"], []))
        assert total == r["count"]
        results.extend(r["results"])
    return got


def test_pages_stop_where_they_should(spark):
    got = assembled(
        spark,
        ("empty", 1, 5, ["a"]), ("empty", 2, 6, []), ("empty", 3, 7, ["c"]),
        ("cap", 1, 9, ["a"]), ("cap", 2, 9, ["b"]), ("cap", 3, 9, ["c", "d"]), ("cap", 4, 9, ["e"]),
        ("failed", 1, 5, ["a"]), ("failed", 3, 5, ["c"]), ("null", 1, None, ["a"]), ("null", 2, 5, None),
        ("none", 1, 4, []), ("late", 2, 3, ["b"]),
    )
    assert got == {"empty": (5, ["a"]), "cap": (9, ["a", "b", "c", "d", "e"]), "failed": (5, ["a"]), "null": (None, ["a"])}


def test_many_pages_and_null_keys(spark):
    rows = [("hot", n, 7, [str(n)]) for n in range(1, 200)] + [(None, 1, 3, ["x"]), (None, 2, 3, ["y"]), (None, 4, 3, ["z"])]
    assert assembled(spark, *rows) == {"hot": (7, [str(n) for n in range(1, 200)]), None: (3, ["x", "y"])}


def test_a_payload_is_parsed_once(spark):
    raw = spark.createDataFrame([("jooble", "{}")], "source string, payload string")
    for part in pages.quarantine(pages.normalize_envelopes(raw)):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parse_json") == 1 or plan.count("parseJson") == 1


def test_silver_round_trip(spark, staged, cfg, tmp_path):
    from postrank.operators.clean import build_silver

    silver = build_silver(staged({}, {"job_id": "2", "title": "B"}), cfg)
    path = f"{tmp_path}/silver"
    tables.write_silver(silver, path)
    assert (Path(path) / "ingestion_date=2025-02-01").is_dir()
    back = tables.read_silver(spark, path)
    assert back.schema.simpleString() == silver.schema.simpleString()
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, silver.collect()))

    later = silver.withColumn("ingestion_date", F.to_date(F.lit("2025-02-02")))
    tables.write_silver(later, path, replace_all=False)
    assert back.sparkSession.read.parquet(path).count() == 4
    tables.write_silver(later, path)
    assert tables.read_silver(spark, path).count() == 2
    pruned = tables.read_silver(spark, path).filter("ingestion_date = DATE'2025-02-02'").select("job_id")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull" in plan and "ReadSchema: struct<job_id:string>" in plan
    with pytest.raises(ValueError, match="is_remote"):
        tables.write_silver(silver.drop("is_remote"), path)


def test_partition_sync(spark, staged, tmp_path):
    df = staged({}).withColumn("day", F.lit("a"))
    path = f"{tmp_path}/t"
    df.write.partitionBy("day").parquet(path)
    spark.sql(f"CREATE TABLE sync_me USING parquet LOCATION '{path}'")
    try:
        tables.sync_partitions(spark, "sync_me")
        assert spark.table("sync_me").count() == 1
        for day in ("b", "c"):
            df.withColumn("day", F.lit(day)).write.mode("append").partitionBy("day").parquet(path)
        shutil.rmtree(f"{path}/day=a")
        tables.sync_partitions(spark, "sync_me")
        assert {r["day"] for r in spark.table("sync_me").collect()} == {"b", "c"}
        assert spark.sql("SHOW PARTITIONS sync_me").count() == 2
    finally:
        spark.sql("DROP TABLE sync_me")


def test_gold_as_a_named_table(spark, staged):
    tables.save_gold_table(staged({}, {"job_id": "2"}), "gold_named")
    try:
        tables.save_gold_table(staged({"job_id": "3"}), "gold_named")
        assert [r["job_id"] for r in spark.table("gold_named").collect()] == ["3"]
    finally:
        spark.sql("DROP TABLE gold_named")


def test_profile_round_trip(spark, tmp_path):
    texts = spark.createDataFrame([("p1", '\n Un "profil", ici\nsuite \n')], "profile_id string, text string")
    built = profile.build_profiles(texts, 16)
    path = f"{tmp_path}/profiles"
    profile.write_profiles(built, path)
    row = profile.read_profiles(spark, path).first()
    assert row["description"] == 'Un "profil", ici suite' and len(row["ideal_vector"]) == 16
    assert sum(x * x for x in row["ideal_vector"]) == pytest.approx(1, abs=1e-5)
    assert row["ideal_vector"] == pytest.approx(json.loads(built.first()["ideal_vector"]))


def test_profile_vector_that_is_no_list(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('profile_id,description,ideal_vector\np,"a ""b"", c","[0.5, -1]"\nq,d,oops\n')
    rows = {r["profile_id"]: r for r in profile.read_profiles(spark, str(path)).collect()}
    assert rows["p"]["ideal_vector"] == [0.5, -1.0] and rows["p"]["description"] == 'a "b", c'
    assert rows["q"]["ideal_vector"] is None


def test_run_log(spark, tmp_path):
    path = f"{tmp_path}/log"
    runlog.log_run(spark, path, "SUCCESS", "2025-01-01 00:00:00", count=42)
    runlog.log_run(spark, path, "FAILED", "2025-01-02 00:00:00", error="é" * 900)
    log = runlog.read_log(spark, path)
    rows = {r["status"]: r for r in log.collect()}
    assert rows["SUCCESS"]["records_count"] == 42 and rows["SUCCESS"]["error_message"] == ""
    assert rows["FAILED"]["error_message"] == "é" * 900
    assert len({r["run_id"] for r in rows.values()}) == 2
    assert tuple(runlog.latest_run(log).first()) == ("FAILED", "2025-01-02 00:00:00", 0)
    assert tuple(runlog.latest_run(log.filter("status = 'SUCCESS'")).first()) == ("SUCCESS", "2025-01-01 00:00:00", 42)
    assert tuple(runlog.latest_run(log.filter("false")).first()) == ("UNKNOWN", "N/A", 0)


def test_scratch_follows_the_shared_setting(spark):
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")

    def cluster(**settings):
        conf = SimpleNamespace(get=lambda key, default: settings.get(key.rsplit(".", 2)[1], default))
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="yarn", applicationId="app"))

    assert scratch_dir(cluster(checkpoint="store://shared/"), "x").startswith("store://shared/postrank/app/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(cluster(), "x")


def test_written_tables_are_cleared(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("postrank.storage.shared_folder", lambda spark: f"{tmp_path}/own")
    assert written(spark.range(3), "x").count() == 3 and os.listdir(f"{tmp_path}/own")
    clear(spark)
    assert not os.path.exists(f"{tmp_path}/own")


def test_publishing_replaces_a_folder(spark, tmp_path):
    for n in (3, 5):
        spark.range(n).write.parquet(f"{tmp_path}/new")
        publish(spark, f"{tmp_path}/new", f"{tmp_path}/t")
        assert spark.read.parquet(f"{tmp_path}/t").count() == n and os.listdir(tmp_path) == ["t"]
    with pytest.raises(FileNotFoundError):
        publish(spark, f"{tmp_path}/absent", f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 5
