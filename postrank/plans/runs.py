"""Whole runs, from raw pages to stored payloads, and from these to stored scores."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postrank.config import RankingConfig
from postrank.operators.clean import build_silver
from postrank.operators.dedupe import ROW
from postrank.operators.quality import (
    ERROR, enforce, gold_report, ranking_report, silver_checks, silver_report, split_rows, staging_report, with_failures,
)
from postrank.operators.ranking import ranking, ranking_view
from postrank.operators.scoring import build_gold, staging_view
from postrank.operators.similarity import profile_vector
from postrank.sources.bronze import rejected_of_all, stage_all, write_envelopes
from postrank.sources.pages import assemble_pages, normalize_envelopes, quarantine
from postrank.sources.runlog import log_run
from postrank.sources.tables import read_silver, write_gold, write_silver
from postrank.storage import publish, remove, written


class Paths(NamedTuple):
    bronze: str
    silver: str
    gold: str
    log: str


class RunResult(NamedTuple):
    postings: int
    per_source: dict[str, int]
    rejected: list[tuple[str, str, int]]
    warnings: list[str]
    ranking: DataFrame


def ingest(raw: DataFrame, root: str, keys: list[str]) -> DataFrame:
    """Raw pages to stored payloads; returns the pages set aside, with the problem of each.

    ``raw`` has ``source``, ``keyword``, ``ingested_at`` (timestamp), ``page``,
    ``payload`` and the columns of ``keys``, which name a series of pages. Every
    page that counts becomes one stored payload, which staging reads back.
    """
    normalized = written(normalize_envelopes(raw), "pages")
    good, bad = quarantine(normalized)
    write_envelopes(assemble_pages(good.drop("payload"), keys), root)
    return bad


def quarantine_path(paths: Paths) -> str:
    """Where rows are that failed an error-level check of the last run."""
    return f"{paths.silver}.quarantine"


def run_silver(
    spark: SparkSession, cfg: RankingConfig, paths: Paths,
    embed: Callable[[Column], Column] | None = None, multi_line: bool = True, layout: str = "{folder}",
    set_aside: bool = False,
) -> tuple[int, dict[str, int], list[tuple[str, str, int]], list[str]]:
    """Stage, clean, check and publish; log the outcome.

    Rows that fail an error-level check are kept, with what they fail, in
    ``quarantine_path`` beside the table, whether the run goes on or not; a run
    without such rows leaves an empty one. With ``set_aside`` the run goes on with the
    other rows.

    Returns rows written, rows staged per source, payloads rejected (source,
    problem, number) and warnings. Staged postings are stored once: they are
    counted there, and a task run again counts nothing twice. A failing
    error-level check leaves the old table in place.
    """
    made = f"{paths.silver}.new-{uuid.uuid4().hex}"
    try:
        staged = written(stage_all(spark, paths.bronze, multi_line, layout).withColumn(ROW, F.monotonically_increasing_id()), "staged")
        per_source = dict.fromkeys(cfg.source_quality, 0)
        per_source |= {r["source_name"]: r["count"] for r in staged.groupBy("source_name").count().collect()}
        broken = rejected_of_all(spark, paths.bronze, multi_line, layout)
        rejected = sorted(tuple(r) for r in broken.groupBy("source_name", "problem").count().collect())
        write_silver(build_silver(staged, cfg, embed, ROW), made)
        silver = read_silver(spark, made)
        kept, bad = split_rows(with_failures(silver, silver_checks(), {"job_id": ERROR}))
        bad.write.mode("overwrite").parquet(quarantine_path(paths))
        if set_aside:
            whole, made = made, f"{paths.silver}.new-{uuid.uuid4().hex}"
            write_silver(kept, made)
            remove(spark, whole)
            silver = read_silver(spark, made)
        warnings = enforce(silver_report(silver).unionByName(staging_report(staging_view(silver))).distinct())
        rows = silver.count()
        publish(spark, made, paths.silver)
        log_run(spark, paths.log, "SUCCESS", cfg.as_of, count=rows)
        return rows, per_source, rejected, warnings
    except Exception as failure:
        log_run(spark, paths.log, "FAILED", cfg.as_of, error=str(failure))
        raise


def run_gold(
    spark: SparkSession, cfg: RankingConfig, paths: Paths, profiles: DataFrame
) -> tuple[DataFrame, list[str]]:
    """Score the stored postings, check and publish; the table as read back, and warnings."""
    profile = profile_vector(profiles, dim=cfg.vector_dim)
    gold = build_gold(read_silver(spark, paths.silver, ROW), cfg, profile, ROW)
    made = f"{paths.gold}.new-{uuid.uuid4().hex}"
    write_gold(gold, made)
    stored = spark.read.schema(gold.schema).parquet(made)
    warnings = enforce(gold_report(stored)) + enforce(ranking_report(ranking(stored, cfg)))
    publish(spark, made, paths.gold)
    return spark.read.schema(gold.schema).parquet(paths.gold), warnings


def publish_views(silver: DataFrame, gold: DataFrame, cfg: RankingConfig) -> None:
    """Name the staging and the ranking view for SQL readers of this session."""
    staging_view(silver).createOrReplaceTempView("staged_postings")
    ranking_view(gold, cfg).createOrReplaceTempView("ranked_postings")


def run(
    spark: SparkSession, cfg: RankingConfig, paths: Paths, profiles: DataFrame,
    embed: Callable[[Column], Column] | None = None, multi_line: bool = True, layout: str = "{folder}",
    set_aside: bool = False,
) -> RunResult:
    """The whole job, with its views. Failing error-level checks raise before anything is
    replaced; with ``set_aside`` rows of Silver that fail one are only set aside."""
    rows, per_source, rejected, warnings = run_silver(spark, cfg, paths, embed, multi_line, layout, set_aside)
    gold, more = run_gold(spark, cfg, paths, profiles)
    publish_views(read_silver(spark, paths.silver), gold, cfg)
    return RunResult(rows, per_source, rejected, warnings + more, ranking_view(gold, cfg))
