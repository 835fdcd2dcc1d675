"""The log of runs: one row per run, append only."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postrank.functions.text import moment
from postrank.schemas import RUN_LOG

# --- Fixed value: name of the run in the log ---
LOGGED_SOURCE = "Silver_Pipeline"


def log_entries(runs: DataFrame) -> DataFrame:
    """Bring rows with the log's columns to its types; a NULL error is empty."""
    return runs.withColumn("error_message", F.coalesce("error_message", F.lit(""))).select(
        *[F.col(f.name).cast(f.dataType) for f in RUN_LOG.fields]
    )


def append_log(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)


def log_run(
    spark: SparkSession, path: str, status: str, run_at: str | datetime,
    count: int = 0, error: str = "", source_name: str = LOGGED_SOURCE,
) -> None:
    """Append one run."""
    row = spark.range(1, numPartitions=1).select(
        F.lit(uuid.uuid4().hex).alias("run_id"),
        moment(run_at).alias("run_at"),
        F.lit(status).alias("status"),
        F.lit(source_name).alias("source_name"),
        F.lit(count).alias("records_count"),
        F.lit(error).alias("error_message"),
    )
    append_log(log_entries(row), path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG).parquet(path)


def latest_run(log: DataFrame) -> DataFrame:
    """One row ``status, last_run, count``; UNKNOWN, N/A, 0 for an empty log."""
    last = log.agg(
        F.max_by(F.struct("status", "run_at", "records_count"), F.struct("run_at", "run_id")).alias("r")
    )
    return last.select(
        F.coalesce("r.status", F.lit("UNKNOWN")).alias("status"),
        F.coalesce(F.col("r.run_at").cast("string"), F.lit("N/A")).alias("last_run"),
        F.coalesce("r.records_count", F.lit(0)).alias("count"),
    )
