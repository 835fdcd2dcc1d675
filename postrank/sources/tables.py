"""Stored tables of postings: cleaned by date, scored, and the views on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postrank.schemas import SILVER, SILVER_COLUMNS, require_columns
from postrank.storage import free, written

#: What Gold is clustered by, all descending; readers ask for the first.
GOLD_ORDER = ("matching_score", "ingestion_date", "published_at")
#: Small enough for a threshold to fall between row groups of a file.
ROW_GROUP_BYTES = 32 << 20
#: The folder of the counts by score; readers of the table pass over names that begin so.
SCORES = "_scores"


def write_silver(silver: DataFrame, path: str, replace_all: bool = True) -> None:
    """Write cleaned postings by ingestion date.

    ``replace_all`` replaces the table; otherwise only the dates written.
    """
    require_columns(silver, SILVER_COLUMNS, "before the write")
    mode = "static" if replace_all else "dynamic"
    writer = silver.select(*SILVER_COLUMNS).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy("ingestion_date").parquet(path)


def read_silver(spark: SparkSession, path: str, row: str | None = None) -> DataFrame:
    """Cleaned postings; ``row`` adds a column that names each by its file and place there."""
    named = [F.struct("_metadata.file_path", "_metadata.row_index").alias(row)] if row else []
    return spark.read.schema(SILVER).parquet(path).select(*SILVER_COLUMNS, *named)


def write_gold(gold: DataFrame, path: str, files: int | None = None) -> None:
    """Write scored postings from the best score to the worst, across files and within them.

    A reader that asks for a least score then skips whole files and row groups by
    their statistics. Equal scores are cut by date and by a digest, so that no task
    gets all rows of a score. The scored rows are stored once before: a range
    sort samples its input, which would score everything twice. ``files`` (default:
    the session's shuffle partitions, joined when small) is the number of files.
    ``_scores`` beside the files says how many rows each score has.
    """
    scored = written(gold, "scored")
    order = [F.desc_nulls_last(c) for c in GOLD_ORDER] + [F.md5(F.col("url")).asc_nulls_last()]
    dealt = scored.repartitionByRange(files, *order) if files else scored.repartitionByRange(*order)
    sorted_ = dealt.sortWithinPartitions(*order)
    sorted_.write.mode("overwrite").option("parquet.block.size", ROW_GROUP_BYTES).parquet(path)
    scored.groupBy("matching_score").count().coalesce(1).write.parquet(f"{path}/{SCORES}")
    free(scored)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """(matching_score, count) of a stored Gold: at most a row for each whole score."""
    return spark.read.parquet(f"{path}/{SCORES}")


def save_gold_table(gold: DataFrame, name: str) -> None:
    gold.write.mode("overwrite").format("parquet").saveAsTable(name)


def sync_partitions(spark: SparkSession, table: str) -> None:
    """Make a catalog table show the partitions now on storage, and no others.

    Path-based reads do not need this.
    """
    spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    spark.catalog.refreshTable(table)
