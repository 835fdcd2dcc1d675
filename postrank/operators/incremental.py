"""Winners of the dedupes kept up to date, batch after batch.

A table of winners lies in buckets by a hash of the key. A batch is merged by reading
only the buckets it has keys of, choosing among the rows there and the batch on
narrow rows, and writing those buckets again. Batch after batch, in any order and with
repeats, the table equals one dedupe of everything that ever came.

Rows are ordered by columns alone (dates, then ties, then a digest of the whole row, so
that the choice does not depend on where a row was stored). Rows without a key stay,
all of them, spread by their digest. One key can hold any share of a batch: the choice is
a ``row_number() = 1`` filter with a group limit before the shuffle, and the whole rows
come in by the name of the row.

Merging the same batch again changes nothing but rows without a key, which count again, as
they would in one dedupe of both. A merge that fails before its last step leaves the
table as it was; one that fails in that step is put right by merging the batch again.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postrank.functions.features import fingerprint
from postrank.operators.dedupe import digest, keep_latest
from postrank.storage import free, written

BUCKETS = 256
BUCKET, KEY, WHOLE = "_bucket", "_key", "_whole"
LAYOUT = "_layout"


class Rule(NamedTuple):
    """What makes rows the same, which of them is newest, and how ties are settled (ascending)."""

    key: Column
    newest: tuple[str, ...]
    ties: tuple[str | Column, ...]


def by_id() -> Rule:
    """Newest row per id within a source; without an id a row has no key."""
    key = F.when(F.col("job_id").isNotNull(), F.concat_ws("\x1f", "job_id", "source_name"))
    return Rule(key, ("published_at",), ("url",))


def by_fingerprint() -> Rule:
    """Newest row per title, company and place, across sources."""
    parts = [F.col(c) for c in ("title", "company_name", "location_clean")]
    return Rule(F.when(F.coalesce(*parts).isNotNull(), fingerprint(*parts)), ("published_at",), ("source_name", "job_id", "url"))


def by_url() -> Rule:
    """Newest row per URL; rows without URL count by id."""
    return Rule(F.coalesce("url", "job_id"), ("published_at", "ingestion_date"), ("source_name", "job_id"))


def _keyed(rows: DataFrame, rule: Rule, buckets: int) -> DataFrame:
    """The rows with their key, bucket and digest. Columns of these names are replaced."""
    columns = [c for c in rows.columns if c not in (BUCKET, KEY, WHOLE)]
    named = rows.select(*columns, rule.key.alias(KEY), F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})).alias(WHOLE))
    return named.withColumn(BUCKET, F.pmod(F.xxhash64(F.coalesce(KEY, WHOLE)), F.lit(buckets)).cast("int"))


def _named(rows: DataFrame, columns: list[str], name: str = "_row") -> DataFrame:
    """The columns of stored rows and a name no other stored row has."""
    return rows.select(*columns, F.struct("_metadata.file_path", "_metadata.row_index").alias(name))


def _winners(rows: DataFrame, rule: Rule, name: str = "_row") -> DataFrame:
    """The rows that stay of a stored table, chosen on narrow rows; ``rows`` may bring their ``name``."""
    table = rows if name in rows.columns else _named(rows, rows.columns, name)
    ties = [F.col(t).alias(f"_t{i}") if isinstance(t, str) else t.alias(f"_t{i}") for i, t in enumerate((*rule.ties, digest(rows)))]
    newest = [F.col(c).alias(f"_n{i}") for i, c in enumerate(rule.newest)]
    narrow = table.select(name, KEY, WHOLE, *newest, *ties)
    chosen = keep_latest(
        narrow, [KEY], [f"_n{i}" for i in range(len(newest))], [*(f"_t{i}" for i in range(len(ties))), WHOLE, name], name
    )
    return table.join(chosen.select(name), name, "left_semi").drop(name)


def _layout(spark: SparkSession, path: str, buckets: int) -> bool:
    """Whether the table is there; its number of buckets must be the one asked for."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{LAYOUT}")
    if not place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place):
        return False
    held = spark.read.parquet(f"{path}/{LAYOUT}").first()["buckets"]
    if held != buckets:
        raise ValueError(f"{path} has {held} buckets, not {buckets}")
    return True


def read_winners(spark: SparkSession, path: str) -> DataFrame:
    """The rows that stay, with the columns the batches had."""
    return spark.read.parquet(path).drop(BUCKET, KEY, WHOLE)


def merge_batch(batch: DataFrame, path: str, rule: Rule, buckets: int = BUCKETS) -> list[int]:
    """Merge a batch into the table of winners at ``path``; the buckets written.

    All batches have the same columns. An empty batch writes nothing. The list is
    no longer than the number of buckets.
    """
    spark = batch.sparkSession
    there = _layout(spark, path, buckets)
    came = written(_keyed(batch, rule, buckets), "batch")
    touched = sorted(r[0] for r in came.select(BUCKET).distinct().collect())
    if not touched:
        free(came)
        return []
    rows = came
    if there:
        # The touched buckets are read in the tasks of the write and replaced only when
        # it commits, so they need no copy of their own.
        stored = spark.read.parquet(path).filter(F.col(BUCKET).isin(touched))
        rows = _named(stored, came.columns).unionByName(_named(came, came.columns))
    writer = _winners(rows, rule).repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(BUCKET).parquet(path)
    if not there:
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.mode("overwrite").parquet(f"{path}/{LAYOUT}")
    free(came)
    return touched
