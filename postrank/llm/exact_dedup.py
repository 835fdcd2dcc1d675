"""Exact duplicates, with frequent texts taken out before the shuffle.

Texts are equal when they are identical after all white space is deleted; null
counts as empty. Each text becomes a SHA-256 digest. A frequent-items sketch of
the Misra-Gries family (Spark's ``approx_top_k``) names digests that may make up
more than ``HEAVY_SHARE`` of all rows. They are counted again exactly, which
verifies them and yields the row that stays; that small table is broadcast, so
the rows of frequent texts are settled where they lie. All other digests are
shuffled, and none of them can be a hot key.

Of equal texts the row with the most code points stays, then the smallest
doc_id (null last), then the row stored first. Repeated rows are therefore
duplicates like any other; exactly one of them stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postrank.llm.rows import SPACE, keyed, only, quoted
from postrank.storage import written

#: A digest with more than this share of all rows is settled without a shuffle.
HEAVY_SHARE = 1 / 500
#: Counters of the sketch. Its error is 3.5 / COUNTERS of all rows, below half of
#: HEAVY_SHARE, so no heavy digest is missed and fewer than 2 / HEAVY_SHARE are named.
COUNTERS = 4096
MAX_NAMED = int(2 / HEAVY_SHARE)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{SPACE}+", "")


def digests(table: DataFrame, *more: Column, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One narrow row per document: row (a number), doc_id, chars, digest, and ``more``."""
    source = F.col(quoted(text))
    return table.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(quoted(doc_id)).alias("doc_id"),
        F.length(F.coalesce(source, F.lit(""))).cast("long").alias("chars"),
        F.unhex(F.sha2(normalised(source), 256)).alias("digest"),
        *more,
    )


def _best() -> Column:
    """The row that stays, as the smallest of these."""
    return F.struct(
        (-F.col("chars")).alias("order"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("row")
    )


def heavy_winners(narrow: DataFrame) -> DataFrame:
    """digest, best, group_size of every digest above HEAVY_SHARE: at most MAX_NAMED rows."""
    sketch = narrow.agg(
        F.expr(f"approx_top_k(xxhash64(digest), {MAX_NAMED}, {COUNTERS})").alias("top"), F.count("*").alias("rows")
    )
    named = (
        sketch.select(F.explode("top").alias("top"), "rows")
        .filter((F.col("top.count") > F.col("rows") * HEAVY_SHARE) & (F.col("top.count") > 1))
        .select(F.col("top.item").alias("short"))
    )
    return (
        narrow.withColumn("short", F.xxhash64("digest"))
        .join(F.broadcast(named), "short", "left_semi")
        .groupBy("digest")
        .agg(F.min(_best()).alias("best"), F.count("*").alias("group_size"))
        .filter(F.col("group_size") > 1)
    )


def duplicate_groups(narrow: DataFrame) -> DataFrame:
    """Every row with its group: row, doc_id, keep_id, group_size, kept, digest.

    ``narrow`` as ``digests`` gives it, stored: it is read several times. An
    empty table gives no rows.
    """
    winners = written(heavy_winners(narrow), "heavy")
    heavy = narrow.join(F.broadcast(winners), "digest")
    group = Window.partitionBy("digest")
    rest = narrow.join(F.broadcast(winners), "digest", "left_anti").select(
        "*", F.min(_best()).over(group).alias("best"), F.count("*").over(group).alias("group_size")
    )
    return heavy.unionByName(rest).select(
        "row", "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("best.row") == F.col("row")).alias("kept"), "digest",
    )


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The groups of equal texts, one row per document. Other columns are not read."""
    return duplicate_groups(written(digests(docs, text=text, doc_id=doc_id), "digests"))


def drop_exact_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that stay, with the columns they came with."""
    table, key = keyed(docs, "exact")
    narrow = written(digests(table, F.col(key).alias("name"), text=text, doc_id=doc_id), "digests")
    kept = duplicate_groups(narrow.drop("name")).filter("kept").select("row")
    return only(table, key, narrow.join(kept, "row")).select(*map(quoted, docs.columns))
