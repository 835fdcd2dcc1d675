"""Keep the newest posting of each group.

The winners are chosen on narrow rows: keys, dates, and a digest in place of the
texts. Each step is a ``row_number() = 1`` filter, which Spark plans with a
group limit on both sides of the shuffle, so a key holding a third of all rows
reaches its reducer as one row per map task. Only then are the whole postings
brought in, by one semi-join on the name of the row; texts are neither sorted
nor shuffled before that.

Rows without any part of a key have nothing in common, so they all stay;
``keyless="one"`` keeps one of them instead.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postrank.functions.features import fingerprint
from postrank.storage import written

ROW = "_row"
#: Columns whose texts take part in an order as one digest.
DIGESTED = ("title", "company_name", "description")


def identified(df: DataFrame, row: str | None) -> tuple[DataFrame, str]:
    """The table and the column that names its rows.

    ``row`` is a column that is different in every row and the same whenever the
    table is read. Without one the table is stored with numbered rows.
    """
    if row:
        return df, row
    return written(df.withColumn(ROW, F.monotonically_increasing_id()), "rows"), ROW


def digest(df: DataFrame) -> Column:
    return F.md5(F.concat_ws("\x1f", *[c for c in DIGESTED if c in df.columns]))


def keep_latest(narrow: DataFrame, keys: list[str], newest: list[str], ties: list[str],
                own: str | None = None) -> DataFrame:
    """One row per ``keys``: highest ``newest``, then lowest ``ties``.

    ``ties`` should complete a total order, so that a recomputed task picks the
    same row. Rows whose keys are all NULL form one group, or, with ``own`` (a
    column that is different in every row), a group each.
    """
    order = [F.desc_nulls_last(c) for c in newest] + [F.asc_nulls_last(c) for c in ties]
    groups = [F.col(k) for k in keys]
    if own:
        keyless = reduce(and_, [k.isNull() for k in groups])
        groups.append(F.when(keyless, F.col(own)))
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return narrow.withColumn("_place", place).filter(F.col("_place") == 1).drop("_place")


def narrowed(df: DataFrame, row: str) -> DataFrame:
    """What the dedupes by id and by fingerprint need of each row."""
    parts = [F.col(c) for c in ("title", "company_name", "location_clean")]
    key = F.when(F.coalesce(*parts).isNotNull(), fingerprint(*parts))
    return df.select(row, "job_id", "source_name", "published_at", "url", key.alias("_print"), digest(df).alias("_digest"))


def latest_by_id(narrow: DataFrame, row: str, keyless: str = "all") -> DataFrame:
    """Newest row per id within a source; without an id a row has no key."""
    if keyless == "one":
        return keep_latest(narrow, ["job_id", "source_name"], ["published_at"], ["url", "_digest", row])
    named = narrow.withColumn("_source", F.when(F.col("job_id").isNotNull(), F.col("source_name")))
    return keep_latest(named, ["job_id", "_source"], ["published_at"], ["url", "_digest", row], row).drop("_source")


def latest_by_fingerprint(narrow: DataFrame, row: str, keyless: str = "all") -> DataFrame:
    """Newest row per title, company and place, across sources."""
    ties = ["source_name", "job_id", "url", "_digest", row]
    return keep_latest(narrow, ["_print"], ["published_at"], ties, None if keyless == "one" else row)


def brought_in(df: DataFrame, chosen: DataFrame, row: str, given: str | None) -> DataFrame:
    """The whole rows of those chosen."""
    whole = df.join(chosen.select(row), row, "left_semi").select(*df.columns)
    return whole if given else whole.drop(row)


def dedupe_by_id(df: DataFrame, row: str | None = None, keyless: str = "all") -> DataFrame:
    table, name = identified(df, row)
    return brought_in(table, latest_by_id(narrowed(table, name), name, keyless), name, row)


def dedupe_by_fingerprint(df: DataFrame, row: str | None = None, keyless: str = "all") -> DataFrame:
    table, name = identified(df, row)
    return brought_in(table, latest_by_fingerprint(narrowed(table, name), name, keyless), name, row)


def dedupe_by_both(df: DataFrame, row: str | None = None, keyless: str = "all") -> DataFrame:
    """By id, then by fingerprint; the whole rows are brought in once, at the end."""
    table, name = identified(df, row)
    chosen = latest_by_fingerprint(latest_by_id(narrowed(table, name), name, keyless), name, keyless)
    return brought_in(table, chosen, name, row)


def dedupe_by_url(df: DataFrame, row: str | None = None, keyless: str = "all") -> DataFrame:
    """Newest row per URL; rows without URL count by id."""
    table, name = identified(df, row)
    narrow = table.select(
        name, F.coalesce("url", "job_id").alias("_key"), "published_at", "ingestion_date", "source_name", "job_id",
        digest(table).alias("_digest"),
    )
    chosen = keep_latest(
        narrow, ["_key"], ["published_at", "ingestion_date"], ["source_name", "job_id", "_digest", name],
        None if keyless == "one" else name,
    )
    return brought_in(table, chosen, name, row)
