"""What readers of the scored table ask for: view, top lists, filters, search."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postrank.config import RankingConfig
from postrank.functions.text import moment, trim_whitespace

DEFAULT_ROWS = 200
DEFAULT_MIN_SCORE = 30


def ranking(gold: DataFrame, cfg: RankingConfig) -> DataFrame:
    """Relevant postings under their public names, in no set order."""
    relevant = gold.filter(F.col("matching_score") >= cfg.relevance_threshold)
    return relevant.select(
        "title",
        "company_name",
        F.col("job_location").alias("city"),
        F.col("salary_min_numeric").alias("salary_min"),
        F.col("extracted_skills").alias("skills"),
        trim_whitespace(F.col("description")).alias("description"),
        "published_at",
        "matching_score",
        "semantic_score",
        "rules_score",
        "positive_labels",
        "negative_labels",
        F.col("url").alias("original_url"),
        F.col("source_name").alias("platform"),
        "ingestion_date",
    )


def ranking_view(gold: DataFrame, cfg: RankingConfig) -> DataFrame:
    """The ranking, best first and, within a score, last ingested first.

    Few scores and dates share many rows, so the order goes on to columns that
    differ: the sort can then cut a run of equal scores into many ranges. It
    ends with a digest of the description, never the text itself, because a
    range sort samples its keys.
    """
    return ranking(gold, cfg).orderBy(*_order("matching_score", "ingestion_date", "published_at"))


def _order(*descending: str) -> list[Column]:
    ties = (*map(F.col, ("platform", "original_url", "title", "company_name", "city")), F.md5("description"))
    return [F.desc_nulls_last(c) for c in descending] + [c.asc_nulls_last() for c in ties]


def top_n(ranked: DataFrame, limit: int = DEFAULT_ROWS) -> DataFrame:
    """The best ``limit`` rows, newest first among equals.

    Few rows are picked in the map tasks; for many Spark sorts by range.
    """
    if limit < 0:
        raise ValueError("limit must not be negative")
    return ranked.orderBy(*_order("matching_score", "published_at")).limit(limit)


def least_score(scores: DataFrame, limit: int) -> float | None:
    """The highest score that ``limit`` rows or more reach; None if there are not so many.

    ``scores`` has (matching_score, count): scores are whole numbers from 0 to 100, so
    this is a question to a hundred rows.
    """
    best_first = Window.orderBy(F.desc("matching_score")).rowsBetween(Window.unboundedPreceding, 0)
    reached = scores.dropna().withColumn("reached", F.sum("count").over(best_first))
    return reached.filter(F.col("reached") >= limit).agg(F.max("matching_score")).first()[0]


def stored_top_n(gold: DataFrame, scores: DataFrame, cfg: RankingConfig, limit: int = DEFAULT_ROWS) -> DataFrame:
    """``top_n`` of a stored Gold: only rows of the scores that can be among the best are read.

    ``scores`` as ``read_scores`` gives it. The least score is pushed down to a table that
    lies in order of the score, so its other files and row groups are not read.
    """
    least = least_score(scores, limit)
    return top_n(ranking(gold if least is None else gold.filter(F.col("matching_score") >= least), cfg), limit)


def with_min_score(ranked: DataFrame, minimum: float = DEFAULT_MIN_SCORE) -> DataFrame:
    return ranked.filter(F.col("matching_score") >= minimum)


def is_fresh(as_of: str | datetime, hours: int = 24) -> Column:
    return F.col("published_at") >= moment(as_of) - F.make_dt_interval(hours=F.lit(hours))


def fresh_only(ranked: DataFrame, as_of: str | datetime, hours: int = 24) -> DataFrame:
    return ranked.filter(is_fresh(as_of, hours))


def search_any_column(df: DataFrame, pattern: str) -> DataFrame:
    """Rows where the pattern is found in some column, case ignored.

    Every column is searched as text, arrays as their joined items.
    """
    hit = F.lit(False)
    for column in df.schema.fields:
        value = F.col(column.name)
        joined = isinstance(column.dataType, T.ArrayType)
        text = F.array_join(value.cast("array<string>"), ", ") if joined else value.cast("string")
        hit = hit | F.coalesce(text.rlike(f"(?iu){pattern}"), F.lit(False))
    return df.filter(hit)
