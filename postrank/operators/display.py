"""Presentation columns of a ranked list, and its key figures."""

from __future__ import annotations

import re
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postrank.functions.rules import LABEL_SEPARATOR
from postrank.operators.ranking import is_fresh, search_any_column, top_n, with_min_score

# --- Fixed values: score bands, currency and title length ---
HIGH_SCORE, MIDDLE_SCORE = 80, 60
HIGH_MARK, MIDDLE_MARK, LOW_MARK = "🟢", "🟡", "🔴"
NOT_AVAILABLE = "N/A"
TITLE_CHARS = 45
NUMBER_COLUMNS = ("matching_score", "semantic_score", "rules_score", "salary_min")
TIME_COLUMNS = ("published_at", "ingestion_date")


def whole_number(value: Column) -> Column:
    """Truncated integer; 0 for NULL or text that is no number."""
    number = value.cast("string").try_cast("double")
    return F.coalesce(number.try_cast("int"), F.lit(0))


def euros(amount: Column) -> Column:
    grouped = F.translate(F.format_number(amount, 0), ",", " ")
    return F.when(amount > 0, F.concat(grouped, F.lit(" €"))).otherwise(NOT_AVAILABLE)


def display_clean(ranked: DataFrame) -> DataFrame:
    """Coerce numbers and times, fill URLs, turn skills into one text."""
    columns = {c: whole_number(F.col(c)) for c in NUMBER_COLUMNS}
    columns |= {c: F.try_to_timestamp(F.col(c).cast("string")) for c in TIME_COLUMNS}
    columns["original_url"] = F.coalesce("original_url", F.lit(""))
    columns["skills"] = F.array_join("skills", ", ")
    return ranked.withColumns(columns).withColumn("salary_visual", euros(F.col("salary_min")))


def score_band(score: Column) -> Column:
    mark = F.when(score >= HIGH_SCORE, HIGH_MARK).when(score >= MIDDLE_SCORE, MIDDLE_MARK).otherwise(LOW_MARK)
    return F.concat(mark, F.lit(" "), score.cast("string"), F.lit("%"))


def score_bands(shown: DataFrame) -> DataFrame:
    """Add the marked text of the three scores."""
    names = ("matching", "semantic", "rules")
    return shown.withColumns({f"{n}_visual": score_band(F.col(f"{n}_score")) for n in names})


def first_labels(labels: Column, count: int) -> Column:
    """The first ``count`` labels; empty for NULL or no labels."""
    items = F.split(labels, re.escape(LABEL_SEPARATOR))
    return F.when(F.coalesce(labels, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.slice(items, 1, count)
    )


def short_title(title: Column) -> Column:
    cut = F.concat(F.left(title, F.lit(TITLE_CHARS)), F.lit("..."))
    return F.when(F.length(title) > TITLE_CHARS, cut).otherwise(title)


def top_cards(ranked: DataFrame, as_of: str | datetime, count: int = 3) -> DataFrame:
    """The best rows with what a card shows of each."""
    return top_n(ranked, count).withColumns({
        "is_new": F.coalesce(is_fresh(as_of), F.lit(False)),
        "title_short": short_title(F.col("title")),
        "top_positive": first_labels(F.col("positive_labels"), 2),
        "top_negative": first_labels(F.col("negative_labels"), 1),
    })


def dashboard(
    ranked: DataFrame, as_of: str | datetime, min_score: float, only_fresh: bool = False, pattern: str = ""
) -> DataFrame:
    """What the filters leave of the displayed list: score, then freshness, then search.

    The search reads what is displayed, so "80%" and "N/A" are found.
    """
    shown = with_min_score(score_bands(display_clean(ranked)), min_score)
    if only_fresh:
        shown = shown.filter(is_fresh(as_of))
    return search_any_column(shown, pattern) if pattern else shown


def average_salary(ranked: DataFrame) -> DataFrame:
    """Truncated mean of positive salaries and its text, in one row."""
    salary = F.col("salary_min")
    mean = ranked.agg(F.avg(F.when(salary > 0, salary)).cast("int").alias("avg_salary"))
    return mean.withColumn("avg_salary_text", F.coalesce(euros(F.col("avg_salary")), F.lit(NOT_AVAILABLE)))


def key_figures(ranked: DataFrame, as_of: str | datetime) -> DataFrame:
    """Postings, postings of the last day and mean score, in one row."""
    return ranked.agg(
        F.count("*").alias("postings"),
        F.count_if(is_fresh(as_of)).alias("new_postings"),
        F.avg(whole_number(F.col("matching_score"))).cast("int").alias("avg_matching_score"),
    )
