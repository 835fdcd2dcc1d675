"""Cleaned postings to scored postings."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postrank.config import RankingConfig
from postrank.functions import rules
from postrank.operators.dedupe import dedupe_by_url
from postrank.operators.similarity import add_cosine, valid_vectors

# --- Fixed values: columns of the staging view of cleaned postings, in order ---
STAGING_COLUMNS = (
    "job_id", "source_name", "url", "data_quality_score", "ingestion_date",
    "title", "company_name", "job_location", "description", "published_at",
    "extracted_skills", "salary_min_numeric", "exp_min_required", "description_vector",
    "is_junior", "is_senior", "is_red_flag", "is_ethical", "is_remote",
)
# --- Fixed values: columns scoring adds, in order ---
SCORE_COLUMNS = (
    "positive_labels", "negative_labels", "raw_rule_score", "raw_nlp_score",
    "rules_score", "semantic_score", "matching_score",
)


def staging_view(silver: DataFrame, *more: str) -> DataFrame:
    """Stored postings under the names scoring uses, with ``more`` of their columns."""
    renamed = silver.withColumnRenamed("location_clean", "job_location")
    return renamed.withColumn("data_quality_score", F.col("data_quality_score").cast("double")).select(
        *STAGING_COLUMNS, *more
    )


def add_rule_scores(df: DataFrame, cfg: RankingConfig) -> DataFrame:
    """Add one column of points per rule."""
    texts = rules.lowered_texts()
    return df.withColumns(texts).withColumns(rules.all_rules(cfg)).drop(*texts)


def add_rule_total(df: DataFrame, cfg: RankingConfig) -> DataFrame:
    total = reduce(add, [F.col(n) for n in rules.RULE_NAMES], F.lit(cfg.weights["base"]))
    return df.withColumn("raw_rule_score", total)


def add_labels(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "positive_labels": rules.positive_labels(),
        "negative_labels": rules.negative_labels(),
    })


def percent(score: Column) -> Column:
    return F.least(F.greatest(score, F.lit(0)), F.lit(100))


def add_final_scores(df: DataFrame, cfg: RankingConfig) -> DataFrame:
    """Clamp both raw scores and blend them, weighted by source quality."""
    by_rules, by_text = percent(F.col("raw_rule_score")), percent(F.col("raw_nlp_score"))
    blend = by_rules * cfg.rules_share + by_text * (1 - cfg.rules_share)
    return df.withColumns({
        "rules_score": by_rules,
        "semantic_score": F.round(by_text),
        "matching_score": F.round(blend * F.col("data_quality_score")),
    })


def score_postings(df: DataFrame, cfg: RankingConfig, profile: list[float] | None) -> DataFrame:
    """Every score and label of each row. One pass, no join, no shuffle."""
    kept = [c for c in df.columns]
    scored = add_labels(add_rule_total(add_rule_scores(df, cfg), cfg))
    scored = add_cosine(scored, "description_vector", profile)
    scored = scored.withColumn("raw_nlp_score", F.coalesce(F.col("cosine") * 100, F.lit(0.0)))
    return add_final_scores(scored, cfg).select(*kept, *SCORE_COLUMNS)


def build_gold(
    silver: DataFrame, cfg: RankingConfig, profile: list[float] | None, row: str | None = None
) -> DataFrame:
    """Scored postings, one per URL, of those with a usable vector.

    ``row`` names the rows of ``silver``, as ``read_silver`` can; without it
    the postings are stored once more to be told apart.
    """
    view = staging_view(silver, *([row] if row else []))
    usable = valid_vectors(view, "description_vector", cfg.vector_dim)
    kept = dedupe_by_url(usable, row)
    return score_postings(kept.drop(row) if row else kept, cfg, profile)
