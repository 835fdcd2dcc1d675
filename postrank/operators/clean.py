"""Staged postings to clean, deduplicated, feature-bearing postings.

Order matters for cost: the two dedupes need only narrow rows, so they run
before the patterns and the embedding, which then see surviving rows only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postrank.config import RankingConfig
from postrank.functions import features, text
from postrank.functions.embedding import embed_hashed
from postrank.operators.dedupe import ROW, dedupe_by_both, identified
from postrank.schemas import SILVER_COLUMNS, STAGED_REQUIRED, require_columns

def normalise(staged: DataFrame, cfg: RankingConfig) -> DataFrame:
    """Add ``published_at`` and ``location_clean``, all the dedupes need."""
    return staged.withColumns({
        "published_at": text.parse_published(F.col("created_at"), text.moment(cfg.as_of)),
        "location_clean": text.clean_location(F.col("location")),
    })


def clean_description(df: DataFrame, cfg: RankingConfig) -> DataFrame:
    """Fix entities and cut-off dots in ``description`` (markup stays)."""
    description = text.strip_ellipsis(
        text.replace_entities(F.col("description")), F.col("source_name"), cfg.ellipsis_sources
    )
    return df.withColumn("description", description)


def add_search_columns(df: DataFrame) -> DataFrame:
    """Add ``description_clean`` (no markup), it lowered, and ``search_text``."""
    df = df.withColumn("description_clean", text.strip_tags(F.col("description")))
    df = df.withColumn("description_lower", F.lower("description_clean"))
    return df.withColumn("search_text", text.search_text(F.col("title"), F.col("description_lower")))


def add_experience(df: DataFrame, cfg: RankingConfig) -> DataFrame:
    years = features.years_of_experience(F.col("description_lower"), cfg.max_years)
    return df.withColumn("exp_min_required", years.cast("double"))


def add_skills(df: DataFrame, cfg: RankingConfig) -> DataFrame:
    return df.withColumn("extracted_skills", features.skill_tags(F.col("search_text"), cfg.skills))


def add_salary(df: DataFrame, cfg: RankingConfig) -> DataFrame:
    found = features.salary_match(F.col("salary_info"), F.col("description_clean"))
    amount = features.salary_amount(F.col("_salary"), cfg.salary_range)
    return df.withColumn("_salary", found).withColumn("salary_min_numeric", amount).drop("_salary")


def add_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(features.flags(F.col("search_text"), F.col("company_name")))


def add_quality_weight(df: DataFrame, cfg: RankingConfig) -> DataFrame:
    weight = features.quality_weight(F.col("source_name"), cfg.source_quality, cfg.other_source_quality)
    return df.withColumn("data_quality_score", weight)


def add_features(df: DataFrame, cfg: RankingConfig) -> DataFrame:
    """All features of a cleaned description; helper columns are dropped."""
    df = add_search_columns(clean_description(df, cfg))
    df = add_flags(add_salary(add_skills(add_experience(df, cfg), cfg), cfg))
    df = add_quality_weight(df, cfg)
    stamped = df.withColumn("ingestion_date", text.moment(cfg.as_of).cast("date"))
    return stamped.drop("description_clean", "description_lower", "search_text")


def add_embedding(
    df: DataFrame, cfg: RankingConfig, embed: Callable[[Column], Column] | None = None
) -> DataFrame:
    """Add ``description_vector``. Run it after every dedupe you intend."""
    source = features.embedding_text(F.col("title"), F.col("description"), cfg.embedding_chars)
    vector = embed(source) if embed else embed_hashed(source, cfg.vector_dim)
    return df.withColumn("description_vector", vector)


def distinct_postings(staged: DataFrame, cfg: RankingConfig, row: str | None = None) -> DataFrame:
    """Normalised postings, one per source id and one per fingerprint.

    ``row`` as in the dedupes; without it the staged postings are stored first,
    so that payloads are parsed once.
    """
    table, name = identified(staged, row)
    kept = dedupe_by_both(normalise(table, cfg), name)
    return kept if row else kept.drop(ROW)


def build_silver(
    staged: DataFrame, cfg: RankingConfig, embed: Callable[[Column], Column] | None = None, row: str | None = None
) -> DataFrame:
    """The stored posting table, from the union of staged sources; ``row`` as in the dedupes."""
    require_columns(staged, STAGED_REQUIRED, "after the union of sources")
    featured = add_features(distinct_postings(staged, cfg, row), cfg)
    return require_columns(add_embedding(featured, cfg, embed), SILVER_COLUMNS, "before the write").select(
        *SILVER_COLUMNS
    )
