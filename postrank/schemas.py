"""Explicit schemas. Nothing is inferred from files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- Fixed values: columns of a staged posting ---
STAGED_COLUMNS = (
    "job_id", "title", "company_name", "description", "location",
    "salary_info", "created_at", "url", "source_name",
)
STAGED_REQUIRED = tuple(c for c in STAGED_COLUMNS if c != "salary_info")
STAGED = T.StructType([T.StructField(c, T.StringType()) for c in STAGED_COLUMNS])

# --- Fixed values: columns of a cleaned posting, in stored order ---
SILVER = T.StructType([
    T.StructField("job_id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("location_clean", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("published_at", T.TimestampType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("data_quality_score", T.DoubleType()),
    T.StructField("extracted_skills", T.ArrayType(T.StringType())),
    T.StructField("salary_min_numeric", T.IntegerType()),
    T.StructField("exp_min_required", T.DoubleType()),
    T.StructField("is_junior", T.BooleanType()),
    T.StructField("is_senior", T.BooleanType()),
    T.StructField("is_red_flag", T.BooleanType()),
    T.StructField("is_ethical", T.BooleanType()),
    T.StructField("is_remote", T.BooleanType()),
    T.StructField("description_vector", T.ArrayType(T.FloatType())),
    T.StructField("ingestion_date", T.DateType()),
])
SILVER_COLUMNS = tuple(SILVER.fieldNames())

RUN_LOG = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("run_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("source_name", T.StringType()),
    T.StructField("records_count", T.LongType()),
    T.StructField("error_message", T.StringType()),
])

PROFILE = T.StructType([
    T.StructField("profile_id", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("ideal_vector", T.StringType()),
])


def _named(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# --- Fixed values: fields read from one result of each source ---
ADZUNA_RESULT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("company", _named("display_name")),
    T.StructField("description", T.StringType()),
    T.StructField("location", _named("display_name")),
    T.StructField("salary_min", T.DoubleType()),
    T.StructField("created", T.StringType()),
    T.StructField("redirect_url", T.StringType()),
])
FRANCE_TRAVAIL_RESULT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("intitule", T.StringType()),
    T.StructField("entreprise", _named("nom")),
    T.StructField("description", T.StringType()),
    T.StructField("lieuTravail", _named("libelle")),
    T.StructField("salaire", T.StringType()),  # an object: as text it keeps every field
    T.StructField("dateCreation", T.StringType()),
    T.StructField("origineOffre", _named("urlOrigine")),
])
JSEARCH_RESULT = _named(
    "job_id", "job_title", "employer_name", "job_description", "job_city", "job_country",
    "job_posted_at_datetime_utc", "job_apply_link",
)
JOOBLE_RESULT = _named("id", "title", "company", "snippet", "location", "salary", "updated", "link")


#: The whole text of a payload that does not have the schema.
UNREAD = "_unread"


def envelope(result: T.StructType) -> T.StructType:
    """Schema of a stored payload: one object holding a list of results."""
    return T.StructType([
        T.StructField("count", T.LongType()),
        T.StructField("results", T.ArrayType(result)),
        T.StructField("keyword", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("ingested_at", T.StringType()),
        T.StructField("file_key", T.StringType()),
        T.StructField(UNREAD, T.StringType()),
    ])


def require_columns(df: DataFrame, required, context: str = "") -> DataFrame:
    """Return ``df`` unchanged, or raise ``ValueError`` naming absent columns."""
    absent = sorted(set(required) - set(df.columns))
    if absent:
        where = f" {context}" if context else ""
        raise ValueError(f"missing required columns{where}: {', '.join(absent)}")
    return df
