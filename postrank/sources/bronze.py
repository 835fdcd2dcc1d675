"""Stored payloads of the four sources, read as one kind of posting.

A payload is one JSON object with a ``results`` list. Two layouts are read:
one object per file (``multi_line=True``, as collectors leave them), and one
object per line (``multi_line=False``, as :func:`write_envelopes` leaves them).
The second splits large files among tasks; use it for anything big.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postrank import config as C
from postrank import schemas as S
from postrank.functions.text import slug

# --- Fixed value: company shown where France Travail names none ---
UNNAMED_COMPANY = "Non renseigné"

FOLDERS = {
    C.ADZUNA: "adzuna",
    C.FRANCE_TRAVAIL: "france_travail",
    C.JSEARCH: "jsearch",
    C.JOOBLE: "jooble",
}


def read_envelopes(spark: SparkSession, path: str, result: T.StructType, multi_line: bool = True) -> DataFrame:
    """Every stored payload, parsed once; one that does not parse is whole in ``UNREAD``."""
    lines = spark.read.text(path, wholetext=multi_line, recursiveFileLookup=True)
    parsed = F.from_json("value", S.envelope(result), {"columnNameOfCorruptRecord": S.UNREAD})
    # Exploded, the parsed payload is one value that no later filter parses again.
    return lines.filter(F.trim("value") != "").select(F.explode(F.array(parsed)).alias("p")).select("p.*")


def _stage(spark: SparkSession, path: str, result: T.StructType, columns: dict[str, Column],
           source: str, multi_line: bool) -> DataFrame:
    """One row per result; payloads without results give none."""
    posting = read_envelopes(spark, path, result, multi_line).select(F.explode("results").alias("r"))
    columns = columns | {"source_name": F.lit(source)}
    return posting.select(*[columns[c].cast("string").alias(c) for c in S.STAGED_COLUMNS])


def rejected_payloads(spark: SparkSession, path: str, source: str, multi_line: bool = True) -> DataFrame:
    """source_name, problem, payload: stored payloads of a source that staging cannot read."""
    payloads = read_envelopes(spark, path, RESULTS[source], multi_line)
    broken = payloads.filter(F.col(S.UNREAD).isNotNull())
    is_object = F.json_object_keys(S.UNREAD).isNotNull()
    problem = F.when(is_object, "fields of another kind").otherwise("not a JSON object")
    return broken.select(F.lit(source).alias("source_name"), problem.alias("problem"), F.col(S.UNREAD).alias("payload"))


def rejected_of_all(spark: SparkSession, root: str, multi_line: bool = True, layout: str = "{folder}") -> DataFrame:
    return union_sources([
        rejected_payloads(spark, f"{root}/{layout.format(folder=folder)}", source, multi_line)
        for source, folder in FOLDERS.items()
    ])


def file_keys(spark: SparkSession, path: str, source: str, multi_line: bool = True) -> DataFrame:
    """keyword, file_key, ingested_at, results: what is stored, payload by payload."""
    payloads = read_envelopes(spark, path, RESULTS[source], multi_line)
    return payloads.filter(F.col(S.UNREAD).isNull()).select(
        "keyword", "file_key", "ingested_at", F.coalesce(F.size("results"), F.lit(0)).alias("results")
    )


def stage_adzuna(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return _stage(spark, path, S.ADZUNA_RESULT, {
        "job_id": F.col("r.id"),
        "title": F.col("r.title"),
        "company_name": F.col("r.company.display_name"),
        "description": F.col("r.description"),
        "location": F.col("r.location.display_name"),
        "salary_info": F.col("r.salary_min"),
        "created_at": F.col("r.created"),
        "url": F.col("r.redirect_url"),
    }, C.ADZUNA, multi_line)


def stage_france_travail(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return _stage(spark, path, S.FRANCE_TRAVAIL_RESULT, {
        "job_id": F.col("r.id"),
        "title": F.col("r.intitule"),
        "company_name": F.coalesce("r.entreprise.nom", F.lit(UNNAMED_COMPANY)),
        "description": F.col("r.description"),
        "location": F.col("r.lieuTravail.libelle"),
        "salary_info": F.col("r.salaire"),
        "created_at": F.col("r.dateCreation"),
        "url": F.col("r.origineOffre.urlOrigine"),
    }, C.FRANCE_TRAVAIL, multi_line)


def stage_jsearch(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return _stage(spark, path, S.JSEARCH_RESULT, {
        "job_id": F.col("r.job_id"),
        "title": F.col("r.job_title"),
        "company_name": F.col("r.employer_name"),
        "description": F.col("r.job_description"),
        "location": F.concat_ws(", ", "r.job_city", "r.job_country"),
        "salary_info": F.lit(None),
        "created_at": F.col("r.job_posted_at_datetime_utc"),
        "url": F.col("r.job_apply_link"),
    }, C.JSEARCH, multi_line)


def stage_jooble(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    return _stage(spark, path, S.JOOBLE_RESULT, {
        "job_id": F.col("r.id"),
        "title": F.col("r.title"),
        "company_name": F.col("r.company"),
        "description": F.col("r.snippet"),
        "location": F.col("r.location"),
        "salary_info": F.col("r.salary"),
        "created_at": F.col("r.updated"),
        "url": F.col("r.link"),
    }, C.JOOBLE, multi_line)


RESULTS = {
    C.ADZUNA: S.ADZUNA_RESULT,
    C.FRANCE_TRAVAIL: S.FRANCE_TRAVAIL_RESULT,
    C.JSEARCH: S.JSEARCH_RESULT,
    C.JOOBLE: S.JOOBLE_RESULT,
}
STAGERS = {
    C.ADZUNA: stage_adzuna,
    C.FRANCE_TRAVAIL: stage_france_travail,
    C.JSEARCH: stage_jsearch,
    C.JOOBLE: stage_jooble,
}


def union_sources(staged: list[DataFrame]) -> DataFrame:
    """All rows of all sources, matched by column name."""
    return reduce(DataFrame.unionByName, staged)


def stage_all(spark: SparkSession, root: str, multi_line: bool = True, layout: str = "{folder}") -> DataFrame:
    """Every source below ``root``; ``layout`` names a source's folder.

    What ``write_envelopes`` leaves is read by ``stage_written``.
    """
    paths = {source: f"{root}/{layout.format(folder=folder)}" for source, folder in FOLDERS.items()}
    return union_sources([STAGERS[source](spark, path, multi_line) for source, path in paths.items()])


WRITTEN_LAYOUT = "source={folder}"


def stage_written(spark: SparkSession, root: str) -> DataFrame:
    """Every source of what ``write_envelopes`` left below ``root``; one never written is empty."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    folders = {source: f"{root}/{WRITTEN_LAYOUT.format(folder=folder)}" for source, folder in FOLDERS.items()}
    there = {s: f for s, f in folders.items() if path(f).getFileSystem(conf).exists(path(f))}
    if not there:
        return spark.createDataFrame([], S.STAGED)
    return union_sources([STAGERS[source](spark, folder, False) for source, folder in there.items()])


def write_envelopes(envelopes: DataFrame, root: str) -> None:
    """Append payloads below ``source=/year=/month=/day=``, one JSON object a line.

    ``envelopes`` has ``source`` (folder name), ``keyword``, ``ingested_at``
    (timestamp) and ``results`` (an array of structs, or of VARIANT, which is
    written as the JSON it came from), and may have ``count``. The keyword is kept
    in the payload and, made a slug, in ``file_key`` with the time of day.
    """
    kind = envelopes.schema["results"].dataType
    if not (isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.VariantType))):
        raise ValueError("results must be an array of structs or of VARIANT, not of text")
    at = F.col("ingested_at")
    payload = F.struct(
        *[F.col(c) for c in ("count",) if c in envelopes.columns],
        "results",
        "keyword",
        "source",
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss").alias("ingested_at"),
        F.concat_ws("_", slug(F.col("keyword")), F.date_format(at, "HHmmss")).alias("file_key"),
    )
    rows = envelopes.select(
        F.to_json(payload).alias("value"),
        "source",
        F.date_format(at, "yyyy").alias("year"),
        F.date_format(at, "MM").alias("month"),
        F.date_format(at, "dd").alias("day"),
    )
    rows.write.mode("append").partitionBy("source", "year", "month", "day").text(root)
