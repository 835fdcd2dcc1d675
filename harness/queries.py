"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harness.workload import AS_OF, CONFIG, DIM, div, envelopes, postings, raw_pages, table
from postrank.functions import features, rules, text
from postrank.operators import clean, display, incremental, quality, ranking, scoring, similarity
from postrank.operators.dedupe import ROW, dedupe_by_both, dedupe_by_id, dedupe_by_url, digest
from postrank.plans.runs import ingest, publish_views
from postrank.sources import bronze, pages, profile, runlog, tables
from postrank.storage import scratch_dir, written

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def stamp(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def joined(column: str):
    return F.array_join(column, ",").alias(column)


# ---- shared inputs ----

def normalised(spark, sf_dir):
    return clean.normalise(postings(spark, sf_dir), CONFIG)


def described(spark, sf_dir):
    return clean.clean_description(postings(spark, sf_dir), CONFIG)


def searchable(spark, sf_dir):
    return clean.add_search_columns(described(spark, sf_dir))


def featured(spark, sf_dir):
    """Features of every posting, before any dedupe."""
    return clean.add_features(clean.normalise(postings(spark, sf_dir), CONFIG), CONFIG)


def with_vectors(spark, sf_dir, df):
    """Take the vector from the embeddings table; its size decides the join."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("description_vector"))
    return df.join(vectors, "vec_id")


def silver(spark, sf_dir):
    kept = clean.distinct_postings(postings(spark, sf_dir), CONFIG, "doc_id")
    return with_vectors(spark, sf_dir, clean.add_features(kept, CONFIG))


def profile_of(spark, sf_dir):
    """The vector every posting is compared with: the one of vec_id 0."""
    first = table(spark, sf_dir, "embeddings").filter(F.col("vec_id") == 0)
    return similarity.profile_vector(first, "embedding", DIM)


STORED_PATHS: dict[tuple, str] = {}


def given_files(spark, sf_dir):
    """Names, sizes and times of the files of the given tables: other files, other key."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(sf_dir)
    mark = F.xxhash64("path", "length", F.unix_micros("modificationTime")).cast("decimal(38,0)")
    return sf_dir, *listed.agg(F.count("*"), F.sum(mark)).first()


def stored_path(spark, sf_dir, kind, write):
    """The folder of a table written once per session and table folder, as a run does."""
    key = (spark.sparkContext.applicationId, kind, given_files(spark, sf_dir))
    if key not in STORED_PATHS:
        path = scratch_dir(spark, kind)
        write(path)
        STORED_PATHS[key] = path
    return STORED_PATHS[key]


def stored_silver(spark, sf_dir, row=None):
    path = stored_path(spark, sf_dir, "silver", lambda to: tables.write_silver(silver(spark, sf_dir), to))
    return tables.read_silver(spark, path, row)


def gold(spark, sf_dir):
    return scoring.build_gold(stored_silver(spark, sf_dir, ROW), CONFIG, profile_of(spark, sf_dir), ROW)


def gold_path(spark, sf_dir):
    return stored_path(spark, sf_dir, "gold", lambda to: tables.write_gold(gold(spark, sf_dir), to))


def stored_gold(spark, sf_dir):
    return spark.read.parquet(gold_path(spark, sf_dir))


def ranked(spark, sf_dir):
    return ranking.ranking(stored_gold(spark, sf_dir), CONFIG)


def scored_rows(spark, sf_dir):
    """Rule points of every posting, before any dedupe."""
    return scoring.add_rule_scores(featured(spark, sf_dir), CONFIG)


def shown(df):
    """Ranked rows with comparable types."""
    return df.withColumns({
        "skills": F.array_join("skills", ","),
        "published_at": F.date_format("published_at", "yyyy-MM-dd HH:mm:ss"),
        "ingestion_date": F.col("ingestion_date").cast("string"),
    })


# ---- sources and sinks ----

def staged(spark, sf_dir, source):
    root = scratch_dir(spark, "bronze")
    bronze.write_envelopes(envelopes(spark, sf_dir, source), root)
    folder = bronze.WRITTEN_LAYOUT.format(folder=bronze.FOLDERS[source])
    return bronze.STAGERS[source](spark, f"{root}/{folder}", multi_line=False)


@query
def stage_adzuna(spark, sf_dir):
    return staged(spark, sf_dir, "Adzuna")


@query
def stage_france_travail(spark, sf_dir):
    return staged(spark, sf_dir, "France Travail")


@query
def stage_jsearch(spark, sf_dir):
    return staged(spark, sf_dir, "JSearch")


@query
def stage_jooble(spark, sf_dir):
    return staged(spark, sf_dir, "Jooble")


@query
def union_sources(spark, sf_dir):
    root = scratch_dir(spark, "bronze")
    for source in bronze.FOLDERS:
        bronze.write_envelopes(envelopes(spark, sf_dir, source), root)
    return bronze.stage_all(spark, root, multi_line=False, layout=bronze.WRITTEN_LAYOUT)


@query
def source_counts(spark, sf_dir):
    return postings(spark, sf_dir).groupBy("source_name").agg(F.count("*").alias("postings"))


def ids_of(results):
    """Ids of the results of a page, whatever the source calls them."""
    return F.array_join(F.transform(results, lambda r: F.coalesce(
        F.try_variant_get(r, "$.id", "string"), F.try_variant_get(r, "$.job_id", "string"))), ",")


@query
def envelope_normalize(spark, sf_dir):
    good, _ = pages.quarantine(pages.normalize_envelopes(raw_pages(spark, sf_dir)))
    return good.select("block", "source", "keyword", "run", "page", "count", ids_of("results").alias("ids"))


@query
def payload_quarantine(spark, sf_dir):
    _, bad = pages.quarantine(pages.normalize_envelopes(raw_pages(spark, sf_dir)))
    return bad.select("block", "source", "page", "problem")


@query
def assemble_pages(spark, sf_dir):
    """Every page that counts, with the total of its run."""
    good, _ = pages.quarantine(written(pages.normalize_envelopes(raw_pages(spark, sf_dir)), "pages"))
    whole = pages.assemble_pages(good, ["source", "keyword", "run"])
    return whole.select("source", "keyword", "run", "page", "count", ids_of("results").alias("ids"))


@query
def ingest_chain(spark, sf_dir):
    """Raw pages to stored payloads to staged postings: as many as the pages hold."""
    root = scratch_dir(spark, "bronze")
    raw = raw_pages(spark, sf_dir).withColumn("ingested_at", F.to_timestamp(F.lit(AS_OF)))
    ingest(raw, root, ["source", "keyword", "run"])
    return bronze.stage_written(spark, root)


@query
def rejected_payloads(spark, sf_dir):
    """Payloads stored unchecked, and which of them staging cannot read."""
    root = scratch_dir(spark, "unchecked")
    raw_pages(spark, sf_dir).select("payload", "source").write.partitionBy("source").text(root)
    return bronze.rejected_of_all(spark, root, multi_line=False, layout=bronze.WRITTEN_LAYOUT)


@query
def stage_multiline(spark, sf_dir):
    """All sources from payloads of one object per file, over many lines."""
    root = scratch_dir(spark, "objects")
    for source, folder in bronze.FOLDERS.items():
        whole = F.to_json(F.struct("count", "results", "keyword"), {"pretty": "true"})
        envelopes(spark, sf_dir, source).select(whole).write.option("maxRecordsPerFile", 1).text(f"{root}/{folder}")
    return bronze.stage_all(spark, root)


@query
def bronze_keys(spark, sf_dir):
    """What the stored payloads say of themselves."""
    root = scratch_dir(spark, "bronze")
    found = []
    for source, folder in bronze.FOLDERS.items():
        bronze.write_envelopes(envelopes(spark, sf_dir, source), root)
        path = f"{root}/{bronze.WRITTEN_LAYOUT.format(folder=folder)}"
        found.append(bronze.file_keys(spark, path, source, multi_line=False).withColumn("source_name", F.lit(source)))
    return bronze.union_sources(found)


@query
def profile_load(spark, sf_dir):
    """The embeddings table written as profiles and read back."""
    path = scratch_dir(spark, "profiles")
    stored = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("profile_id"),
        F.concat(F.lit('profile "'), F.col("label").cast("string"), F.lit('", of many')).alias("description"),
        F.to_json("embedding").alias("ideal_vector"),
    )
    profile.write_profiles(stored, path)
    total = F.aggregate("ideal_vector", F.lit(0.0), lambda acc, x: acc + x)
    return profile.read_profiles(spark, path).select(
        "profile_id", "description",
        F.size("ideal_vector").alias("dim"), F.round(total, 4).alias("vector_sum"),
    )


@query
def profile_build(spark, sf_dir):
    """Every document as a profile text: embed, store, read back."""
    path = scratch_dir(spark, "profiles")
    texts = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("profile_id"), "text")
    profile.write_profiles(profile.build_profiles(texts, DIM), path)
    vector = F.col("ideal_vector").cast("array<float>").cast("array<double>")
    return profile.read_profiles(spark, path).select(
        "profile_id",
        F.md5("description").alias("description_md5"),
        F.size("ideal_vector").alias("dim"),
        F.round(F.get(vector, F.lit(0)), 6).alias("first_weight"),
        F.round(F.get(vector, F.lit(DIM - 1)), 6).alias("last_weight"),
    )


STORED = (
    "job_id", "source_name", "url", "data_quality_score", "title", "company_name", "description",
    "salary_min_numeric", "is_junior", "is_senior", "is_red_flag", "is_ethical", "is_remote",
)


def stored_columns(location):
    return [
        *STORED, location, stamp("published_at"), joined("extracted_skills"),
        F.round("exp_min_required", 6).alias("exp_min_required"),
        F.size("description_vector").alias("dim"),
        F.col("ingestion_date").cast("string").alias("ingestion_date"),
    ]


@query
def silver_table(spark, sf_dir):
    return stored_silver(spark, sf_dir).select(*stored_columns("location_clean"))


@query
def silver_staging(spark, sf_dir):
    return scoring.staging_view(stored_silver(spark, sf_dir)).select(*stored_columns("job_location"))


@query
def run_log(spark, sf_dir):
    """Every document as one logged run whose error is the whole text."""
    path = scratch_dir(spark, "log")
    runs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("run_id"),
        text.moment(AS_OF).alias("run_at"),
        F.when(F.col("doc_id") % 4 == 0, "FAILED").otherwise("SUCCESS").alias("status"),
        F.col("source").alias("source_name"),
        F.col("n_chars").alias("records_count"),
        F.col("text").alias("error_message"),
    )
    runlog.append_log(runlog.log_entries(runs), path)
    return runlog.read_log(spark, path).withColumn("run_at", stamp("run_at"))


@query
def latest_run(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.col("ts").alias("run_at"),
        F.col("event_type").alias("status"),
        F.col("value").cast("long").alias("records_count"),
    )
    return runlog.latest_run(log)


# ---- cleaning ----

@query
def entity_clean(spark, sf_dir):
    cleaned = text.replace_entities(F.col("description"))
    return postings(spark, sf_dir).select("doc_id", cleaned.alias("description"))


@query
def ellipsis_strip(spark, sf_dir):
    cut = text.strip_ellipsis(F.col("description"), F.col("source_name"), CONFIG.ellipsis_sources)
    return postings(spark, sf_dir).select("doc_id", "source_name", cut.alias("description"))


@query
def parse_published(spark, sf_dir):
    return normalised(spark, sf_dir).select("doc_id", stamp("published_at"))


@query
def location_clean(spark, sf_dir):
    return normalised(spark, sf_dir).select("doc_id", "location_clean")


@query
def strip_html(spark, sf_dir):
    html = table(spark, sf_dir, "pages").select("page_id", "html")
    return html.select("page_id", text.strip_tags(F.col("html")).alias("body"))


@query
def search_text(spark, sf_dir):
    return searchable(spark, sf_dir).select("doc_id", "search_text")


# ---- features ----

@query
def experience_extract(spark, sf_dir):
    df = clean.add_experience(searchable(spark, sf_dir), CONFIG)
    return df.select("doc_id", F.round("exp_min_required", 6).alias("exp_min_required"))


@query
def skill_tags(spark, sf_dir):
    return clean.add_skills(searchable(spark, sf_dir), CONFIG).select("doc_id", joined("extracted_skills"))


@query
def salary_extract(spark, sf_dir):
    return clean.add_salary(searchable(spark, sf_dir), CONFIG).select("doc_id", "salary_min_numeric")


@query
def posting_flags(spark, sf_dir):
    names = ("is_junior", "is_senior", "is_red_flag", "is_ethical", "is_remote")
    return clean.add_flags(searchable(spark, sf_dir)).select("doc_id", *names)


@query
def quality_weight(spark, sf_dir):
    """Weights by posting source, and for names outside the list."""
    named = F.when(F.col("doc_id") % 5 == 4, F.lit("Elsewhere")).otherwise(F.col("source_name"))
    df = postings(spark, sf_dir).withColumn("source_name", named)
    return clean.add_quality_weight(df, CONFIG).select("doc_id", "source_name", "data_quality_score")


@query
def fingerprint(spark, sf_dir):
    key = features.fingerprint(F.col("title"), F.col("company_name"), F.col("location_clean"))
    return normalised(spark, sf_dir).select("doc_id", key.alias("fingerprint"))


@query
def embed_text(spark, sf_dir):
    df = clean.add_embedding(described(spark, sf_dir), CONFIG)
    weights = df.select("doc_id", F.posexplode("description_vector").alias("bucket", "weight"))
    return weights.filter(F.col("weight") != 0).select(
        "doc_id", "bucket", F.round(F.col("weight").cast("double"), 6).alias("weight")
    )


# ---- dedupes ----

@query
def dedup_by_id(spark, sf_dir):
    return dedupe_by_id(normalised(spark, sf_dir), "doc_id").select("doc_id", "job_id", "source_name", F.md5("description").alias("text"))


@query
def dedup_by_fingerprint(spark, sf_dir):
    kept = dedupe_by_both(normalised(spark, sf_dir), "doc_id")
    return kept.select("doc_id", "job_id", "source_name", "title", F.md5("description").alias("text"))


@query
def dedup_by_url(spark, sf_dir):
    rows = normalised(spark, sf_dir).withColumn("ingestion_date", text.moment(AS_OF).cast("date"))
    usable = similarity.valid_vectors(with_vectors(spark, sf_dir, rows), "description_vector", DIM)
    return dedupe_by_url(usable, "doc_id").select("doc_id", "job_id", "url", F.md5("description").alias("text"))


def batches(spark, sf_dir):
    """The postings in three batches: late ones, repeated ones, some without an id or URL."""
    d = F.col("doc_id")
    rows = normalised(spark, sf_dir).withColumns({
        "job_id": F.when(d % 17 != 0, F.col("job_id")), "ingestion_date": text.moment(AS_OF).cast("date"),
    })
    again = (d % 5 == 0) & (d % 17 != 0)
    return [rows.filter(d % 3 == 1), rows.filter((d % 3 == 0) | (d % 3 == 1) & again), rows.filter((d % 3 == 2) | (d % 3 == 0) & again)]


def merged(spark, sf_dir, rule):
    path = scratch_dir(spark, "winners")
    for batch in batches(spark, sf_dir):
        incremental.merge_batch(batch, path, rule._replace(ties=(*rule.ties, digest(batch), F.col("doc_id"))), 16)
    return incremental.read_winners(spark, path)


@query
def merge_by_id(spark, sf_dir):
    """Batch after batch into the stored winners."""
    return merged(spark, sf_dir, incremental.by_id()).select("doc_id", "job_id", "source_name", F.md5("description").alias("text"))


@query
def merge_by_fingerprint(spark, sf_dir):
    return merged(spark, sf_dir, incremental.by_fingerprint()).select("doc_id", "title", "company_name", F.md5("description").alias("text"))


@query
def merge_by_url(spark, sf_dir):
    return merged(spark, sf_dir, incremental.by_url()).select("doc_id", "job_id", "url", F.md5("description").alias("text"))


# ---- similarity ----

def mixed_vectors(spark, sf_dir):
    """The embeddings with some vectors cut short and some missing."""
    v, e = F.col("vec_id"), F.col("embedding")
    mixed = F.when(v % 11 == 5, F.lit(None)).when(v % 7 == 3, F.slice(e, 1, DIM - 1)).otherwise(e)
    return table(spark, sf_dir, "embeddings").select("vec_id", mixed.alias("embedding"))


@query
def valid_vectors(spark, sf_dir):
    return similarity.valid_vectors(mixed_vectors(spark, sf_dir), "embedding", DIM).select("vec_id")


@query
def cosine_similarity(spark, sf_dir):
    usable = similarity.valid_vectors(table(spark, sf_dir, "embeddings"), "embedding", DIM)
    scored = similarity.add_cosine(usable, "embedding", profile_of(spark, sf_dir))
    return scored.select("vec_id", F.round("cosine", 6).alias("cosine"))


@query
def cosine_explode(spark, sf_dir):
    usable = similarity.valid_vectors(table(spark, sf_dir, "embeddings"), "embedding", DIM)
    scored = similarity.cosine_by_position(usable, "vec_id", "embedding", profile_of(spark, sf_dir))
    return scored.select("vec_id", F.round("cosine", 6).alias("cosine"))


@query
def profile_matches(spark, sf_dir):
    """The ten most similar vectors of every vector whose id is divisible by 100."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    asked = vectors.filter(F.col("vec_id") % 100 == 0)
    best = similarity.best_for_profiles(vectors, asked, 10, DIM, "vec_id", "embedding", "vec_id", "embedding")
    return best.select("profile_id", F.col("rank").cast("int").alias("rank"), "posting_id", F.round("cosine", 6).alias("cosine"))


# ---- rules and scores ----

def rule_query(name, group):
    def run(spark, sf_dir):
        rows = featured(spark, sf_dir).withColumns(rules.lowered_texts())
        return rows.select("doc_id", *[points.alias(rule) for rule, points in group(CONFIG).items()])

    run.__name__ = name
    query(run)


rule_query("rule_experience", rules.experience_rules)
rule_query("rule_ethics", rules.ethics_rules)
rule_query("rule_culture", rules.culture_rules)
rule_query("rule_freshness", rules.freshness_rules)
rule_query("rule_skills", rules.skill_rules)


@query
def rule_pillars(spark, sf_dir):
    return scored_rows(spark, sf_dir).select("doc_id", "job_id", *rules.RULE_NAMES)


@query
def rule_total(spark, sf_dir):
    return scoring.add_rule_total(scored_rows(spark, sf_dir), CONFIG).select("doc_id", "raw_rule_score")


@query
def labels(spark, sf_dir):
    return scoring.add_labels(scored_rows(spark, sf_dir)).select("doc_id", "positive_labels", "negative_labels")


@query
def gold_scored(spark, sf_dir):
    return gold(spark, sf_dir).select(
        "job_id", "source_name", "url", "title", "positive_labels", "negative_labels", "raw_rule_score",
        F.round("raw_nlp_score", 4).alias("raw_nlp_score"), "rules_score", "semantic_score", "matching_score",
    )


# ---- ranking and what reads it ----

@query
def ranking_view(spark, sf_dir):
    """Read by name, as the dashboard's server does."""
    publish_views(stored_silver(spark, sf_dir), stored_gold(spark, sf_dir), CONFIG)
    return shown(spark.table("ranked_postings"))


@query
def top_n(spark, sf_dir):
    """Of the stored Gold only what can be among the best is read."""
    stored = stored_gold(spark, sf_dir)
    return shown(ranking.stored_top_n(stored, tables.read_scores(spark, gold_path(spark, sf_dir)), CONFIG))


@query
def search_filter(spark, sf_dir):
    rows = ranking.with_min_score(ranked(spark, sf_dir), 45)
    return rows.select("title", "platform", "original_url", "matching_score")


@query
def fresh_only(spark, sf_dir):
    return shown(ranking.fresh_only(ranked(spark, sf_dir), AS_OF)).select(
        "title", "platform", "original_url", "published_at"
    )


@query
def search_any_column(spark, sf_dir):
    return shown(ranking.search_any_column(ranked(spark, sf_dir), "SNOWFLAKE|B.corp|confirmÉ"))


@query
def display_clean(spark, sf_dir):
    return display.display_clean(ranked(spark, sf_dir)).withColumns({
        c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in display.TIME_COLUMNS
    })


@query
def score_bands(spark, sf_dir):
    return display.score_bands(display.display_clean(ranked(spark, sf_dir))).select(
        "title", "platform", "original_url", "matching_visual", "semantic_visual", "rules_visual"
    )


@query
def top_3(spark, sf_dir):
    return display.top_cards(ranked(spark, sf_dir), AS_OF).select(
        "title", "platform", "matching_score", "is_new", "title_short",
        joined("top_positive"), joined("top_negative"),
    )


@query
def filtered_top_3(spark, sf_dir):
    """The dashboard's filters one after another, the search over what it displays, then its cards."""
    left = display.dashboard(ranked(spark, sf_dir), AS_OF, 40, only_fresh=True, pattern="n/a|junior")
    return display.top_cards(left, AS_OF).select(
        "title", "platform", "matching_score", "matching_visual", "salary_visual", "is_new"
    )


@query
def search_displayed(spark, sf_dir):
    """A search for what only the display shows: no salary, and a band."""
    left = display.dashboard(ranked(spark, sf_dir), AS_OF, 30, pattern="^n/a$|🟡 6")
    return left.select("title", "platform", "original_url", "matching_visual", "salary_visual")


@query
def kpi_summary(spark, sf_dir):
    return display.key_figures(ranked(spark, sf_dir), AS_OF)


@query
def kpi_avg_salary(spark, sf_dir):
    return display.average_salary(ranked(spark, sf_dir))


# ---- data checks ----

@query
def dq_not_null(spark, sf_dir):
    wanted = {"job_id": "error", "title": "warn", "company_name": "warn", "url": "warn", "location": "warn"}
    return quality.run_checks(postings(spark, sf_dir), quality.not_null(wanted))


@query
def dq_unique(spark, sf_dir):
    return quality.duplicates(postings(spark, sf_dir), "job_id")


@query
def dq_accepted_values(spark, sf_dir):
    """Document sources are not posting sources; some names are put right."""
    source = F.when(F.col("doc_id") % 3 == 0, F.lit("Jooble")).otherwise(F.col("source"))
    df = table(spark, sf_dir, "documents").withColumn("source_name", source)
    return quality.run_checks(df, quality.accepted_values("source_name"))


@query
def dq_ranges(spark, sf_dir):
    """Ranges over event values and label flags, where some rows fail."""
    events = quality.run_checks(table(spark, sf_dir, "events"), quality.ranges({"value": (0, 30)}))
    marks = quality.run_checks(table(spark, sf_dir, "labels"), quality.ranges({"quality": (0, 1), "toxic": (0, 0)}))
    return events.unionByName(marks)


@query
def dq_blank(spark, sf_dir):
    blanked = F.when(div(F.col("doc_id"), 4) % 9 == 2, F.lit("  ")).otherwise(F.col("url"))
    df = postings(spark, sf_dir).withColumn("url", blanked)
    return quality.run_checks(df, quality.not_blank("url"))


@query
def dq_failing_rows(spark, sf_dir):
    """Every posting that fails a check, and which."""
    d = F.col("doc_id")
    rows = postings(spark, sf_dir).withColumns({
        "source_name": F.when(d % 23 == 4, F.lit("Elsewhere")).otherwise(F.col("source_name")),
        "job_id": F.when(d % 19 != 3, F.col("job_id")),
        "url": F.when(div(d, 4) % 9 == 2, F.lit("  ")).otherwise(F.col("url")),
    })
    checks = quality.not_null({"job_id": "error", "company_name": "warn"}) + quality.accepted_values("source_name")
    checks += quality.not_blank("url") + quality.ranges({"vec_id": (0, 400)}, "warn")
    failing = quality.failing_rows(rows, checks, {"job_id": "error"})
    return failing.select("doc_id", joined("failed"), joined("errors"))


@query
def dq_silver(spark, sf_dir):
    return quality.silver_report(stored_silver(spark, sf_dir))


@query
def dq_staging(spark, sf_dir):
    return quality.staging_report(scoring.staging_view(stored_silver(spark, sf_dir)))


@query
def dq_ranking(spark, sf_dir):
    return quality.ranking_report(ranked(spark, sf_dir))


@query
def dq_report(spark, sf_dir):
    """All checks of the scored table, over the table as stored."""
    return quality.gold_report(stored_gold(spark, sf_dir))
