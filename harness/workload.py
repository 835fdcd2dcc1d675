"""The given tables seen as postings and as raw result pages.

Each derivation exists twice, as a DataFrame and as SQL text for the check
engine. Both cover the whole tables and whole texts. Groups are bounded by
construction (a page holds 8 documents, an envelope at most 50), while a third
of all postings shares a few hundred fingerprints, so dedupes meet hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postrank.config import RankingConfig
from postrank.sources.pages import SHAPES

AS_OF = "2024-01-31 00:00:00"
DIM = 64
CONFIG = RankingConfig(as_of=AS_OF, vector_dim=DIM)

SOURCES = ["Adzuna", "France Travail", "Jooble", "JSearch"]
TITLES = [
    "Data Engineer Junior", "Lead Data Engineer", "Senior DevOps", "Data Analyst confirmé",
    "Directeur Data", "Stage Data Engineer", "Technicien support", "Data Engineer",
    "Ingénieur DevOps débutant", "Cloud Architect – AWS", "Alternance Data",
]
COMPANIES = ["Atelier Nord", "Banque du Lac", "SCOP Verte", "Assurance Ouest", "Corp – Inc", None, "Cloud Inc"]
LOCATIONS = ["44 - Nantes", "Nantes (44000)", "Paris 75", "Saint-Herblain", None]
SALARIES = ["45k", "45 000 - 50 000", "12000", None, '{"libelle":"38000 Euros"}', "100000", "45K"]
PHRASES = [
    "python dbt spark aws", "3 ans d'expérience, télétravail", "18 mois minimum, open source",
    "secteur défense", "situé à la défense", "armement et missile", "b corp, mentorat",
    "mentorat, encadrer juniors", "société à mission&nbsp;climat", "gratification du stagiaire",
    "expérience significative", "<p>technicien</p> snowflake et dbt", "20 ans de pratique...",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by))


def pick(values: list, index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    vectors = table(spark, sf_dir, "embeddings").agg(F.count("*")).scalar()
    suffix = F.when(d % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(" "), div(d, 16).cast("string")))
    body = F.concat(F.lit(" "), F.col("text"))
    day = F.lpad((1 + d % 30).cast("string"), 2, "0")
    return documents.select(
        "doc_id",
        (div(d, 8) * 4 + d % 4).cast("string").alias("job_id"),
        pick(SOURCES, d % 4).alias("source_name"),
        F.concat(pick(TITLES, div(d, 3) % 11), suffix).alias("title"),
        pick(COMPANIES, div(d, 5) % 7).alias("company_name"),
        pick(LOCATIONS, div(d, 2) % 5).alias("location"),
        pick(SALARIES, d % 7).alias("salary_info"),
        F.concat(pick(PHRASES, d % 13), body).alias("description"),
        F.when(d % 10 == 9, "n/a")
        .otherwise(F.concat(F.lit("2024-01-"), day, F.lit(" 12:00:00")))
        .alias("created_at"),
        F.when(d % 50 != 0, F.concat(F.lit("https://ex.com/"), (div(d, 16) * 13 + d % 13).cast("string"))).alias("url"),
        (d % vectors).alias("vec_id"),
    )


def _sql_list(values: list) -> str:
    return "[" + ", ".join("NULL" if v is None else "'" + v.replace("'", "''") + "'" for v in values) + "]"


def _sql_pick(values: list, index: str) -> str:
    return f"({_sql_list(values)})[({index}) + 1]"


POSTINGS_SQL = f"""
SELECT doc_id,
       CAST((doc_id // 8) * 4 + doc_id % 4 AS VARCHAR) AS job_id,
       {_sql_pick(SOURCES, "doc_id % 4")} AS source_name,
       {_sql_pick(TITLES, "(doc_id // 3) % 11")}
         || CASE WHEN doc_id % 3 = 0 THEN '' ELSE ' ' || (doc_id // 16) END AS title,
       {_sql_pick(COMPANIES, "(doc_id // 5) % 7")} AS company_name,
       {_sql_pick(LOCATIONS, "(doc_id // 2) % 5")} AS location,
       {_sql_pick(SALARIES, "doc_id % 7")} AS salary_info,
       {_sql_pick(PHRASES, "doc_id % 13")}
         || ' ' || text AS description,
       CASE WHEN doc_id % 10 = 9 THEN 'n/a'
            ELSE '2024-01-' || lpad(CAST(1 + doc_id % 30 AS VARCHAR), 2, '0') || ' 12:00:00' END AS created_at,
       CASE WHEN doc_id % 50 <> 0
            THEN 'https://ex.com/' || ((doc_id // 16) * 13 + doc_id % 13) END AS url,
       doc_id % (SELECT count(*) FROM embeddings) AS vec_id
FROM documents
"""

# One page is a block of 8 documents, five pages a run. Behind the pages of each
# run comes one more that is empty, holds text instead of a list, lacks the
# list, or is no JSON at all.
SHAPE_NAMES = list(SHAPES)
ITEM_FIELDS = {
    "adzuna": ("id", "description"), "france_travail": ("id", "description"),
    "jooble": ("id", "snippet"), "jsearch": ("job_id", "job_description"),
}
BAD_PAGE = 6
EXTRA = ("empty", "text", "absent", "broken")


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    b, run = F.col("block"), div(F.col("block"), 5)
    documents = table(spark, sf_dir, "documents")
    item = F.struct("doc_id", "text")
    blocks = documents.groupBy(div(F.col("doc_id"), 8).alias("block")).agg(F.sort_array(F.collect_list(item)).alias("items"))

    def renamed(key: str, body: str) -> Column:
        return F.to_json(F.transform("items", lambda x: F.struct(x["doc_id"].alias(key), x["text"].alias(body))))

    named = {s: renamed(*fields) for s, fields in ITEM_FIELDS.items()}
    source = pick(SHAPE_NAMES, run % 4)
    keys = pick([SHAPES[s].results_key for s in SHAPE_NAMES], run % 4)
    totals = pick([SHAPES[s].count_key or "total" for s in SHAPE_NAMES], run % 4)
    counted = F.when(b % 3 == 0, F.lit("")).otherwise(F.concat(F.lit(',"'), totals, F.lit('":'), (b * 10).cast("string")))
    results = F.coalesce(*[F.when(source == s, text) for s, text in named.items()])

    def page(rows: DataFrame, number: Column, block: Column, payload: Column) -> DataFrame:
        return rows.select(
            block.alias("block"), source.alias("source"), F.concat(F.lit("kw"), (run % 3).cast("string")).alias("keyword"),
            run.alias("run"), number.alias("page"), payload.alias("payload"),
        )

    start = F.concat(F.lit('{"page":'), (b % 5 + 1).cast("string"), counted)
    real = page(blocks, b % 5 + 1, b, F.concat(start, F.lit(',"'), keys, F.lit('":'), results, F.lit("}")))
    runs = documents.select((div(F.col("doc_id"), 40) * 5).alias("block")).distinct()
    bad = {
        "empty": F.concat(F.lit('{"page":6,"'), keys, F.lit('":[]}')),
        "text": F.concat(F.lit('{"page":6,"'), keys, F.lit('":"not_a_list"}')),
        "absent": F.lit('{"page":6}'),
        "broken": F.lit("oops"),
    }
    kind = pick(list(EXTRA), div(run, 4) % 4)
    more = page(runs, F.lit(BAD_PAGE).cast("long"), -b - 1, F.coalesce(*[F.when(kind == k, text) for k, text in bad.items()]))
    return real.unionByName(more)


_SQL_SOURCE = _sql_pick(SHAPE_NAMES, "run % 4")
_SQL_KEY = _sql_pick([SHAPES[s].results_key for s in SHAPE_NAMES], "run % 4")
_SQL_TOTAL = _sql_pick([SHAPES[s].count_key or "total" for s in SHAPE_NAMES], "run % 4")
_SQL_ITEMS = "CASE " + " ".join(
    f"WHEN {_SQL_SOURCE} = '{s}' THEN CAST(to_json(list({{'{f[0]}': doc_id, '{f[1]}': text}} ORDER BY doc_id)) AS VARCHAR)"
    for s, f in ITEM_FIELDS.items()
) + " END"
RAW_PAGES_SQL = f"""
SELECT block, {_SQL_SOURCE} AS source, 'kw' || (run % 3) AS keyword, run, block % 5 + 1 AS page,
       '{{"page":' || (block % 5 + 1)
         || CASE WHEN block % 3 = 0 THEN '' ELSE ',"' || {_SQL_TOTAL} || '":' || (block * 10) END
         || ',"' || {_SQL_KEY} || '":' || items || '}}' AS payload
FROM (SELECT doc_id // 8 AS block, doc_id // 40 AS run, {_SQL_ITEMS.replace("run % 4", "(doc_id // 40) % 4")} AS items
      FROM documents GROUP BY doc_id // 8, doc_id // 40, (doc_id // 40) % 4)
UNION ALL
SELECT -run * 5 - 1, {_SQL_SOURCE}, 'kw' || (run % 3), run, {BAD_PAGE},
       CASE (run // 4) % 4 WHEN 0 THEN '{{"page":6,"' || {_SQL_KEY} || '":[]}}'
                           WHEN 1 THEN '{{"page":6,"' || {_SQL_KEY} || '":"not_a_list"}}'
                           WHEN 2 THEN '{{"page":6}}' ELSE 'oops' END
FROM (SELECT DISTINCT doc_id // 40 AS run FROM documents)
"""


def envelopes(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    """The postings of one source as payloads of at most 50, in its own fields."""
    created = F.when(F.col("created_at") != "n/a", F.col("created_at"))
    fields = {
        "Adzuna": F.struct(
            F.col("job_id").alias("id"), "title",
            F.struct(F.col("company_name").alias("display_name")).alias("company"),
            "description", F.struct(F.col("location").alias("display_name")).alias("location"),
            F.col("salary_info").try_cast("double").alias("salary_min"),
            created.alias("created"), F.col("url").alias("redirect_url"),
        ),
        "France Travail": F.struct(
            F.col("job_id").alias("id"), F.col("title").alias("intitule"),
            F.struct(F.col("company_name").alias("nom")).alias("entreprise"), "description",
            F.struct(F.col("location").alias("libelle")).alias("lieuTravail"),
            F.when(F.col("salary_info").isNotNull(), F.struct(
                F.col("salary_info").alias("libelle"), F.lit(38000).alias("minimum"), F.lit("45k").alias("autre")
            )).alias("salaire"),
            created.alias("dateCreation"), F.struct(F.col("url").alias("urlOrigine")).alias("origineOffre"),
        ),
        "JSearch": F.struct(
            "job_id", F.col("title").alias("job_title"), F.col("company_name").alias("employer_name"),
            F.col("description").alias("job_description"), F.col("location").alias("job_city"),
            F.lit("FR").alias("job_country"), created.alias("job_posted_at_datetime_utc"),
            F.col("url").alias("job_apply_link"),
        ),
        "Jooble": F.struct(
            F.col("job_id").alias("id"), "title", F.col("company_name").alias("company"),
            F.col("description").alias("snippet"), "location", F.col("salary_info").alias("salary"),
            created.alias("updated"), F.col("url").alias("link"),
        ),
    }
    chosen = postings(spark, sf_dir).filter(F.col("source_name") == source)
    return chosen.groupBy(div(F.col("doc_id"), 200).alias("run")).agg(
        F.collect_list(fields[source]).alias("results"), F.count("*").alias("count")
    ).select(
        F.lit(source.lower().replace(" ", "_")).alias("source"),
        F.concat(F.lit("Data Engineer "), (F.col("run") % 5).cast("string")).alias("keyword"),
        F.to_timestamp(F.lit(AS_OF)).alias("ingested_at"),
        "count",
        "results",
    )
