"""One query per corpus operator, over whole tables, and its SQL where there is one."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postrank.llm import (
    bpe, exact_dedup, language, mixing, packing, periodic, phrases, sharding, simhash, sketch, token_codes, url_rules, warc,
)
from postrank.llm.rows import SPACE
from postrank.storage import written


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", "keep_id", F.col("group_size").cast("long"), "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op2_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every draw of the mixture: which document, in which epoch, block and place."""
    docs = table(spark, sf_dir, "documents")
    row = F.monotonically_increasing_id()
    narrow = written(docs.select("doc_id", *mixing.narrow_columns(row)), "tokens")
    drawn = mixing.draws(narrow.drop("doc_id"))
    return narrow.select("row", "doc_id").join(drawn, "row").select(
        "doc_id", "source", "tokens", "epoch", "block", "place"
    )


def op3_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sketch.compare_neighbours(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next", "in_edited", "in_next",
    )


def op4_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    return token_codes.read_tokens(token_codes.token_files(spark, table(spark, sf_dir, "documents"), tokenizer))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


#: The rules of the URL query.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


def op6_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), url_rules.make_rules(spark, URL_RULES))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("value"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    shards, shard, slot = sharding.shuffled_shards(docs)
    body = F.coalesce("text", F.lit(""))
    return shards.select(
        "doc_id", (F.octet_length(body).cast("long") + 1).alias("size"), F.crc32(body).alias("text_crc32"),
        F.lit("rows").alias("law"), F.col(shard).alias("shard"), F.col(slot).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.archive_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return warc.read_records(index, with_payload=False).select(
        F.col("page_id").cast("long"), "payload_bytes", F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), F.col("refers_to_page").cast("long").alias("refers_to"),
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language.held_out(F.col("doc_id"))
    model = language.train(docs.filter(~out))
    told, pred, score = language.identify(docs.select("doc_id", "text"), model)
    return told.select("doc_id", out.alias("held_out"), F.col(pred).alias("lang_pred"), F.col(score).alias("score"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = docs.select("doc_id", bpe.encode_column(F.col("text"), tokenizer).alias("ids"))
    told = coded.select("doc_id", "ids", bpe.decode_column(F.col("ids"), tokenizer).alias("decoded"))
    return told.select(
        "doc_id", F.call_function("div", F.octet_length("ids"), F.lit(4)).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf_dir, "documents"))


def with_periods(doc_id: Column, text: Column) -> Column:
    """A tenth of the texts made periodic from some word on, by a hash of their id."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.call_function("div", h, F.lit(10))
    n = F.greatest(F.size("words").cast("long"), F.lit(1))
    a = g % n
    p = 1 + F.call_function("div", n - a, 3 + g % 8)
    whole = F.array_repeat(F.slice("words", (a + 1).cast("int"), p.cast("int")), (F.call_function("div", n - a, p) + 1).cast("int"))
    rest = F.slice(F.flatten(whole), F.lit(1), (n - a).cast("int"))
    planted = F.array_join(F.concat(F.slice("words", F.lit(1), a.cast("int")), rest), " ")
    return F.when((h % 10 == 0) & (F.size("words") > 0), planted).otherwise(text)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    words = F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0
    cut = docs.withColumn("words", F.when(hit, words))
    planted = cut.select("doc_id", with_periods(F.col("doc_id"), F.col("text")).alias("text"))
    found = planted.select("doc_id", periodic.periodic_column(F.col("text")).alias("found")).select("doc_id", "found.*")

    def before(x: Column, y: Column) -> Column:
        power = x["length"] * y["period"] - y["length"] * x["period"]
        order = F.when(power != 0, -power).when(x["start"] != y["start"], x["start"] - y["start"]).otherwise(x["period"] - y["period"])
        return F.signum(order).cast("int")

    best = F.get(F.array_sort("runs", before), F.lit(0))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))))
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.call_function("div", F.col("best.length") * 1000, F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_temperature_mixing, op3_scaled_sketch, op4_token_codes, op5_best_fit_packing,
    op6_url_rules, op7_simhash_dedup, op8_sharding, op9_warc, op10_language_id,
    op11_bpe, op12_phrases, op13_periodic_runs,
)}

ORACLES = {
    "op1_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       first_value(doc_id) OVER w = doc_id AS kept,
       text_sha256
FROM d
WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id)
""",
    "op6_url_rules": r"""
WITH u AS (
  SELECT page_id,
         CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM u
), r(rule_host, rule_path, verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), f AS (
  SELECT h.page_id, h.host, h.path, rule_host || rule_path AS rule, verdict,
         row_number() OVER (PARTITION BY h.page_id ORDER BY length(rule_host || rule_path) DESC NULLS LAST) AS n
  FROM h LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f WHERE n = 1
""",
    "op9_warc": r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS latest FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> latest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> latest THEN latest END AS refers_to
FROM m
""",
    "op12_phrases": r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), pieces AS (
  SELECT row_number() OVER () AS piece, lang, piece_text
  FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece_text FROM docs)
), split AS (
  SELECT piece, lang, list_filter(regexp_split_to_array(piece_text, '[\x20\x09]+'), lambda w: w <> '') AS words FROM pieces
), grams AS MATERIALIZED (
  SELECT lang, m, list_aggregate(words[i : i + m - 1], 'string_agg', ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM split, (VALUES (1), (2), (3), (4)) AS sizes(m))
  GROUP BY ALL
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang
), candidates AS MATERIALIZED (
  SELECT lang, m, phrase, a, string_split(phrase, ' ') AS words FROM grams WHERE m >= 2 AND a >= 30
), parts AS MATERIALIZED (
  SELECT lang, m, phrase, a, k, array_to_string(words[1 : k], ' ') AS first_part, array_to_string(words[k + 1 : m], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates)
), cuts AS (
  SELECT p.lang, p.m, p.phrase, p.a, p.k, x.a AS l, y.a AS r,
         (2000000::HUGEINT * p.a // (x.a + y.a))::BIGINT AS score
  FROM parts p JOIN grams x ON x.lang = p.lang AND x.phrase = p.first_part
  JOIN grams y ON y.lang = p.lang AND y.phrase = p.rest
), scored AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, m, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, size AS m, array_to_string(words[i : i + size - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT lang, words, a, m, size, unnest(range(1, m - size + 2)) AS i
        FROM candidates JOIN (VALUES (2), (3)) AS sizes(size) ON size < m)
  GROUP BY ALL
), survivors AS (
  SELECT s.* FROM scored s LEFT JOIN inner_phrases i ON i.lang = s.lang AND i.m = s.m AND i.phrase = s.phrase
  WHERE i.most IS NULL OR 100::HUGEINT * i.most < 80::HUGEINT * s.a
)
SELECT s.lang, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM survivors s JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, phrase) <= 2000
""",
}
