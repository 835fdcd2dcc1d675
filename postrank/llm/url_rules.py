"""URL filters by host and path rules.

A rule is a host and the beginning of a path; it fits its host, all subdomains,
and every path that starts so. Each URL is expanded into expressions: suffixes of
its host at label borders, each with prefixes of its path. Only suffixes of as
many labels and prefixes of as many characters as some rule has are made, so the
expansion is exact for any rule and bounded by the rules' shapes. Expressions
meet rules in an equi-join on the first four bytes of their SHA-256; the full
digest confirms. Of the rules that fit the longest wins (characters of host and
path, then of the host); of equal rules, block wins.

Rules are joined as a table: Spark broadcasts them when they are few and
shuffles both sides, splitting hot hosts, when they are not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postrank.llm.rows import quoted

ALLOW, BLOCK = "allow", "block"
#: Verdict where no rule fits.
OTHERWISE = ALLOW
RULES = "host string, path string, verdict string"
PREFIX_BYTES = 4


def make_rules(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules from (host/path, verdict) pairs already cut into host, path, verdict."""
    return spark.createDataFrame(rules, RULES)


def lowered(value: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(value, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a URL without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise("")
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    after = F.substring(rest, F.length(host) + 1, F.length(rest))
    return lowered(host), F.regexp_extract(after, r"(?s)^([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path), 256))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", page_id: str = "page_id") -> DataFrame:
    """page_id, host, path, rule (host and path of the rule that won, or null), verdict.

    One row per row of ``pages``, repeated ids and null ids included. ``rules`` as
    RULES; a host without a dot (``net``) stands for all below it.
    """
    rules = rules.select(lowered(F.col("host")).alias("host"), "path", "verdict")
    shape = rules.agg(
        F.array_sort(F.collect_set(F.size(F.split("host", r"\.")))).alias("labels"),
        F.array_sort(F.collect_set(F.length("path"))).alias("lengths"),
    ).first()  # as many numbers as rules differ in labels or length, not as there are rules
    known = rules.select(
        _digest(F.col("host"), F.col("path")).alias("rule_digest"),
        F.struct(
            F.length(F.concat("host", "path")).alias("length"), F.length("host").alias("host_length"),
            (F.col("verdict") == BLOCK).alias("blocks"), F.concat("host", "path").alias("rule"), F.col("verdict"),
        ).alias("found"),
    ).withColumn("prefix", F.substring("rule_digest", 1, PREFIX_BYTES))

    host, path = host_and_path(F.col(quoted(url)))
    each = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(quoted(page_id)).alias("page_id"), host.alias("host"), path.alias("path")
    )
    labels = F.split("host", r"\.")

    def suffix(n: Column) -> Column:
        """The last ``n`` labels of the host; null if it has fewer."""
        last = F.concat_ws(".", F.slice(labels, F.size(labels) - n + 1, n))
        return F.when(n < F.size(labels), last).when(n == F.size(labels), F.col("host"))

    suffixes = F.filter(
        F.transform(F.lit(shape["labels"]).cast("array<int>"), suffix),
        lambda s: s.isNotNull(),
    )
    prefixes = F.transform(
        F.filter(F.lit(shape["lengths"]).cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.substring(F.col("path"), F.lit(1), n)
    )
    expanded = (
        each.withColumn("suffix", F.explode_outer(suffixes)).withColumn("start", F.explode_outer(prefixes))
        .withColumn("digest", _digest(F.col("suffix"), F.col("start")))
        .withColumn("short", F.substring("digest", 1, PREFIX_BYTES))
    )
    met = expanded.join(known, (F.col("short") == F.col("prefix")) & (F.col("digest") == F.col("rule_digest")), "left")
    won = met.groupBy("row").agg(
        F.first("page_id").alias("page_id"), F.first("host").alias("host"), F.first("path").alias("path"), F.max("found").alias("found")
    )
    return won.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", F.lit(OTHERWISE)).alias("verdict")
    )
