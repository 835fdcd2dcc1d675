"""Raw pages of a source: check them, name their parts alike, put them in order."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Shape(NamedTuple):
    """Where a source keeps its results and their total.

    Without ``count_key`` in a payload the total is the length of the list,
    or 0 if ``count_defaults_to_zero``. ``count_key=None`` always counts.
    """

    results_key: str
    count_key: str | None
    count_defaults_to_zero: bool


# --- Fixed values: payload keys of each source ---
SHAPES = {
    "adzuna": Shape("results", "count", True),
    "france_travail": Shape("resultats", "nbResultats", True),
    "jooble": Shape("jobs", "totalCount", False),
    "jsearch": Shape("data", None, False),
}


def _by_source(value) -> Column:
    return F.coalesce(*[F.when(F.col("source") == s, value(shape)) for s, shape in SHAPES.items()])


def normalize_envelopes(raw: DataFrame) -> DataFrame:
    """Give raw payloads one shape.

    ``raw`` has ``source`` (a key of ``SHAPES``) and ``payload`` (JSON text).
    Adds ``results`` (the list, each item as it came, as a VARIANT), ``count``,
    and ``problem``: NULL, or why the payload cannot be used. A payload without
    the results key has an empty list; one where it is no list is a problem.

    The payload is parsed once. ``explode`` of that one value keeps later
    filters from being moved below it, where they would parse again.
    """
    parsed = raw.select("*", F.explode(F.array(F.try_parse_json("payload"))).alias("_json"))
    is_object = F.schema_of_variant("_json").startswith("OBJECT")
    listed = _by_source(lambda s: F.try_variant_get("_json", f"$.{s.results_key}", "array<variant>"))
    absent = _by_source(lambda s: F.try_variant_get("_json", f"$.{s.results_key}", "variant").isNull())
    stated = _by_source(lambda s: F.try_variant_get("_json", f"$.{s.count_key}", "bigint") if s.count_key else F.lit(None).cast("bigint"))
    taken = parsed.select(
        *raw.columns,
        F.explode(F.array(F.struct(
            F.coalesce(is_object, F.lit(False)).alias("object"),
            F.when(absent, F.array().cast("array<variant>")).otherwise(listed).alias("results"),
            stated.alias("stated"),
        ))).alias("_found"),
    )
    known = F.coalesce(F.col("source").isin(*SHAPES), F.lit(False))
    problem = (
        F.when(~F.col("_found.object"), "not a JSON object")
        .when(~known, "unknown source")
        .when(F.col("_found.results").isNull(), "results is not a list")
    )
    total = _by_source(lambda s: F.coalesce(
        "_found.stated",
        F.lit(0).cast("bigint") if s.count_defaults_to_zero else F.size("_found.results").cast("bigint"),
    ))
    return taken.select(
        *raw.columns,
        F.when(problem.isNull(), F.col("_found.results")).alias("results"),
        F.when(problem.isNull(), total).alias("count"),
        problem.alias("problem"),
    )


def quarantine(normalized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable payloads, and the rest with the ``problem`` of each."""
    good = normalized.filter(F.col("problem").isNull()).drop("problem")
    bad = normalized.filter(F.col("problem").isNotNull()).drop("results", "count")
    return good, bad


def assemble_pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    """The pages of each of ``keys`` that count, one row each.

    ``pages`` has ``page`` (from 1, each at most once per key), ``results``
    (array) and ``count``. Reading stops before the first page that is empty,
    NULL or absent, however many come before it. ``count`` becomes that of page
    1, which is the total of the key.

    Which pages count is found on narrow rows: a page with results is an end if
    the next has none, and the smallest end of a key that begins at page 1 is
    its last page. So no group is gathered, as rows or as a list.
    """
    filled = pages.filter(F.size("results") > 0).select(*keys, "page")
    following = filled.select(*keys, (F.col("page") - 1).alias("page"))
    same = [filled[k].eqNullSafe(following[k]) for k in keys]
    ends = filled.join(following, [*same, filled["page"] == following["page"]], "left_anti")
    last = ends.groupBy(*keys).agg(F.min("page").alias("_last"))
    first = pages.filter((F.col("page") == 1) & (F.size("results") > 0)).select(
        *keys, F.col("count").alias("_total")
    )
    spans = _joined(first, last, keys)
    rest = _joined(pages.filter(F.col("page") >= 1).drop("count"), spans, keys)
    return rest.filter(F.col("page") <= F.col("_last")).drop("_last").withColumnRenamed("_total", "count")


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on keys of which some may be NULL on both sides."""
    named = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    met = left.join(named, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return met.drop(*[f"_{k}" for k in keys])
