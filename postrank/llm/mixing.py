"""Mixing sources to target weights, by temperature.

A source's share of all tokens is raised to an exponent between 0 (all sources
alike) and 1 (as they are) and normalised. The exponent is bisected: either the
mixture must reach a target entropy, or no source may be repeated more often
than a limit while every document is drawn at least once. The driver sees one
row per source: names, tokens, rows.

The weights are then realised. A source with weight w and a budget of B tokens
owes w * B tokens. It pays in epochs; each epoch is a permutation of the source
by a seeded hash, whole epochs first, the last one as far as the budget goes.
The draws of all sources are cut into blocks of ``BLOCK_TOKENS``: a draw that
begins at a fraction f of what its source owes falls into block floor(f * blocks),
so every block holds the sources at their weights. Within a block draws are
ordered by another seeded hash.

The running token sum of a permutation is found without gathering a source: rows
are dealt to hash ranges of bounded size, the ranges' sums are added up in order
(one small row per range), and each range adds up its own rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postrank.llm.rows import fresh, keyed, quoted, words
from postrank.storage import written

SEED = 42
BLOCK_TOKENS = 1 << 20
#: Rows of one hash range.
RANGE_ROWS = 4_000
#: No source is read more often than this, unless a target entropy is asked for.
REPETITIONS = 2.0
STEPS = 60
#: Name of the source of rows whose source is null.
NO_SOURCE = ""


@dataclass(frozen=True)
class Plan:
    exponent: float
    budget: float
    weights: dict[str, float]
    owed: dict[str, int]


def weights_at(tokens: dict[str, int], exponent: float) -> dict[str, float]:
    total = sum(tokens.values())
    raised = {s: (n / total) ** exponent for s, n in tokens.items()}
    whole = math.fsum(raised.values())
    return {s: w / whole for s, w in raised.items()}


def entropy(weights: dict[str, float]) -> float:
    return -math.fsum(w * math.log(w) for w in weights.values() if w > 0)


def least_budget(tokens: dict[str, int], weights: dict[str, float]) -> float:
    """The budget at which every source is drawn once at least."""
    return max(n / weights[s] for s, n in tokens.items())


def _bisect(holds) -> float:
    """The smallest exponent in [0, 1] for which ``holds``; it holds from there on, or nowhere but at 1."""
    low, high = 0.0, 1.0
    if holds(low):
        return low
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high


def make_plan(tokens: dict[str, int], repetitions: float = REPETITIONS, target_entropy: float | None = None,
              budget: float | None = None) -> Plan:
    """The mixture for token counts per source, all above 0.

    With ``target_entropy`` (in nats) the exponent is the largest whose mixture
    has at least that entropy, or 0 if none has. Otherwise it is the smallest at
    which no source is drawn more than ``repetitions`` times. Without ``budget``
    every document is drawn at least once; a smaller budget draws fewer.
    """
    if not tokens:
        return Plan(1.0, 0.0, {}, {})

    def repeats(exponent: float) -> float:
        weights = weights_at(tokens, exponent)
        size = least_budget(tokens, weights) if budget is None else budget
        return max(weights[s] * size / n for s, n in tokens.items())

    if target_entropy is None:
        exponent = _bisect(lambda a: repeats(a) <= repetitions)
    elif entropy(weights_at(tokens, 1.0)) >= target_entropy:
        exponent = 1.0
    elif entropy(weights_at(tokens, 0.0)) < target_entropy:
        exponent = 0.0
    else:  # just below the first exponent that misses the entropy
        exponent = max(0.0, _bisect(lambda a: entropy(weights_at(tokens, a)) < target_entropy) - 2.0**-STEPS)
    weights = weights_at(tokens, exponent)
    size = least_budget(tokens, weights) if budget is None else float(budget)
    # A source that owes all its tokens owes them exactly, whatever the rounding.
    owed = {s: n if abs(weights[s] * size - n) < 1e-6 * n else math.floor(weights[s] * size) for s, n in tokens.items()}
    return Plan(exponent, size, weights, owed)


def _unit(*parts: Column) -> Column:
    """A hash as a number from 0 to below 1."""
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / float(1 << 53)


def draws(narrow: DataFrame, repetitions: float = REPETITIONS, target_entropy: float | None = None,
          budget: float | None = None, seed: int = SEED) -> DataFrame:
    """row, source, tokens, epoch, block, place: one row per draw of a document.

    ``narrow`` has row (unique), source and tokens (above 0), stored. ``place``
    orders the draws of a block.
    """
    spark = narrow.sparkSession
    sums = narrow.groupBy("source").agg(F.sum("tokens").alias("total"), F.count("*").alias("rows")).collect()
    plan = make_plan({r["source"]: r["total"] for r in sums}, repetitions, target_entropy, budget)
    blocks = max(1, math.ceil(plan.budget / BLOCK_TOKENS))
    table = spark.createDataFrame(
        [(r["source"], r["total"], plan.owed[r["source"]], math.ceil(r["rows"] / RANGE_ROWS)) for r in sums],
        "source string, total long, owed long, ranges int",
    )
    # One row per source: as bounded as the list of sources, which Spark sizes itself.
    known = narrow.join(table, "source")
    last = F.ceil(F.col("owed") / F.col("total")).cast("int")
    drawn = known.withColumn("epoch", F.explode(F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(F.array().cast("array<int>"))))
    drawn = drawn.withColumn("order", _unit(F.lit(seed), F.col("epoch"), F.col("row")))
    drawn = drawn.withColumn("range", F.floor(F.col("order") * F.col("ranges")).cast("int"))
    spans = drawn.groupBy("source", "epoch", "range").agg(F.sum("tokens").alias("span"))
    before = Window.partitionBy("source", "epoch").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("source", "epoch", "range", F.coalesce(F.sum("span").over(before), F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source", "epoch", "range").orderBy("order", "row").rowsBetween(Window.unboundedPreceding, -1)
    begun = (
        drawn.join(spans, ["source", "epoch", "range"])
        .withColumn("begins", F.col("epoch") * F.col("total") + F.col("ahead") + F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
        .filter("begins < owed")
    )
    return begun.select(
        "row", "source", "tokens", "epoch",
        F.floor(F.col("begins") / F.col("owed") * blocks).cast("long").alias("block"),
        F.xxhash64(F.lit(seed + 1), F.col("epoch"), F.col("row")).alias("place"),
    )


def narrow_columns(row: Column, text: str = "text", source: str = "source") -> list[Column]:
    """row, source, tokens: words and one end mark, so that an empty text counts too."""
    return [
        row.alias("row"),
        F.coalesce(F.col(quoted(source)).cast("string"), F.lit(NO_SOURCE)).alias("source"),
        (words(F.col(quoted(text))) + 1).alias("tokens"),
    ]


def mix(docs: DataFrame, text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mixture: the documents' columns, once per draw, in no stated order.

    With the default options every document is drawn at least once. Rows without
    a source form one source; null texts count one token. Repeated rows are
    drawn on their own. An empty table gives an empty table.
    """
    table, key = keyed(docs, "mixing")
    numbered = table.select(F.col(key).alias("name"), *narrow_columns(F.monotonically_increasing_id(), text, source))
    narrow = written(numbered, "tokens")
    drawn = draws(narrow.drop("name"), **options).select("row")
    wanted = fresh(table, "drawn")
    named = narrow.join(drawn, "row").select(F.col("name").alias(wanted))
    return table.join(named, F.col(key) == F.col(wanted)).select(*map(quoted, docs.columns))
