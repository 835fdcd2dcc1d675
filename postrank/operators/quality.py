"""Data checks. A report has one row per check: check, column, severity, failing."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postrank.config import SOURCE_NAMES

ERROR, WARN = "error", "warn"

# --- Fixed values: columns each table must fill, with severity ---
SILVER_NOT_NULL = {
    "job_id": ERROR, "published_at": ERROR, "title": WARN, "company_name": WARN, "url": WARN,
}
STAGING_NOT_NULL = {
    "job_id": ERROR, "title": WARN, "company_name": WARN, "url": WARN, "description": WARN,
    "published_at": ERROR, "ingestion_date": ERROR,
}
GOLD_NOT_NULL = {
    "job_id": ERROR, "matching_score": ERROR, "title": WARN, "url": WARN, "published_at": ERROR,
    "data_quality_score": ERROR, "ingestion_date": ERROR,
}
RANKING_NOT_NULL = {
    "title": WARN, "company_name": WARN, "matching_score": ERROR, "published_at": ERROR,
    "ingestion_date": ERROR,
}
# --- Fixed values: closed ranges of the scored table ---
SCORE_RANGES = {
    "matching_score": (0, 100), "rules_score": (0, 100), "semantic_score": (0, 100),
    "data_quality_score": (0, 1),
}


class Check(NamedTuple):
    """A row-level check: rows where ``failing`` is true fail it."""

    check: str
    column: str
    severity: str
    failing: Column


def not_null(columns: dict[str, str]) -> list[Check]:
    return [Check("not_null", c, level, F.col(c).isNull()) for c, level in columns.items()]


def accepted_values(column: str, values=SOURCE_NAMES, severity: str = ERROR) -> list[Check]:
    """Values outside the list fail; NULL passes."""
    return [Check("accepted_values", column, severity, ~F.col(column).isin(*values))]


def ranges(bounds: dict[str, tuple[float, float]], severity: str = ERROR) -> list[Check]:
    """Values outside their closed range fail; NULL passes."""
    return [
        Check("range", c, severity, ~F.col(c).between(low, high)) for c, (low, high) in bounds.items()
    ]


def not_blank(column: str, severity: str = WARN) -> list[Check]:
    blank = F.col(column).isNull() | (F.trim(column) == "")
    return [Check("not_blank", column, severity, blank)]


def run_checks(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Count the failing rows of all checks in one pass over ``df``."""
    counts = df.agg(*[F.count_if(c.failing).alias(f"n{i}") for i, c in enumerate(checks)])
    rows = [
        F.struct(
            F.lit(c.check).alias("check"), F.lit(c.column).alias("column"),
            F.lit(c.severity).alias("severity"), F.col(f"n{i}").alias("failing"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def duplicates(df: DataFrame, *keys: str) -> DataFrame:
    """Keys held by more than one row, with the number of rows. NULL keys pass."""
    filled = df.dropna(subset=list(keys))
    return filled.groupBy(*keys).agg(F.count("*").alias("rows")).filter(F.col("rows") > 1)


def unique(df: DataFrame, key: str, severity: str = ERROR) -> DataFrame:
    """One report row: the number of keys held more than once."""
    return run_checks(duplicates(df, key), [Check("unique", key, severity, F.col("rows") > 1)])


def gold_checks() -> list[Check]:
    return not_null(GOLD_NOT_NULL) + accepted_values("source_name") + ranges(SCORE_RANGES) + not_blank("url")


def silver_checks() -> list[Check]:
    return not_null(SILVER_NOT_NULL) + accepted_values("source_name")


def gold_report(gold: DataFrame) -> DataFrame:
    """All checks of the scored table."""
    return run_checks(gold, gold_checks()).unionByName(unique(gold, "job_id"))


def silver_report(silver: DataFrame) -> DataFrame:
    return run_checks(silver, silver_checks()).unionByName(unique(silver, "job_id"))


def staging_report(staging: DataFrame) -> DataFrame:
    checks = not_null(STAGING_NOT_NULL) + accepted_values("source_name")
    return run_checks(staging, checks).unionByName(unique(staging, "job_id"))


def ranking_report(ranked: DataFrame) -> DataFrame:
    return run_checks(ranked, not_null(RANKING_NOT_NULL) + accepted_values("platform"))


def enforce(report: DataFrame) -> list[str]:
    """Raise if an error-level check fails; return the failing warnings.

    Collects one row per failing check, never data rows.
    """
    failing = report.filter(F.col("failing") > 0).collect()
    messages: dict[str, list[str]] = {ERROR: [], WARN: []}
    for row in failing:
        messages[row["severity"]].append(f"{row['check']}({row['column']}): {row['failing']}")
    if messages[ERROR]:
        raise ValueError("data checks failed: " + "; ".join(messages[ERROR]))
    return messages[WARN]


def with_failures(df: DataFrame, checks: list[Check], unique_keys: dict[str, str] | None = None,
                  failed: str = "failed", errors: str = "errors") -> DataFrame:
    """Every row with the checks it fails, as ``check(column)``, and those of error level.

    One pass over the rows. A key held by several rows fails in all of them: such keys
    come from an aggregate of the key column alone and are joined on, so whole rows are
    shuffled only where that table is too large to be sent to them. NULL keys pass.
    ``unique_keys`` maps columns to severities.
    """
    marks = [(f"{c.check}({c.column})", c.severity, c.failing) for c in checks]
    for i, (key, severity) in enumerate((unique_keys or {}).items()):
        mark = f"_repeated{i}"
        held = duplicates(df.select(key), key).select(F.col(key), F.lit(True).alias(mark))
        df = df.join(held, key, "left").select(*df.columns, mark)
        marks.append((f"unique({key})", severity, F.col(mark)))

    def names(level: str | None) -> Column:
        hit = [F.when(failing, F.lit(name)) for name, severity, failing in marks if level in (None, severity)]
        return F.array_compact(F.array(*hit)) if hit else F.array().cast("array<string>")

    found = df.withColumns({failed: names(None), errors: names(ERROR)})
    return found.drop(*[f"_repeated{i}" for i in range(len(unique_keys or {}))])


def failing_rows(df: DataFrame, checks: list[Check], unique_keys: dict[str, str] | None = None) -> DataFrame:
    """The rows that fail some check, with ``failed`` and ``errors``."""
    return with_failures(df, checks, unique_keys).filter(F.size("failed") > 0)


def split_rows(marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without an error (as they were), and the others with what they fail.

    ``marked`` as ``with_failures`` gives it, stored: it is read twice.
    """
    return marked.filter(F.size("errors") == 0).drop("failed", "errors"), marked.filter(F.size("errors") > 0)
