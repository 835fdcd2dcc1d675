"""Run the whole job: spark-submit or python -m postrank --bronze DIR ..."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from postrank.config import RankingConfig
from postrank.operators.ranking import DEFAULT_ROWS, top_n
from postrank.plans.runs import Paths, run
from postrank.sources.profile import read_profiles


def parse(arguments: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="postrank", description="Clean, score and rank stored postings.")
    for name in (*Paths._fields, "profiles", "as-of"):
        parser.add_argument(f"--{name}", required=True)
    parser.add_argument("--lines", action="store_true", help="payloads are one JSON object per line")
    parser.add_argument("--layout", default="{folder}", help="folder of a source below --bronze")
    parser.add_argument("--dim", type=int, default=384, help="length of the vectors")
    parser.add_argument("--limit", type=int, default=DEFAULT_ROWS, help="best postings to show")
    return parser.parse_args(arguments)


def main(arguments: list[str] | None = None) -> None:
    given = parse(arguments)
    spark = SparkSession.builder.appName("postrank").getOrCreate()
    cfg = RankingConfig(as_of=given.as_of, vector_dim=given.dim)
    paths = Paths(given.bronze, given.silver, given.gold, given.log)
    result = run(
        spark, cfg, paths, read_profiles(spark, given.profiles), None, not given.lines, given.layout
    )
    print(f"{result.postings} postings from {result.per_source}")
    for source, problem, payloads in result.rejected:
        print(f"rejected: {payloads} of {source}, {problem}")
    for warning in result.warnings:
        print("warning:", warning)
    best = top_n(result.ranking, given.limit)
    best.select("matching_score", "title", "company_name", "city", "original_url").show(given.limit, truncate=False)


if __name__ == "__main__":
    main()
