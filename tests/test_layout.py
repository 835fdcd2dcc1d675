"""Gold in order of the score: what a reader with a threshold leaves unread."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from postrank.operators.ranking import least_score, ranking, ranking_view, stored_top_n, top_n
from postrank.sources.tables import read_scores, write_gold


@pytest.fixture
def gold(spark):
    """4000 scored postings in no order; a third share one score, some have none."""
    n = F.col("id")
    score = F.when(n % 3 == 0, 50.0).when(n % 100 == 1, None).otherwise((n * 7919 % 101).cast("double"))
    return spark.range(4000).repartition(3).select(
        F.concat(F.lit("t"), n % 50).alias("title"), F.lit("c").alias("company_name"), F.lit("x").alias("job_location"),
        F.lit(1).alias("salary_min_numeric"), F.array(F.lit("python")).alias("extracted_skills"),
        F.repeat(F.concat(F.lit("d"), n), 20).alias("description"),
        F.to_timestamp(F.date_add(F.lit("2025-01-01"), (n % 28).cast("int"))).alias("published_at"), score.alias("matching_score"),
        F.lit(1.0).alias("semantic_score"), F.lit(1.0).alias("rules_score"), F.lit("").alias("positive_labels"),
        F.lit("").alias("negative_labels"), F.concat(F.lit("u"), n).alias("url"), F.lit("Jooble").alias("source_name"),
        F.lit("2025-01-31").cast("date").alias("ingestion_date"),
    )


def rows_scanned(df):
    """Rows that scans gave, after row groups were left out and before any filter."""
    found = []

    def visit(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return visit(plan.executedPlan())
        if name.endswith("QueryStageExec"):
            return visit(plan.plan())
        if name == "FileSourceScanExec":
            found.append(plan.metrics().get("numOutputRows").get().value())
        for i in range(plan.children().size()):
            visit(plan.children().apply(i))

    query = df._jdf.queryExecution()
    query.executedPlan().executeCollect()
    visit(query.executedPlan())
    assert found
    return sum(found)


def row_groups(path):
    """(rows, least, greatest score) of every row group."""
    out = []
    for name in sorted(glob.glob(f"{path}/*.parquet")):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.names.index("matching_score")
        for i in range(meta.num_row_groups):
            stats = meta.row_group(i).column(at - (len(meta.schema.names) - meta.num_columns)).statistics
            out.append((meta.row_group(i).num_rows, stats.min if stats.has_min_max else None, stats.max if stats.has_min_max else None))
    return out


@pytest.fixture
def stored(spark, gold, tmp_path):
    path = f"{tmp_path}/gold"
    write_gold(gold, path, files=8)
    return path


def test_files_follow_one_another_from_best_to_worst(spark, gold, stored):
    groups = row_groups(stored)
    assert len(groups) == 8 and sum(g[0] for g in groups) == 4000
    held = [g for g in groups if g[1] is not None]
    assert all(a[1] >= b[2] for a, b in zip(held, held[1:]))
    assert max(g[0] for g in groups) < 1000  # the score of a third of all rows is in several files
    back = spark.read.parquet(stored)
    assert back.columns == gold.columns and back.exceptAll(gold).count() == 0 and gold.exceptAll(back).count() == 0


def test_scores_are_counted_beside_the_files(spark, gold, stored):
    want = {r[0]: r[1] for r in gold.groupBy("matching_score").count().collect()}
    assert {r[0]: r[1] for r in read_scores(spark, stored).collect()} == want


@pytest.mark.parametrize("limit", [0, 1, 50, 500, 3000, 10_000])
def test_top_n_reads_only_the_best_row_groups(spark, gold, stored, cfg, limit):
    table, scores = spark.read.parquet(stored), read_scores(spark, stored)
    top = stored_top_n(table, scores, cfg, limit)
    want = top_n(ranking(gold, cfg), limit)
    assert top.collect() == want.collect()
    least = max(cfg.relevance_threshold, least_score(scores, limit) or 0)
    fit = sum(n for n, _, most in row_groups(stored) if most is not None and most >= least)
    if limit:
        assert rows_scanned(top) <= fit
    if limit <= 500:
        assert fit < 4000


def test_ranking_leaves_row_groups_unread(spark, gold, stored, cfg):
    table = spark.read.parquet(stored)
    fit = sum(n for n, _, most in row_groups(stored) if most is not None and most >= cfg.relevance_threshold)
    assert rows_scanned(ranking(table, cfg)) == fit < 4000
    assert ranking_view(table, cfg).collect() == ranking_view(gold, cfg).collect()


def test_arrival_order_leaves_nothing_unread(spark, gold, cfg, tmp_path):
    gold.write.parquet(f"{tmp_path}/plain")
    assert rows_scanned(ranking(spark.read.parquet(f"{tmp_path}/plain"), cfg)) == 4000


def test_empty_gold(spark, gold, cfg, tmp_path):
    path = f"{tmp_path}/none"
    write_gold(gold.limit(0), path)
    table = spark.read.schema(gold.schema).parquet(path)
    assert stored_top_n(table, read_scores(spark, path), cfg, 5).collect() == []
