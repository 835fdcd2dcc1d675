"""Winners kept up to date: batch after batch is one dedupe of everything."""

import glob
import os
import random

import pytest

from postrank.operators.dedupe import dedupe_by_id, dedupe_by_url
from postrank.operators.incremental import BUCKET, by_fingerprint, by_id, by_url, merge_batch, read_winners

COLUMNS = ("job_id", "source_name", "title", "company_name", "location_clean", "description", "url", "published_at", "ingestion_date")
SCHEMA = ", ".join(f"{c} {'timestamp' if c == 'published_at' else 'date' if c == 'ingestion_date' else 'string'}" for c in COLUMNS)


def postings(seed, count):
    from datetime import date, datetime

    r = random.Random(seed)
    return [
        (
            r.choice([None, *map(str, range(count // 4))]), r.choice(["Jooble", "Adzuna", None]), r.choice(["A", "B", "C", None]),
            r.choice(["x", "y", None]), r.choice(["Nantes", None]), f"d{r.randrange(6)}",
            r.choice([None, *(f"u{i}" for i in range(count // 5))]), r.choice([None, *(datetime(2025, 1, d) for d in (1, 2, 3))]), date(2025, 1, 31),
        )
        for _ in range(count)
    ]


@pytest.fixture
def frame(spark):
    return lambda rows: spark.createDataFrame(rows, SCHEMA)


def plain(rows):
    return sorted((tuple(r) for r in rows), key=str)


def whole(rows, rule):
    """One pass over everything in plain Python."""
    groups, out = {}, []
    for r in rows:
        p = dict(zip(COLUMNS, r))
        key = {
            "id": None if p["job_id"] is None else (p["job_id"], p["source_name"]),
            "url": p["url"] or p["job_id"],
            "fingerprint": None if not (p["title"] or p["company_name"] or p["location_clean"]) else "||".join(
                p[c].lower() for c in ("title", "company_name", "location_clean") if p[c] is not None),
        }[rule]
        out.append(r) if key is None else groups.setdefault(key, []).append(p)
    return out, groups


RULES = {"id": by_id, "url": by_url, "fingerprint": by_fingerprint}


@pytest.mark.parametrize("rule", list(RULES))
@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 1, 0, 2)])
def test_batches_equal_one_run(spark, frame, tmp_path, rule, order):
    parts = [postings(1, 60), postings(2, 40), [], postings(3, 60)]
    keyed = [r for r in parts[0] if r[0] and r[6] and r[2]]
    parts[1] = parts[1] + keyed[:20]  # repeated rows
    one, many = f"{tmp_path}/one", f"{tmp_path}/many"
    for i in order:
        merge_batch(frame(parts[i]), many, RULES[rule](), 8)
    together = [r for p in parts for r in p]
    merge_batch(frame(together), one, RULES[rule](), 8)
    got = plain(read_winners(spark, many).collect())
    assert got == plain(read_winners(spark, one).collect())
    assert read_winners(spark, many).columns == list(COLUMNS)
    keyless, groups = whole(together, rule)
    assert len(got) == len(keyless) + len(groups)
    left = list(got)
    for r in keyless:
        left.remove(tuple(r))
    for group in groups.values():
        newest = max((p["published_at"] for p in group if p["published_at"]), default=None)
        assert any(tuple(p.values()) in left and p["published_at"] == newest for p in group)


def test_equals_the_dedupe_of_a_table(spark, frame, tmp_path):
    rows = frame(postings(5, 120))
    for name, rule, dedupe in (("id", by_id, dedupe_by_id), ("url", by_url, dedupe_by_url)):
        merge_batch(rows, f"{tmp_path}/{name}", rule(), 8)
        full = dedupe(rows)
        columns = ["job_id", "source_name", "url", "published_at"] if name == "id" else ["url", "published_at", "source_name"]
        assert plain(read_winners(spark, f"{tmp_path}/{name}").select(columns).collect()) == plain(full.select(columns).collect())


def test_only_touched_buckets_are_written(spark, frame, tmp_path):
    path = f"{tmp_path}/winners"
    merge_batch(frame(postings(6, 200)), path, by_id(), 16)
    before = {p: sorted(os.listdir(p)) for p in glob.glob(f"{path}/{BUCKET}=*")}
    one = [r for r in postings(7, 200) if r[0]][:1]
    touched = merge_batch(frame(one), path, by_id(), 16)
    after = {p: sorted(os.listdir(p)) for p in glob.glob(f"{path}/{BUCKET}=*")}
    assert len(touched) == 1 and len(before) > 10
    assert {p for p in after if after[p] != before.get(p)} == {f"{path}/{BUCKET}={touched[0]}"}


def test_repeated_merge_changes_nothing(spark, frame, tmp_path):
    path, rows = f"{tmp_path}/w", [r for r in postings(8, 80) if r[0]]
    merge_batch(frame(rows), path, by_id(), 8)
    before = plain(read_winners(spark, path).collect())
    merge_batch(frame(rows), path, by_id(), 8)
    assert plain(read_winners(spark, path).collect()) == before


def test_buckets_are_fixed_and_empty_batches_write_nothing(spark, frame, tmp_path):
    path = f"{tmp_path}/w"
    assert merge_batch(frame([]), path, by_id(), 8) == [] and not os.path.exists(path)
    merge_batch(frame(postings(9, 20)), path, by_id(), 8)
    with pytest.raises(ValueError, match="has 8 buckets, not 9"):
        merge_batch(frame(postings(9, 20)), path, by_id(), 9)


def test_a_hot_key_is_one_row_a_task_before_the_shuffle(spark, frame, tmp_path):
    from postrank.operators.incremental import _keyed, _winners

    path = f"{tmp_path}/rows"
    _keyed(frame(postings(10, 50)), by_id(), 8).write.parquet(path)
    plan = _winners(spark.read.parquet(path), by_id())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_winners_are_written_once(spark, frame, tmp_path, monkeypatch):
    """Only the batch is copied to scratch; stored rows are read in place and the winners go to the table."""
    from postrank.operators import incremental

    labels, store = [], incremental.written
    monkeypatch.setattr(incremental, "written", lambda table, label: labels.append(label) or store(table, label))
    path, rows = f"{tmp_path}/w", postings(10, 80)
    merge_batch(frame(rows[:40]), path, by_id(), 8)
    merge_batch(frame(rows[40:]), path, by_id(), 8)
    assert labels == ["batch", "batch"]
    out, groups = whole(rows, "id")
    assert read_winners(spark, path).count() == len(out) + len(groups)
