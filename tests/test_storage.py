"""Scratch tables: stored, read again, deleted."""

import os

from postrank.storage import free, remove, written


def test_a_stored_table_goes_when_it_is_freed(spark, tmp_path):
    table = written(spark.range(5), "five")
    path = table.stored_at
    assert os.path.isdir(path) and table.count() == 5
    kept = written(table.filter("id > 2"), "kept")
    free(table, spark.range(3))  # a table that was never stored is left alone
    assert not os.path.exists(path) and [r.id for r in kept.collect()] == [3, 4]
    free(table)  # once is enough
    free(kept)


def test_remove_is_silent_about_what_is_not_there(spark, tmp_path):
    remove(spark, f"{tmp_path}/none")
    (tmp_path / "some").mkdir()
    remove(spark, f"{tmp_path}/some")
    assert not (tmp_path / "some").exists()
