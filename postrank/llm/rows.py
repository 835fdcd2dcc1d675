"""Helpers the corpus operators share."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postrank.storage import written

#: What a range should hold, in bytes of text.
TASK_BYTES = 128 << 20
#: White space of the word rule, as a Java pattern.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def fresh(table: DataFrame, name: str) -> str:
    """A column name the table has not, whatever its letter case."""
    taken = {c.lower() for c in table.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def keyed(table: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The table with a column that is unique for each row, and that column's name.

    It stays the same however often and wherever the table is read, so rows that
    are equal in every column can still be told apart. Rows of Parquet files are
    named by file and place in it; any other table is stored with numbered rows.
    """
    name = fresh(table, "row")
    try:
        return table.select("*", F.struct("_metadata.file_path", "_metadata.row_index").alias(name)), name
    except AnalysisException:  # no table of files
        return written(table.withColumn(name, F.monotonically_increasing_id()), label), name


def only(table: DataFrame, key: str, rows: DataFrame, name: str = "name", how: str = "left_semi") -> DataFrame:
    """The rows of a keyed table that ``rows`` names (or, by left_anti, does not)."""
    other = fresh(table, "wanted")
    return table.join(rows.select(F.col(name).alias(other)), F.col(quoted(key)) == F.col(other), how)


def words(text: Column) -> Column:
    """Number of words; null counts as an empty text."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def text_bytes(table: DataFrame, text: str = "text") -> int:
    """Bytes of all texts: one number for the driver."""
    return table.agg(F.sum(F.octet_length(F.col(quoted(text))).cast("long"))).first()[0] or 0


def task_count(table: DataFrame, size: int) -> int:
    """Tasks for so many bytes: no fewer than the session's shuffle partitions."""
    return max(int(table.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(size / TASK_BYTES), 1)
