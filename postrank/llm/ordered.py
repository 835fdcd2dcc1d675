"""A table in the order of an id, in ranges of bounded size, one range per task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postrank.llm.rows import quoted, task_count, text_bytes

#: The ends of ranges are a list on the driver and in every task.
MOST_RANGES = 8192


def range_bounds(table: DataFrame, doc_id: str, ranges: int) -> list:
    """Ids that cut the table into ``ranges`` of about as many rows: fewer numbers than ranges."""
    if ranges == 1:
        return []
    shares = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = table.agg(F.percentile_approx(F.col(quoted(doc_id)), shares, F.lit(max(10_000, 20 * ranges)))).first()[0]
    return sorted(set(cuts or []))


def range_of(value: Column, bounds: list, descending: bool) -> Column:
    """Range of an id, numbered in the order wanted; null comes last in either."""
    cuts = np.array(bounds)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        below = np.searchsorted(cuts, ids.to_numpy(), side="left")
        return pd.Series(len(cuts) - below if descending else below).astype("int32")

    # Filled in first: a null would turn the numbers of a batch into floating-point.
    return F.when(value.isNull(), F.lit(len(cuts))).otherwise(place(F.coalesce(value, F.lit(0).cast("long"))))


def ranges_for(table: DataFrame, text: str) -> int:
    """Ranges of about TASK_BYTES, no more than MOST_RANGES: ranges are read through, so
    a very large table has larger ones rather than more of them."""
    return min(task_count(table, text_bytes(table, text)), MOST_RANGES)
