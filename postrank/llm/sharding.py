"""Sharding by a two-pass external shuffle.

First pass: every record goes to a bucket by a seeded hash of its row's name, so
buckets are alike and hold what a task's memory holds, whatever ids, sources or
texts repeat. Second pass: each bucket is read whole, permuted by Fisher-Yates
with a generator seeded by the bucket, and written.

Buckets laid end to end are one random permutation of all records; shard s of n
gets its s-th part. Row counts of the buckets are known before the second pass
(one number per bucket), so each record learns its shard and its slot there
while its bucket is written. The law is ``rows``: shards differ by one row at most.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postrank.llm.rows import fresh, keyed, text_bytes
from postrank.storage import scratch_dir

SEED = 42
SHARDS = 16
#: Bytes of text in one bucket, at most on average; no fewer buckets than shuffle partitions.
BUCKET_BYTES = 64 << 20
#: And rows, where texts are short.
BUCKET_ROWS = 100_000


def fisher_yates(n: int, seed: tuple[int, ...]) -> np.ndarray:
    """A permutation of 0 to n - 1, every one as likely.

    NumPy's ``shuffle`` swaps each place, from the last, with a random one not after it.
    """
    order = np.arange(n)
    np.random.Generator(np.random.PCG64(seed)).shuffle(order)
    return order


def shard_starts(rows: int, shards: int) -> np.ndarray:
    """First rank of each shard, and the number of rows at the end."""
    return np.array([-(-s * rows // shards) for s in range(shards + 1)], np.int64)


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS, text: str = "text", seed: int = SEED) -> DataFrame:
    """Write the documents shuffled, as ``<folder>/shard=<n>``, and read them back.

    The columns of ``docs`` and two more: ``slot`` (place within the shard, from
    0 without gaps) and ``shard``, under other names if these are taken. Any
    value may be null or repeated. Fewer rows than shards leave shards empty; an
    empty table gives an empty table.
    """
    stored, row = keyed(docs, "scatter")
    spark = stored.sparkSession
    rows = stored.count()
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    buckets = max(tasks, math.ceil(text_bytes(stored, text) / BUCKET_BYTES), math.ceil(rows / BUCKET_ROWS))
    bucket, shard, slot = fresh(stored, "bucket"), fresh(stored, "shard"), fresh(stored, "slot")
    scattered = stored.withColumn(bucket, F.pmod(F.xxhash64(F.lit(seed), F.col(row)), F.lit(buckets)).cast("int"))
    counts = dict(scattered.groupBy(bucket).count().collect())
    ahead = np.concatenate([[0], np.cumsum([counts.get(b, 0) for b in range(buckets)], dtype=np.int64)])
    starts = shard_starts(rows, shards)

    def permute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _buckets(batches, bucket):
            number = whole.column(bucket)[0].as_py()
            order = fisher_yates(whole.num_rows, (seed, number))
            rank = ahead[number] + np.arange(whole.num_rows)
            at = np.searchsorted(starts, rank, side="right") - 1
            whole = whole.take(pa.array(order)).drop_columns([bucket])
            whole = whole.append_column(slot, pa.array(rank - starts[at])).append_column(shard, pa.array(at.astype(np.int32)))
            yield from whole.combine_chunks().to_batches(max_chunksize=10_000)

    schema = T.StructType([*docs.schema.fields, T.StructField(slot, T.LongType()), T.StructField(shard, T.IntegerType())])
    (
        scattered.repartitionById(buckets, bucket)
        .sortWithinPartitions(bucket, row)  # records arrive in any order; so they are the same each time
        .drop(row)
        .mapInArrow(permute, schema)
        .sortWithinPartitions(shard, slot)
        .write.option("compression", "zstd").partitionBy(shard).parquet(folder)
    )
    return spark.read.schema(schema).parquet(folder)


def _buckets(batches: Iterator[pa.RecordBatch], bucket: str) -> Iterator[pa.Table]:
    """The buckets of a partition that is sorted by bucket, one after another."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        at = batch.column(bucket).to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(at)]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                if held and held[0].column(bucket)[0].as_py() != at[a]:
                    yield pa.Table.from_batches(held)
                    held = []
                held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def shuffled_shards(docs: DataFrame, shards: int = SHARDS, text: str = "text") -> tuple[DataFrame, str, str]:
    """Write to a scratch folder; the table read back, and its shard and slot columns."""
    table = write_shards(docs, scratch_dir(docs.sparkSession, "shards"), shards, text)
    return table, table.columns[-1], table.columns[-2]
