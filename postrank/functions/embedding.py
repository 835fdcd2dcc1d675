"""Text embedding: hashed word counts by default, or any model you load."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"[\p{L}\p{N}]+"


def word_hashes(text: Column) -> Column:
    """The CRC-32 of every word of ``text``, computed in the JVM."""
    words = F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
    return F.transform(words, F.crc32)


def embed_hashed(text: Column, dim: int) -> Column:
    """Signed word counts in ``dim`` buckets, scaled to length 1.

    The lowest bit of a word's hash is its sign, the rest picks its bucket.
    Deterministic, needs no model; a text without words gives a zero vector.
    """

    def scatter(hashes: pa.Array) -> pa.Array:
        return _scatter(hashes, dim)

    return F.arrow_udf(scatter, "array<float>")(word_hashes(text))


CHUNK = 1 << 20


def _scatter(hashes: pa.Array, dim: int, chunk: int = CHUNK) -> pa.Array:
    """Unit vectors of signed word counts of a batch of hash lists.

    The words are counted ``chunk`` at a time, so Python holds a few numbers a
    word of one chunk, not of the whole batch, however long its texts are.
    """
    lengths = hashes.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    values = hashes.flatten()
    counts = np.zeros(len(hashes) * dim)
    for start in range(0, len(values), chunk):
        part = values.slice(start, chunk).to_numpy(zero_copy_only=False).astype("int64")
        row = np.searchsorted(ends, np.arange(start, start + len(part)), side="right")
        cell = row * dim + (part >> 1) % dim
        counts += np.bincount(cell, weights=1.0 - 2.0 * (part & 1), minlength=len(counts))
    counts = counts.reshape(len(hashes), dim)
    norm = np.sqrt((counts * counts).sum(axis=1, keepdims=True))
    unit = np.divide(counts, norm, out=np.zeros_like(counts), where=norm > 0)
    offsets = np.arange(0, (len(hashes) + 1) * dim, dim, dtype="int32")
    flat = pa.array(unit.astype("float32").ravel())
    return pa.ListArray.from_arrays(pa.array(offsets), flat)


def embed_with(load_model: Callable[[], Callable[[list[str]], object]]) -> Callable[[Column], Column]:
    """Embed by a model: ``load_model()`` returns ``texts -> rows of numbers``.

    The model is loaded once per Python task, then fed batch after batch. Batch
    size is ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = load_model()
        for texts in batches:
            rows = encode(texts.fillna("").tolist())
            yield pd.Series([[float(x) for x in row] for row in rows], index=texts.index)

    return vectors
