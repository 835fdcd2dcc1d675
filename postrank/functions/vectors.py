"""Cosine similarity between a stored vector and one profile vector."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def is_valid_vector(vector: Column, dim: int) -> Column:
    return vector.isNotNull() & (F.size(vector) == dim)


def cosine_builtin(vector: Column, profile: list[float]) -> Column:
    """Cosine by higher-order functions, without leaving the JVM.

    Lambdas are interpreted per element, so this form is several times slower
    than :func:`cosine_arrow` on long vectors. NULL for a zero vector.
    """
    ideal = F.array(*[F.lit(float(x)) for x in profile])
    values = vector.cast("array<double>")
    zero = F.lit(0.0)
    dot = F.aggregate(F.zip_with(values, ideal, lambda x, y: x * y), zero, lambda acc, x: acc + x)
    squares = F.aggregate(values, zero, lambda acc, x: acc + x * x)
    return F.try_divide(dot, F.sqrt(squares) * _norm(profile))


def cosine_arrow(vector: Column, profile: list[float]) -> Column:
    """Cosine as one matrix product per Arrow batch. NULL for a zero vector.

    Every non-NULL vector must have the length of ``profile``; filter with
    :func:`is_valid_vector` first.
    """
    norm = _norm(profile)
    weights = [float(x) for x in profile]

    def product(batch: pa.Array) -> pa.Array:
        ideal = np.asarray(weights)
        present = batch.is_valid().to_numpy(zero_copy_only=False)
        rows = batch.drop_null().flatten().to_numpy(zero_copy_only=False)
        rows = rows.reshape(-1, len(ideal)).astype("float64")
        length = np.sqrt((rows * rows).sum(axis=1)) * norm
        cosine = np.full(len(batch), np.nan)
        usable = length > 0
        found = np.full(len(rows), np.nan)
        found[usable] = (rows[usable] * ideal).sum(axis=1) / length[usable]
        cosine[present] = found
        return pa.array(cosine, type=pa.float64(), from_pandas=True)

    return F.arrow_udf(product, "double")(vector)


def _norm(profile) -> float:
    return math.sqrt(sum(float(x) ** 2 for x in profile))
