"""Similarity of postings to the one profile, and to many, as table operators."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postrank.functions.vectors import cosine_arrow, cosine_builtin, is_valid_vector


def valid_vectors(df: DataFrame, vector: str, dim: int) -> DataFrame:
    return df.filter(is_valid_vector(F.col(vector), dim))


def profile_vector(
    profiles: DataFrame, vector: str = "ideal_vector", dim: int | None = None
) -> list[float] | None:
    """The vector of the single profile row, or ``None`` for an empty table.

    A vector that is NULL, holds a NULL or has not ``dim`` numbers is an error
    that names the profile, before any posting is read.

    Reads two rows at most. More than one profile is an error: a posting has
    one score.
    """
    name = F.col("profile_id").cast("string") if "profile_id" in profiles.columns else F.lit(None).cast("string")
    rows = profiles.select(F.col(vector).cast("array<double>").alias("v"), name.alias("id")).limit(2).collect()
    if len(rows) > 1:
        raise ValueError("expected one profile, found several")
    if not rows:
        return None
    found, who = rows[0]["v"], f"profile {rows[0]['id']}" if rows[0]["id"] else "the profile"
    if found is None or None in found:
        raise ValueError(f"the vector of {who} is no list of numbers")
    if dim is not None and len(found) != dim:
        raise ValueError(f"the vector of {who} has {len(found)} numbers, not {dim}")
    return list(found)


def add_cosine(
    df: DataFrame, vector: str, profile: list[float] | None, name: str = "cosine", builtin: bool = False
) -> DataFrame:
    """Add the cosine to ``profile``; NULL without a profile or for a zero vector.

    The profile is a constant of the plan: no join and no shuffle. ``df`` must
    hold valid vectors only.
    """
    if profile is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    cosine = cosine_builtin if builtin else cosine_arrow
    return df.withColumn(name, cosine(F.col(vector), profile))


def cosine_by_position(df: DataFrame, key: str, vector: str, profile: list[float], name: str = "cosine") -> DataFrame:
    """The relational form: one row per vector position, then sums per key.

    The sums of one row are combined in the task that exploded it, so the
    shuffle carries one row per key, not one per position.
    """
    ideal = F.array(*[F.lit(float(x)) for x in profile])
    positions = df.select(key, F.posexplode(vector).alias("i", "a")).withColumn("a", F.col("a").cast("double"))
    products = positions.withColumn("b", F.get(ideal, F.col("i")))
    sums = products.groupBy(key).agg(
        F.sum(F.col("a") * F.col("b")).alias("dot"),
        F.sum(F.col("a") * F.col("a")).alias("aa"),
        F.sum(F.col("b") * F.col("b")).alias("bb"),
    )
    return sums.select(key, F.try_divide("dot", F.sqrt("aa") * F.sqrt("bb")).alias(name))


#: Bytes of vectors in one block, as single-precision numbers, and products made at once.
BLOCK_BYTES, PRODUCTS = 32 << 20, 4 << 20
#: Decimals of a cosine that order matches; ties go by id.
DECIMALS = 9


def _block_best(profiles: pd.DataFrame, postings: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k best postings of a block for every profile of a block."""
    empty = pd.DataFrame({"profile_id": [], "posting_id": [], "cosine": []})
    if not len(profiles) or not len(postings):
        return empty
    ids = postings["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    ids, them = ids[order], np.stack(postings["v"].to_numpy()).astype(np.float64)[order]
    them /= np.linalg.norm(them, axis=1, keepdims=True)
    found, step = [], max(1, PRODUCTS // len(them))
    for at in range(0, len(profiles), step):
        part = profiles.iloc[at : at + step]
        us = np.stack(part["v"].to_numpy()).astype(np.float64)
        us /= np.linalg.norm(us, axis=1, keepdims=True)
        cosine = np.round(us @ them.T, DECIMALS)
        if k < len(ids):
            least = np.partition(cosine, len(ids) - k, axis=1)[:, len(ids) - k]
        else:
            least = np.full(len(part), -np.inf)
        for name, row, bound in zip(part["id"].to_numpy(), cosine, least):
            near = np.flatnonzero(row >= bound)  # ties at the end included, by ascending id
            near = near[np.argsort(-row[near], kind="stable")][:k]
            found.append(pd.DataFrame({"profile_id": name, "posting_id": ids[near], "cosine": row[near]}))
    return pd.concat(found, ignore_index=True)


def best_for_profiles(
    postings: DataFrame, profiles: DataFrame, k: int, dim: int, posting_id: str = "posting_id", posting_vector: str = "vector",
    profile_id: str = "profile_id", profile_vector: str = "ideal_vector",
) -> DataFrame:
    """(profile_id, rank, posting_id, cosine): the ``k`` most similar postings of every profile.

    Both sides lie in blocks of at most BLOCK_BYTES by a hash of their id. Every posting
    block meets every profile block in one task, as a matrix product that keeps k rows a
    profile; those partial lists are merged. No pair of rows is ever shuffled, and no
    table passes through the driver, of which only counts are asked. Ids are numbers,
    unique on each side. Vectors that are NULL, of another length or zero are left out.
    """
    def blocked(table: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
        square = F.aggregate(F.col("v"), F.lit(0.0), lambda s, x: s + x * x)
        rows = valid_vectors(table, vector, dim).select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v"))
        rows = rows.filter(square > 0).select("id", F.col("v").cast("array<float>").alias("v"))
        blocks = max(1, math.ceil(rows.count() * dim * 4 / BLOCK_BYTES))
        return rows.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")), blocks

    ours, n_ours = blocked(profiles, profile_id, profile_vector)
    theirs, n_theirs = blocked(postings, posting_id, posting_vector)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = ours.select("id", "v", F.col("block").alias("p"), every(n_theirs).alias("q"))
    right = theirs.select("id", "v", F.col("block").alias("q"), every(n_ours).alias("p"))
    kind = dict(ours.dtypes)["id"], dict(theirs.dtypes)["id"]
    parts = left.groupBy("p", "q").cogroup(right.groupBy("p", "q")).applyInPandas(
        lambda a, b: _block_best(a, b, k), f"profile_id {kind[0]}, posting_id {kind[1]}, cosine double"
    )
    place = F.row_number().over(Window.partitionBy("profile_id").orderBy(F.desc("cosine"), F.asc("posting_id")))
    return parts.withColumn("rank", place).filter(F.col("rank") <= k).select("profile_id", "rank", "posting_id", "cosine")
