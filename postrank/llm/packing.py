"""Best-fit packing of documents into sequences of several permitted lengths.

Texts longer than the largest length are cut into pieces of that length and a
rest; nothing is lost. Pieces are dealt by a seeded hash to groups of bounded
size, which are packed independently and in parallel: best-fit decreasing. Each
piece goes to the fullest open bin that holds it; if none does, a bin is opened.
Its size is what the lengths are optimised jointly over: every permitted length
is tried as the opening size of a group (or the smallest that holds the piece),
each trial downsizes its bins at the end to the smallest permitted length that
holds their contents, and the trial of least total cost is taken.

The cost of a bin is its length plus a share that grows with its square, as the
attention over a longer sequence does.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postrank.llm.rows import quoted, words
from postrank.storage import written

LENGTHS = (512, 1024, 2048, 4096, 8192)
#: Length at which the quadratic part of a bin's cost equals the linear one.
EVEN_COST = 16384
#: Pieces of one group.
GROUP_PIECES = 20_000
SEED = 42


def cost(length: int) -> float:
    return length * (1 + length / EVEN_COST)


def _fill(sizes: list[int], lengths: tuple[int, ...], opening: int) -> tuple[list[int], list[int], list[int]]:
    """Bin of each piece, and of each bin its length and contents. ``sizes`` descend.

    ``present`` has bit r set while some open bin has r free places, so the
    fullest bin that fits is the lowest set bit from the piece's size on.
    """
    free: dict[int, list[int]] = {}
    present, where, used, opened = 0, [], [], []
    for size in sizes:
        fitting = present >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            bins = free[room]
            at = bins.pop()
            if not bins:
                present ^= 1 << room
        else:
            room, at = max(opening, lengths[bisect_left(lengths, size)]), len(used)
            used.append(0)
            opened.append(room)
        where.append(at)
        used[at] += size
        left = room - size
        if left:
            free.setdefault(left, []).append(at)
            present |= 1 << left
    return where, [lengths[bisect_left(lengths, n)] for n in used], used


def best_fit(sizes: np.ndarray, lengths: tuple[int, ...] = LENGTHS) -> tuple[np.ndarray, np.ndarray]:
    """Bin of each piece, and the length of each bin; sizes from 1 to the largest length."""
    order = np.argsort(-sizes, kind="stable")
    down = sizes[order].tolist()
    trials = [_fill(down, lengths, opening) for opening in lengths]
    where, bins, _ = min(trials, key=lambda t: sum(map(cost, t[1])))
    out = np.empty(len(sizes), np.int64)
    out[order] = where
    return out, np.array(bins, np.int64)


def pieces(narrow: DataFrame, longest: int) -> DataFrame:
    """row, doc_id, piece, start, size for rows of (row, doc_id, tokens above 0)."""
    cut = F.sequence(F.lit(0), F.ceil(F.col("tokens") / longest).cast("int") - 1)
    return narrow.select("row", "doc_id", "tokens", F.explode(cut).alias("piece")).select(
        "row", "doc_id", "piece",
        (F.col("piece").cast("long") * longest).alias("start"),
        F.least(F.lit(longest), F.col("tokens") - F.col("piece").cast("long") * longest).cast("int").alias("size"),
    )


def pack(narrow: DataFrame, lengths: tuple[int, ...] = LENGTHS, seed: int = SEED) -> DataFrame:
    """bin_group, bin, capacity, position, doc_id, piece, start, size: one row per piece.

    (bin_group, bin) names a sequence of ``capacity`` tokens; ``position`` is where
    the piece stands in it, ``start`` and ``size`` say which tokens of the document
    it holds. ``narrow`` has row (unique), doc_id and tokens (above 0), stored.
    """
    lengths = tuple(sorted(lengths))
    cut = pieces(narrow, lengths[-1])
    groups = max(1, -(-cut.count() // GROUP_PIECES))

    def group(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for all_ in _groups(frames):
            all_ = all_.sort_values(["row", "piece"], kind="stable")
            bins, size = best_fit(all_["size"].to_numpy(), lengths)
            all_ = all_.assign(bin=bins, capacity=size[bins]).sort_values(["bin", "size"], ascending=[True, False], kind="stable")
            all_["position"] = all_.groupby("bin")["size"].cumsum() - all_["size"]
            yield all_[["bin_group", "bin", "capacity", "position", "doc_id", "piece", "start", "size"]]

    kind = narrow.schema["doc_id"].dataType.simpleString()
    dealt = cut.withColumn("bin_group", F.pmod(F.xxhash64(F.lit(seed), "row", "piece"), F.lit(groups)))
    # As text: a null id would turn the ids of a frame into floating-point.
    dealt = dealt.withColumn("doc_id", F.col("doc_id").cast("string"))
    packed = (
        dealt.repartition("bin_group").sortWithinPartitions("bin_group")
        .mapInPandas(group, "bin_group long, bin long, capacity long, position long, doc_id string, piece int, start long, size int")
    )
    return packed.withColumn("doc_id", F.col("doc_id").cast(kind))


def _groups(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The groups of a partition that is sorted by group, one after another."""
    held: list[pd.DataFrame] = []
    for frame in frames:
        for _, part in frame.groupby("bin_group", sort=True):
            if held and held[0]["bin_group"].iat[0] != part["bin_group"].iat[0]:
                yield pd.concat(held)
                held = []
            held.append(part)
    if held:
        yield pd.concat(held)


def pack_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", lengths: tuple[int, ...] = LENGTHS) -> DataFrame:
    """Pack documents by their words and one end mark each; columns as ``pack`` gives them.

    Null texts and texts without a word take one place. Repeated rows are packed
    each on their own; a null doc_id stays null. An empty table gives no rows.
    """
    narrow = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(quoted(doc_id)).alias("doc_id"),
        (words(F.col(quoted(text))) + 1).alias("tokens"),
    )
    return pack(written(narrow, "lengths"), lengths)
