"""Document fingerprints: threshold-scaled sketches of shingle hashes.

A sketch keeps every distinct shingle hash below ``FRACTION`` of the hash range,
so its size follows the document, and sketches of very unequal documents can be
compared: the share of one sketch found in another estimates how much of the
document is contained in the other. The sketch of two documents together is the
union of their sketches (``merged``).

A document too short to have a hash below the threshold keeps its smallest one,
so that it can be compared at all; ``merged`` drops such a hash again once a
hash below the threshold joins it, so merging stays exact.

A shingle is five words (``[^\\x20\\x09-\\x0D]+``, A-Z lower-cased) joined by
spaces; a text of fewer words is one shingle; a text without words has an empty
sketch. Two empty sketches have likeness 1, an empty and another 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postrank.llm.ordered import range_bounds, range_of, ranges_for
from postrank.llm.rows import quoted
from postrank.llm.simhash import shingle_hashes

SHINGLE = 5
FRACTION = 1 / 8
LIMIT = np.uint64(int(FRACTION * (1 << 64)))


def _kept(hashes: np.ndarray) -> np.ndarray:
    below = hashes[hashes < LIMIT]
    return below if len(below) else hashes[:1]


def sketch(text: str | None) -> np.ndarray:
    """Sorted hashes of a text's sketch."""
    hashes = shingle_hashes(text, SHINGLE)
    below = hashes[hashes < LIMIT]
    return np.unique(below) if len(below) else hashes[hashes.argmin()][None] if len(hashes) else hashes


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two documents together."""
    return _kept(np.union1d(a, b))


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated Jaccard similarity."""
    both = _common(a, b)
    whole = len(a) + len(b) - both
    return both / whole if whole else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of the first document's shingles found in the second."""
    return _common(a, b) / len(a) if len(a) else 1.0


def to_text(a: np.ndarray) -> str:
    """The sketch as text: 16 hexadecimal digits a hash."""
    return a.astype(">u8").tobytes().hex()


def from_text(text: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(text), ">u8").astype(np.uint64)


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with their sketches, as the last column ``fingerprint``."""

    @F.pandas_udf("string")
    def sketches(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: to_text(sketch(t)), na_action=None)

    return docs.select("*", sketches(F.col(quoted(text))).alias("fingerprint"))


def edited(own: str, following: str) -> str:
    """The text with its last third replaced by the beginning of the next document."""
    cut = len(own) // 3
    return own[: len(own) - cut] + following[:cut]


RESULT = (
    "doc_id {kind}, n_chars long, edited_text string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, in_edited double, in_next double"
)


def compare_neighbours(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Each document beside its edited text and the next document, by descending doc_id.

    Columns as in RESULT. The document after the last is the first. Documents of
    one doc_id follow each other by a hash of their text; a null doc_id comes
    last; a null text is empty. A single document follows itself. An empty table
    gives no rows.

    The texts are dealt once, to ranges of ids that are sorted and read through;
    the first document of each range is also sent to the end of the range before
    it, so no range needs another. The driver sees one id per range.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    rows = docs.select(
        F.col(quoted(doc_id)).alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text")
    )
    ranges = ranges_for(rows, "text")
    bounds = range_bounds(rows, "doc_id", ranges)
    rows = rows.select(
        "doc_id", "text", F.xxhash64("text").alias("tie"), range_of(F.col("doc_id"), bounds, descending=True).alias("range")
    )
    heads = sorted(
        tuple(r) for r in rows.groupBy("range").agg(F.max(F.struct("doc_id", "tie")).alias("head"))
        .select("range", "head.doc_id", "head.tie").collect()
    )
    if not heads:
        return docs.sparkSession.createDataFrame([], RESULT.format(kind=kind))
    sent_to = [heads[i - 1][0] for i in range(len(heads))]
    ends = docs.sparkSession.createDataFrame(
        [(h[1], h[2], to) for h, to in zip(heads, sent_to)], f"head_id {kind}, head_tie long, target int"
    )
    # One row per range: as bounded as the number of tasks.
    halo = (
        rows.join(F.broadcast(ends), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie")))
        .dropDuplicates(["target"])
        .select("doc_id", "text", "tie", F.col("target").alias("range"), F.lit(1).alias("halo"))
    )
    dealt = rows.withColumn("halo", F.lit(0)).unionByName(halo).repartitionById(len(bounds) + 1, "range")
    ordered = dealt.sortWithinPartitions("range", "halo", F.desc_nulls_last("doc_id"), F.desc("tie"))

    def read_through(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: tuple | None = None  # the document that waits for the next, with its sketch
        for frame in frames:
            found = []
            for d, t, h in zip(frame["doc_id"], frame["text"], frame["halo"]):
                own = sketch(t)
                if last is not None:
                    changed = edited(last[1], t)
                    new = sketch(changed)
                    found.append((
                        last[0], len(last[1]), changed, to_text(last[2]), to_text(new),
                        likeness(last[2], new), likeness(last[2], own), containment(last[2], new), containment(last[2], own),
                    ))
                last = None if h else (d, t, own)
            yield pd.DataFrame(found, columns=names)

    schema = RESULT.format(kind="string")
    names = [part.split()[0] for part in schema.split(", ")]
    # As text: a null id would turn the ids of a frame into floating-point.
    read = ordered.withColumn("doc_id", F.col("doc_id").cast("string")).mapInPandas(read_through, schema)
    return read.withColumn("doc_id", F.col("doc_id").cast(kind))
