"""Token ids in files of directly addressable codes.

An id is cut into chunks of ``CHUNK`` bits, lowest first. Level 0 holds the first
chunk of every id; a bitmap says which ids go on, and level 1 holds the second
chunk of just those, with a bitmap of its own; and so on. To read the id at place
i: take chunk i of level 0; if bit i is set, the place in level 1 is the number
of set bits before i, which a rank directory (the count before every block of
``RANK_BITS`` bits) and one count within the block give; go on there. So any
token is read with a few bytes per level, and nothing else is decoded.

File: ``DAC1``, then segments of at most SEGMENT ids, then the footer (JSON: ids,
segments with the offsets of their parts, offset of the document table), the
length of the footer (8 bytes, little endian) and ``DAC1``. The document table is
three columns of 64-bit integers: doc_id, first id within the file, ids.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Callable, Iterator
from itertools import chain
from typing import BinaryIO

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postrank.llm.files import open_file, write_file
from postrank.llm.ordered import range_bounds, range_of, ranges_for
from postrank.llm.rows import quoted
from postrank.storage import scratch_dir

MAGIC = b"DAC1"
CHUNK = 8
RANK_BITS = 512
SEGMENT = 1 << 20
END_ID = 1
#: Stems and words a Python process remembers the ids of; of a full memory only those in use stay.
REMEMBERED = 600_000
#: Letters of which a run is one piece to the tokenizer, in any case, and what may follow it.
PLAIN = "^[A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+[,.]?$"
#: Characters of text encoded at once.
BLOCK_CHARS = 4 << 20
#: Stands for a null doc_id in a file.
NO_ID = -(1 << 63)


# ---- the code ----

def encode_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap bytes, rank directory) of each level."""
    left, levels = ids.astype(np.uint32), []
    while len(left) or not levels:
        more = left >> np.uint32(CHUNK)
        goes_on = more > 0
        bits = np.packbits(goes_on, bitorder="little")
        bits = np.pad(bits, (0, -len(bits) % (RANK_BITS // 8)))
        ones = np.bitwise_count(bits.reshape(-1, RANK_BITS // 8)).sum(axis=1, dtype=np.uint32)
        rank = np.concatenate([[0], np.cumsum(ones, dtype=np.uint32)[:-1]]).astype("<u4") if len(ones) else ones.astype("<u4")
        levels.append(((left & np.uint32((1 << CHUNK) - 1)).astype(np.uint8), bits, rank))
        left = more[goes_on]
    return levels


def decode_levels(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """All ids of a segment."""
    above = np.empty(0, np.uint32)
    for chunks, bits, _ in reversed(levels):
        ids = chunks.astype(np.uint32)
        if len(above):
            ids[np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)] |= above << np.uint32(CHUNK)
        above = ids
    return above


class TokenFile:
    """Reads a file by place, or a document, without reading the rest."""

    def __init__(self, file: BinaryIO):
        self.file = file
        file.seek(0, 2)
        size = file.tell()
        file.seek(size - 12)
        length, magic = struct.unpack("<Q4s", file.read(12))
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.footer = json.loads(self._read(size - 12 - length, length))
        self.n_ids = self.footer["ids"]

    def _read(self, at: int, size: int) -> bytes:
        self.file.seek(at)
        return self.file.read(size)

    def token(self, place: int) -> int:
        """The id at a place of the file: a chunk, a bitmap block and a rank per level."""
        if not 0 <= place < self.n_ids:
            raise IndexError(place)
        value, shift, i = 0, 0, place % SEGMENT
        for level in self.footer["segments"][place // SEGMENT]["levels"]:
            value |= self._read(level["chunks"] + i, 1)[0] << shift
            block, inside = divmod(i, RANK_BITS)
            bits = int.from_bytes(self._read(level["bits"] + block * (RANK_BITS // 8), RANK_BITS // 8), "little")
            if not bits >> inside & 1:
                break
            before = int.from_bytes(self._read(level["rank"] + 4 * block, 4), "little")
            i = before + (bits & ((1 << inside) - 1)).bit_count()
            shift += CHUNK
        return value

    def segment(self, number: int) -> np.ndarray:
        return decode_levels([
            (
                np.frombuffer(self._read(x["chunks"], x["n"]), np.uint8),
                np.frombuffer(self._read(x["bits"], -(-x["n"] // RANK_BITS) * (RANK_BITS // 8)), np.uint8),
                np.empty(0, "<u4"),
            )
            for x in self.footer["segments"][number]["levels"]
        ])

    def documents(self) -> np.ndarray:
        """Rows of (doc_id, first id in the file, ids)."""
        n = self.footer["documents"]
        return np.frombuffer(self._read(self.footer["table"], 24 * n), "<i8").reshape(3, n).T

    def read_documents(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """(doc_id, first id in the file, ids) of each document, a segment at a time."""
        number, held, start = 0, np.empty(0, np.uint32), 0  # ids from ``start`` on
        for doc_id, first, n in self.documents().tolist():
            held, start = held[first - start :], first
            parts, have = [held], len(held)
            while have < n:
                parts.append(self.segment(number))
                have += len(parts[-1])
                number += 1
            held = np.concatenate(parts) if len(parts) > 1 else held
            yield doc_id, first, held[:n]


def write_ids(out: BinaryIO, documents: Iterator[tuple[int, np.ndarray]]) -> tuple[int, int]:
    """Write (doc_id, ids) in the order given; documents and ids written."""
    at = out.write(MAGIC)
    segments, table, held, have, total = [], [], [], 0, 0

    def flush(ids: np.ndarray) -> None:
        nonlocal at
        levels = []
        for chunks, bits, rank in encode_levels(ids):
            places = {"n": len(chunks)}
            for name, part in (("chunks", chunks), ("bits", bits), ("rank", rank)):
                places[name] = at
                at += out.write(part.tobytes())
            levels.append(places)
        segments.append({"levels": levels})

    for doc_id, ids in documents:
        table.append((doc_id, total, len(ids)))
        total += len(ids)
        held.append(ids)
        have += len(ids)
        if have >= SEGMENT:
            joined = np.concatenate(held)
            whole = have // SEGMENT * SEGMENT
            for i in range(0, whole, SEGMENT):
                flush(joined[i : i + SEGMENT])
            held, have = [joined[whole:].copy()], have - whole
    if have:
        flush(np.concatenate(held))
    columns = np.array(table, "<i8").reshape(-1, 3).T
    footer = json.dumps({"ids": total, "segments": segments, "documents": len(table), "table": at}).encode()
    out.write(np.ascontiguousarray(columns).tobytes())
    out.write(footer)
    out.write(struct.pack("<Q4s", len(footer), MAGIC))
    return len(table), total


# ---- tokens ----

class Encoder:
    """Ids of texts by a tokenizer of the ``tokenizers`` library, word by different word.

    The tokenizers meant here drop white space, never join across it, and lower
    the case, so the ids of a text are those of its words. Each different word of
    a block of texts is encoded once; words of plain letters in any case, with at
    most one comma or full stop behind (which stands for itself), once per stem.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Stems, and words that are none, by number; the ids of number i are flat[start[i] : start[i + 1]].
        self.known: dict[str, int] = {}
        self.flat, self.start = np.empty(0, np.uint32), np.zeros(1, np.int64)
        self._learn(["", ",", "."], self._encoded)

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [c.ids for c in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], np.int64)

    def _encoded_stems(self, stems: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each stem is one piece of the text they make together."""
        code = self.tokenizer.encode(" ".join(stems), add_special_tokens=False)
        return np.array(code.ids, np.uint32), np.bincount(np.array(code.word_ids, np.int64), minlength=len(stems))

    def _learn(self, words: list[str], encoded: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> None:
        ids, sizes = [self.flat], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 5000):
            found = encoded(words[at : at + 5000])
            ids.append(found[0])
            sizes.append(found[1])
        self.known.update(zip(words, range(len(self.start) - 1, len(self.start) - 1 + len(words))))
        self.flat = np.concatenate(ids)
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(np.concatenate(sizes))])

    def _forget(self, wanted: list[str]) -> None:
        """Keep what is wanted now, which has all frequent words, and the first three."""
        held = ["", ",", ".", *(w for w in wanted if w in self.known and w not in ("", ",", "."))]
        at = np.fromiter(map(self.known.__getitem__, held), np.int64, len(held))
        sizes = (self.start[1:] - self.start[:-1])[at]
        self.flat = self._gathered(at)
        self.start = np.concatenate([[0], np.cumsum(sizes)])
        self.known = dict(zip(held, range(len(held))))

    def _gathered(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of these numbers, one after another."""
        n = (self.start[1:] - self.start[:-1])[numbers]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.start[:-1][numbers] - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]

    def _numbers(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Of each different word, the number of its stem (or of itself) and of what follows."""
        plain = pc.match_substring_regex(words, PLAIN)
        some, is_plain = words.filter(plain), plain.to_numpy(zero_copy_only=False)
        coded = pc.utf8_rtrim(pc.utf8_lower(some), characters=",.").dictionary_encode()
        stems, others = coded.dictionary.to_pylist(), words.filter(pc.invert(plain)).to_pylist()
        if len(self.known) > REMEMBERED:
            self._forget([*stems, *others])
        self._learn([w for w in stems if w not in self.known], self._encoded_stems)
        self._learn([w for w in others if w not in self.known], self._encoded)
        first, then = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        number = self.known.__getitem__
        first[is_plain] = np.fromiter(map(number, stems), np.int64, len(stems))[coded.indices.to_numpy()]
        first[~is_plain] = np.fromiter(map(number, others), np.int64, len(others))
        then[is_plain] = pc.ends_with(some, ",").to_numpy(zero_copy_only=False) + 2 * pc.ends_with(some, ".").to_numpy(zero_copy_only=False)
        return first, then

    def ids(self, texts: pa.StringArray) -> list[np.ndarray]:
        """Ids of each text; a null is empty. ``blocks`` gives texts in fit portions."""
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        words = split.flatten().dictionary_encode()
        first, then = self._numbers(words.dictionary)
        word = words.indices.to_numpy()
        numbers = np.empty(2 * len(word), np.int64)
        numbers[0::2], numbers[1::2] = first[word], then[word]
        ends = np.concatenate([[0], np.cumsum((self.start[1:] - self.start[:-1])[numbers])])
        cuts = ends[2 * (split.offsets.to_numpy() - split.offsets[0].as_py())].tolist()
        ids = self._gathered(numbers)
        return [ids[i:j] for i, j in zip(cuts, cuts[1:])]


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    """The encoder of this Python process, which serves one task after another."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# ---- writing and reading on Spark ----

WRITTEN = pa.schema([("number", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())])


def blocks(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about BLOCK_CHARS bytes of text each; a longer text is alone."""
    ends = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK_CHARS, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def write_tokens(docs: DataFrame, tokenizer: str, folder: str, text: str = "text", doc_id: str = "doc_id",
                 end_id: int = END_ID) -> DataFrame:
    """Write all documents in ascending doc_id order, one file per range of ids.

    Gives one row per file: number, path, documents, ids, start (ids of all files
    before it), also stored as ``<folder>/_files``. ``end_id`` ends every document. Null
    texts count as empty; equal doc_ids follow each other by a hash of their
    text; a null doc_id comes last. An empty table gives no file.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    bounds = range_bounds(rows, "doc_id", ranges_for(rows, "text"))
    dealt = (
        rows.withColumn("range", range_of(F.col("doc_id"), bounds, descending=False))
        .repartitionById(len(bounds) + 1, "range")
        .sortWithinPartitions("range", F.asc_nulls_last("doc_id"), F.xxhash64("text"), "text")
    )
    end = np.array([end_id], "<u4")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = next((b for b in batches if b.num_rows), None)
        if first is None:
            return
        number = first.column("range")[0].as_py()

        def documents() -> Iterator[tuple[int, np.ndarray]]:
            encoder = encoder_of(tokenizer)
            for batch in chain([first], batches):
                for part in blocks(batch, "text"):
                    names = part.column("doc_id").fill_null(NO_ID).to_pylist()
                    for name, ids in zip(names, encoder.ids(part.column("text"))):
                        yield name, np.concatenate([ids, end])

        path = f"{folder}/part-{number:06d}.dac"
        n_docs, n_ids = write_file(path, lambda out: write_ids(out, documents()))
        yield pa.RecordBatch.from_pylist([{"number": number, "path": path, "documents": n_docs, "ids": n_ids}], WRITTEN)

    dealt.mapInArrow(write, "number int, path string, documents long, ids long").write.parquet(f"{folder}/_written")
    files = spark.read.parquet(f"{folder}/_written").orderBy("number").collect()
    starts = np.concatenate([[0], np.cumsum([f["ids"] for f in files], dtype=np.int64)[:-1]]).tolist()
    manifest = spark.createDataFrame(
        [(i, f["path"], f["documents"], f["ids"], int(s)) for i, (f, s) in enumerate(zip(files, starts))],
        "number int, path string, documents long, ids long, start long",
    )
    manifest.write.parquet(f"{folder}/_files")
    return spark.read.parquet(f"{folder}/_files")


def read_tokens(files: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, read from the files.

    ``files`` as ``write_tokens`` gives it. The checksum is over the ids as
    little-endian unsigned 32-bit integers.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, base in zip(frame["path"], frame["start"]):
                with open_file(path) as file:
                    found = [
                        (None if d == NO_ID else d, base + first, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                        for d, first, ids in TokenFile(file).read_documents()
                    ]
                names = pd.array([f[0] for f in found], dtype="Int64")
                yield pd.DataFrame([f[1:] for f in found], columns=["start", "n_tokens", "ids_crc32"]).assign(doc_id=names)[
                    ["doc_id", "start", "n_tokens", "ids_crc32"]
                ]

    # Each file is a task: the list of files is small, the files are not.
    spread = files.repartitionById(max(1, files.count()), "number")
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    return write_tokens(docs, tokenizer, scratch_dir(spark, "tokens"))
