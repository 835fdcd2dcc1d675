"""WARC archives: written with an index, read by coalesced byte ranges.

Every page is a WARC/1.1 record, one gzip member each, so a record can be read
alone. Of records with equal payloads of at least REVISIT_BYTES the one with the
largest page_id is a ``response``; the others are ``revisit`` records (profile
identical-payload-digest) that hold no payload but the HTTP head, whose
Content-Length is the payload's, and refer to that response.

Writing gives the index first: file, offset, length, URL, digest, type and ids of
every record, stored as a table. Reading takes any selection of index rows,
sorts it by file and offset, joins neighbouring byte ranges into one read, and
cuts the records out. Files are the unit of work, and bounded by the writer.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postrank.llm.files import open_file, write_file
from postrank.llm.rows import keyed, quoted
from postrank.storage import scratch_dir, written

REVISIT_BYTES = 1000
#: Byte ranges closer than this are read together, up to READ_BYTES at once.
GAP_BYTES, READ_BYTES = 64 << 10, 8 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6f1d1a52-90f0-4f0e-9f6e-0d2c5a0c7a11")
INDEX = "file string, offset long, length long, url string, digest string, type string, row long"


# ---- records ----

def record_id(row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, str(row))}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return " ".join(value.split())


def make_record(row: int, page_id: object, url: str | None, payload: bytes, size: int, digest: str,
                refers_row: int | None, refers_page: object) -> bytes:
    """One record; ``digest`` in hexadecimal. A null page_id or URL leaves its line out."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = head if refers_row is not None else head + payload
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_row is None else 'revisit'}", f"WARC-Record-ID: {record_id(row)}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if page_id is not None:
        lines.append(f"X-Page-ID: {page_id}")
    lines += [f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}"]
    if refers_row is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_row)}"]
        if refers_page is not None:
            lines.append(f"X-Refers-To-Page-ID: {refers_page}")
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


def parse_record(raw: bytes) -> dict:
    """Fields of a record, its HTTP fields under ``http``, its payload (None in a revisit)."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = _fields(head)
    block = rest[: int(fields["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields | {"http": _fields(http), "payload": payload if fields["warc-type"] == "response" else None}


def gzip_member(raw: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


# ---- writing ----

def decide(narrow: DataFrame) -> DataFrame:
    """row, refers_row, refers_page for the rows that repeat a payload; all others respond.

    ``narrow`` has row (unique), page, digest and size.
    """
    large = narrow.filter(F.col("size") >= REVISIT_BYTES)
    latest = F.max(F.struct(F.col("page"), F.col("row"))).alias("latest")
    groups = large.groupBy("digest", "size").agg(latest, F.count("*").alias("n")).filter("n > 1")
    return (
        large.join(groups, ["digest", "size"]).filter(F.col("row") != F.col("latest.row"))
        .select("row", F.col("latest.row").alias("refers_row"), F.col("latest.page").alias("refers_page"))
    )


def write_archives(pages: DataFrame, folder: str, url: str = "url", html: str = "html", page_id: str = "page_id") -> DataFrame:
    """Write ``pages`` as archives ``<folder>/part-<n>.warc.gz``; the index, stored in ``<folder>/_index``.

    A null html is an empty payload; a null url or page_id is left out of its
    record. Equal page_ids are told apart by their row. An empty table writes no
    archive and gives an empty index.

    Which records respond is decided on narrow rows; the pages meet the decision
    in one join, whose tasks write a file each.
    """
    table, key = keyed(pages, "pages")
    body = F.coalesce(F.col(quoted(html)), F.lit(""))
    narrow = written(
        table.select(
            F.col(key).alias("name"), F.monotonically_increasing_id().alias("row"), F.col(quoted(page_id)).alias("page"),
            F.sha1(body).alias("digest"), F.octet_length(body).alias("size"),
        ),
        "payloads",
    )
    # As text: a missing number would make a column of the frames floating-point.
    known = narrow.join(decide(narrow), "row", "left").select(
        "name", "row", F.col("refers_row").cast("string"), F.col("refers_page").cast("string")
    )
    source = table.select(
        F.col(key).alias("key"), F.col(quoted(page_id)).cast("string").alias("page"), F.col(quoted(url)).alias("url"), body.alias("html")
    )
    dealt = source.join(known, F.col("key") == F.col("name")).drop("key", "name").sortWithinPartitions("row")

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = next((f for f in frames if len(f)), None)
        if first is None:
            return
        path, index = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", []

        def archive(out: BinaryIO) -> None:
            at, frame = 0, first
            while frame is not None:
                for r, page, url_, body, other, other_page in zip(
                    frame["row"], frame["page"], frame["url"], frame["html"], frame["refers_row"], frame["refers_page"]
                ):
                    payload = body.encode("utf-8", "surrogatepass")
                    digest = hashlib.sha1(payload).hexdigest()
                    refers = None if pd.isna(other) else int(other)
                    member = gzip_member(make_record(r, page, url_, payload, len(payload), digest, refers, other_page))
                    index.append((path, at, len(member), url_, digest, "response" if refers is None else "revisit", r))
                    at += out.write(member)
                frame = next(frames, None)

        write_file(path, archive)
        yield pd.DataFrame(index, columns=["file", "offset", "length", "url", "digest", "type", "row"])

    dealt.mapInPandas(write, INDEX).write.parquet(f"{folder}/_index")
    return pages.sparkSession.read.schema(INDEX).parquet(f"{folder}/_index")


# ---- reading ----

def coalesce_ranges(ranges: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """(start, end, members) of the reads that cover sorted (offset, length) ranges."""
    reads: list[tuple[int, int, list[tuple[int, int]]]] = []
    for at, length in ranges:
        if reads and at - reads[-1][1] <= gap and at + length - reads[-1][0] <= most:
            start, end, members = reads[-1]
            members.append((at, length))
            reads[-1] = (start, max(end, at + length), members)
        else:
            reads.append((at, at + length, [(at, length)]))
    return reads


RECORD = (
    "file string, offset long, record_id string, type string, url string, page_id string, date string, digest string, "
    "payload_bytes long, refers_to string, refers_to_page string, payload binary"
)


def read_records(selected: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records that rows of an index name (file, offset, length); columns as RECORD.

    ``digest`` is the payload's SHA-1 in hexadecimal: of a response computed from
    what was read, of a revisit as recorded. ``payload_bytes`` likewise.
    """

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path, part in frame.groupby("file", sort=False):
                ranges = list(zip(part["offset"].tolist(), part["length"].tolist()))
                with open_file(path) as file:
                    for start, end, members in coalesce_ranges(ranges):
                        file.seek(start)
                        buffer = file.read(end - start)
                        found = []
                        for at, length in members:
                            x = parse_record(zlib.decompress(buffer[at - start : at - start + length], 31))
                            body = x["payload"]
                            stated = base64.b32decode(x["warc-payload-digest"].removeprefix("sha1:")).hex()
                            found.append((
                                path, at, x["warc-record-id"], x["warc-type"], x.get("warc-target-uri"), x.get("x-page-id"),
                                x["warc-date"], stated if body is None else hashlib.sha1(body).hexdigest(),
                                int(x["http"]["content-length"]) if body is None else len(body),
                                x.get("warc-refers-to"), x.get("x-refers-to-page-id"), body if with_payload else None,
                            ))
                        yield pd.DataFrame(found, columns=names)

    names = [c.split()[0] for c in RECORD.split(", ")]
    spots = selected.select("file", "offset", "length")
    # By number, not by the size of the index: what is read is far larger than its rows.
    tasks = int(selected.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spots.repartition(tasks, "file").sortWithinPartitions("file", "offset").mapInPandas(read, RECORD)


def archive_pages(pages: DataFrame, **names: str) -> DataFrame:
    """Write to a scratch folder; the index."""
    return write_archives(pages, scratch_dir(pages.sparkSession, "warc"), **names)
