import gzip
import hashlib

import pytest

from postrank.llm import warc
from postrank.llm.files import open_file
from postrank.llm.queries import QUERIES
from postrank.storage import scratch_dir
from tests.llm.conftest import SF_DIR, needs_tables

BIG, LIMIT, BELOW = "x" * 1500 + "é", "y" * 1000, "z" * 999
PAGES = [
    (1, "http://a/", BIG), (2, "http://b/\r\nWARC-Type: evil", BIG), (9, None, BIG), (9, "http://c/", BIG), (3, "", LIMIT), (4, "u", LIMIT),
    (5, "u", BELOW), (6, "u", BELOW), (7, "u", None), (8, "u", ""), (None, "u", BIG), (None, None, None), (10, "u", "\r\n\r\nWARC/1.1\r\n" * 200),
    (11, "u", "long \U0001F600 " * 200_000),
]
SCHEMA = "page_id long, url string, html string, file string, offset int, digest string, row string, type string"


@pytest.fixture
def pages(spark):
    return lambda rows=PAGES: spark.createDataFrame([(*r, "f", 1, "d", "r", "t") for r in rows], SCHEMA)


def expected(rows):
    """(page_id, bytes, digest, type, refers_to) as a multiset; of equal page_ids one responds."""
    groups, out = {}, []
    for i, (p, _, h) in enumerate(rows):
        body = (h or "").encode()
        groups.setdefault(body, []).append((p is not None, p or 0, i))
    for i, (p, _, h) in enumerate(rows):
        body = (h or "").encode()
        digest = hashlib.sha1(body).hexdigest()
        latest = max(groups[body])
        first = len(body) < 1000 or (p is not None, p or 0) == latest[:2] and latest[2] == i
        out.append((p, len(body), digest, "response" if first else "revisit", None if first else rows[latest[2]][0]))
    return sorted(out, key=str)


def run(frame):
    index = warc.archive_pages(frame)
    rows = warc.read_records(index).collect()
    number = lambda x: None if x is None else int(x)
    return index, rows, sorted(((number(r.page_id), r.payload_bytes, r.digest, r.type, number(r.refers_to_page)) for r in rows), key=str)


def test_edges(pages):
    index, rows, got = run(pages())
    assert got == expected(PAGES)
    ids = {r.record_id: r for r in rows}
    assert len(ids) == len(PAGES)
    for r in rows:
        if r.type == "revisit":
            assert r.payload is None and ids[r.refers_to].type == "response" and ids[r.refers_to].digest == r.digest
        else:
            assert hashlib.sha1(r.payload).hexdigest() == r.digest
    assert "http://b/ WARC-Type: evil" in {r.url for r in rows}
    assert index.count() == len(PAGES)


def test_empty(pages):
    index, rows, got = run(pages([]))
    assert index.count() == 0 and got == []


def test_files_are_archives(pages, spark):
    """Any gzip reader sees the records one after another."""
    index = warc.write_archives(pages(), scratch_dir(spark, "w")).collect()
    for path in {r.file for r in index}:
        with open_file(path) as file:
            whole = file.read()
        own = sorted((r.offset, r.length) for r in index if r.file == path)
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and sum(own[-1]) == len(whole)
        assert gzip.decompress(whole) == b"".join(gzip.decompress(whole[a : a + n]) for a, n in own)
        assert all(gzip.decompress(whole[a : a + n]).startswith(b"WARC/1.1\r\nWARC-Type: ") for a, n in own)


def test_selected_records(pages, spark):
    index = warc.write_archives(pages(), scratch_dir(spark, "w"))
    digest = hashlib.sha1(LIMIT.encode()).hexdigest()
    got = warc.read_records(index.filter(index.digest == digest)).collect()
    assert sorted(r.page_id for r in got) == ["3", "4"]


def test_ranges_are_joined():
    ranges = [(0, 10), (10, 5), (20, 5), (100, 5), (105, 1)]
    reads = warc.coalesce_ranges(ranges, gap=5, most=1000)
    assert [(a, b) for a, b, _ in reads] == [(0, 25), (100, 106)]
    assert [m for _, _, ms in reads for m in ms] == ranges
    assert len(warc.coalesce_ranges(ranges, gap=500, most=16)) == 3
    assert warc.coalesce_ranges([]) == []


@needs_tables
def test_query_on_given_tables(spark, given):
    rows = [(r.page_id, r.url, r.html) for r in given("pages").collect()]
    got = sorted((tuple(r) for r in QUERIES["op9_warc"](spark, SF_DIR).collect()), key=str)
    assert got == expected(rows)
