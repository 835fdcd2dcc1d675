"""Run detection beside a search of every period at every place."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postrank.llm.periodic import Names, WaveletTree, periodic, periodic_column
from postrank.llm.queries import op13_periodic_runs
from tests.llm.conftest import EDGES, SF_DIR, needs_tables


def split(text):
    return re.findall("[^\x20\x09-\x0D]+", text or "")


def brute_runs(words):
    """(start, length, period) of all runs, by start and period."""
    codes, found = np.unique(words, return_inverse=True)[1] if words else np.empty(0, int), {}
    for q in range(1, len(words) // 3 + 1):
        equal = np.concatenate([[0], (codes[:-q] == codes[q:]).astype(int), [0]])
        for a, b in zip(np.flatnonzero(np.diff(equal) == 1), np.flatnonzero(np.diff(equal) == -1)):
            if b - a + q >= max(24, 3 * q):
                found.setdefault((int(a), int(b - a + q)), q)
    return sorted(((a, n, q) for (a, n), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def texts(seed, count=150):
    random_, made = random.Random(seed), []
    for _ in range(count):
        n, kinds = random_.randint(0, 300), random_.choice([1, 2, 2, 3, 5, 50])
        words = [str(random_.randrange(kinds)) for _ in range(n)]
        for _ in range(random_.randint(0, 4) if n >= 30 else 0):
            a, p = random_.randrange(n), random_.randint(1, n // 4)
            for i in range(a, random_.randint(a, n)):
                words[i] = words[a + (i - a) % p]
        made.append(random_.choice([" ", "\n", " \t "]).join(words))
    return made


def fibonacci(n):
    a, b = "a", "b"
    while len(b) < n:
        a, b = b, b + a
    return " ".join(b)


SPECIAL = [
    "", None, " \n", "a " * 23, "a " * 24, "x " + "a " * 24 + "y", "a b " * 12, "a b c d e f g h i " * 3, "a b c d e f g h i j " * 2,
    fibonacci(900), " ".join("a" * 1000), " ".join(("a" * 16 + "b" * 16) * 12), " ".join(("a" * 8 + "b" * 8) * 12),
    " ".join(("a" * 40 + "b") * 9 + "a" * 100), " ".join(["a b"] * 30 + ["b a"] * 30), "é 漢 " * 30, "\xa0 b " * 20,
]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_every_run_is_found(seed, monkeypatch):
    monkeypatch.setattr("postrank.llm.bpe.BLOCK_BYTES", 20_000)
    given = SPECIAL + texts(seed)
    for text, row in zip(given, periodic(pa.array(given)).to_pylist()):
        words = split(text)
        want = brute_runs(words)
        assert [tuple(r.values()) for r in row["runs"]] == want
        assert row["collapsed"] == collapsed(words, want)


def test_suffix_order_and_successor():
    random_ = np.random.default_rng(4)
    codes = np.concatenate([random_.integers(0, 3, 300), [3]])
    names = Names(codes)
    assert names.suffixes.tolist() == sorted(range(301), key=lambda i: codes[i:].tolist())
    tree = WaveletTree(names.suffixes)
    low = random_.integers(0, 301, 500)
    high = np.minimum(301, low + random_.integers(0, 60, 500))
    least = random_.integers(0, 330, 500)
    want = [min((v for v in names.suffixes[a:b].tolist() if v >= x), default=-1) for a, b, x in zip(low, high, least)]
    assert tree.successor(low, high, least).tolist() == want


def test_long_runs_do_not_cost_one_step_a_copy(monkeypatch):
    asked = []
    real = WaveletTree.successor
    monkeypatch.setattr(WaveletTree, "successor", lambda self, *a: (asked.append(1), real(self, *a))[1])
    (row,) = periodic(pa.array([" ".join("a" * 50_000)])).to_pylist()
    assert row["runs"] == [{"start": 0, "length": 50_000, "period": 1}] and row["collapsed"] == "a"
    assert len(asked) < 200


def test_table_with_all_cases(spark, docs):
    found = docs().withColumn("found", periodic_column(F.col("text")))
    rows = found.select("text", "found.*", "row").collect()
    assert len(rows) == len(EDGES)
    for row in rows:
        words = split(row["text"])
        assert row["runs"] == [] and row["collapsed"] == " ".join(words)
    assert docs([]).withColumn("found", periodic_column(F.col("text"))).count() == 0


@needs_tables
def test_query_equals_brute_force(spark, given):
    found = op13_periodic_runs(spark, SF_DIR)
    kinds = dict(found.dtypes)
    assert all(kinds[c] == "bigint" for c in ("n_runs", "start", "length", "period", "exponent_milli"))
    rows = {r["doc_id"]: r for r in found.collect()}
    some = 0
    for doc in given("documents").collect():
        words = split(doc["text"])
        n, h = len(words), zlib.crc32(str(doc["doc_id"]).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        some += bool(runs)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        lines = "".join(f"{a},{length},{q}\n" for a, length, q in runs)
        row = rows.pop(doc["doc_id"])
        assert (row["start"], row["length"], row["period"]) == (best or (None,) * 3)
        assert row["exponent_milli"] == (1000 * best[1] // best[2] if best else None)
        assert row["n_runs"] == len(runs)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(collapsed(words, runs).encode()).hexdigest()
    assert not rows and some > 5
