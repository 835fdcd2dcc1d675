"""Phrase mining beside counts of everything."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postrank.llm import phrases
from postrank.llm.phrases import count_phrases, filter_of, mine_phrases, score, thresholds
from postrank.llm.queries import ORACLES, QUERIES
from tests.llm.conftest import SF_DIR, document, needs_tables


def brute(rows, limit, least=30):
    """rows of (text, lang): every phrase counted, every rule applied to all."""
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for m in (1, 2, 3, 4):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        best = {}
        for p, a in candidates.items():
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p))]
            value, k = min(cuts)
            best[p] = (value, f[p[:k]], f[p[k:]])
        gone = set()
        for q, b in candidates.items():
            for m in range(2, len(q)):
                gone |= {q[i : i + m] for i in range(len(q) - m + 1) if 100 * b >= 80 * candidates[q[i : i + m]]}
        left = sorted(((-best[p][0], -a, " ".join(p).encode()), p) for p, a in candidates.items() if p not in gone)
        for rank, (_, p) in enumerate(left[:limit], 1):
            value, l, r = best[p]
            out.append((lang, rank, " ".join(p), candidates[p], l, r, totals[lang], value))
    return sorted(out)


def corpus(seed, count=300):
    """Few words, often in fixed phrases, so that many candidates hold each other."""
    random_ = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["Été", "漢", "A\xa0b"]
    fixed = [" ".join(random_.choice(words) for _ in range(random_.randint(2, 6))) for _ in range(12)]
    made = []
    for _ in range(count):
        parts = [random_.choice(fixed) if random_.random() < 0.6 else random_.choice(words) for _ in range(random_.randint(0, 30))]
        made.append((random_.choice([" ", "  ", "\t"]).join(p + random_.choice(["", "", "", ".", ",", "\n"]) for p in parts),
                     random_.choice(["en", "en", "EN", None])))
    return made + [(None, "en"), ("", None), ("...", "xx"), (" \t ", None)]


def mined(spark, rows, limit):
    found = mine_phrases(spark.createDataFrame(rows, "text string, lang string").repartition(3), limit=limit)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("seed, limit", [(1, 2000), (2, 5), (3, 40)])
def test_equals_counting_everything(spark, seed, limit):
    rows = corpus(seed)
    assert mined(spark, rows, limit) == brute(rows, limit)


def test_goes_deeper_until_enough_survive(spark, monkeypatch):
    """A first threshold that leaves too few: more rounds, same result, and none when not needed."""
    rounds = []
    real = thresholds
    monkeypatch.setattr(phrases, "thresholds", lambda pairs, depth: (rounds.append(depth), real(pairs, depth))[1])
    monkeypatch.setattr(phrases, "FIRST_DEPTH", phrases.WANTED // 10)
    rows = corpus(4)
    assert mined(spark, rows, 20) == brute(rows, 20)
    assert len(rounds) > 1 and rounds[0] == 2
    rounds.clear()
    monkeypatch.setattr(phrases, "FIRST_DEPTH", phrases.WANTED * 50)
    assert mined(spark, rows, 20) == brute(rows, 20) and len(rounds) == 1


def test_filters_that_err_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LEAST_BITS", 64)
    monkeypatch.setattr(phrases, "MOST_BITS", 64)
    rows = corpus(5)
    assert mined(spark, rows, 30) == brute(rows, 30)


def test_only_what_is_asked_for_is_counted(spark):
    """Phrases of which neither part nor whole is in a filter cost nothing."""
    texts = pa.array([t or "" for t, _ in corpus(6)], pa.large_string())
    langs = ["en"] * len(texts)
    all_ = phrases.Filter(np.full(1024, 2**64 - 1, np.uint64))
    none = filter_of(spark.createDataFrame([], "lang string, g1 long, g2 long"))
    whole = count_phrases(texts, langs, 3, all_, None, None, all_)
    assert whole.num_rows > 0 and count_phrases(texts, langs, 3, all_, none, none, none).num_rows == 0
    one = spark.createDataFrame(whole.slice(0, 1).to_pandas())
    for own, given in (("g", (None, None)), ("p", ()), ("s", (None,))):
        chosen = filter_of(one.select("lang", f"{own}1", f"{own}2"))
        rows = count_phrases(texts, langs, 3, all_, *[*given, chosen, None, None][:3])
        assert 0 < rows.num_rows < whole.num_rows / 4


def test_exact_beyond_64_bits(spark):
    a = 9_000_000_000_000_000_000
    frame = spark.createDataFrame([(a, a, a), (30, 31, 2**62)], "a long, l long, r long")
    got = [r[0] for r in frame.select(score(F.col("a"), F.col("l").cast("decimal(20,0)") + F.col("r"))).collect()]
    assert got == [2_000_000 * x // (y + z) for x, y, z in [(a, a, a), (30, 31, 2**62)]]


def test_tables_without_phrases_and_clashing_columns(spark, docs):
    assert mine_phrases(docs([])).collect() == []
    rows = [document(i % 3, "One two three, four." * (i % 4), None if i % 2 else "en") for i in range(60)]
    found = sorted(tuple(r) for r in mine_phrases(docs(rows)).collect())
    assert found == brute([(r[1], r[2]) for r in rows], 2000) and found


@needs_tables
def test_query_equals_its_sql(spark):
    from harness.check import connect, rows_of

    found = QUERIES["op12_phrases"](spark, SF_DIR)
    cursor = connect(SF_DIR).execute(ORACLES["op12_phrases"])
    want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    assert rows_of(found.columns, found.collect()) == want and want
