"""Byte-pair encoding beside the library, on whole texts and on odd ones."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from postrank.llm.bpe import Bpe, Merges, byte_characters, decode_column, encode_column
from postrank.llm.queries import op11_bpe
from tests.llm.conftest import EDGES, LONG, SF_DIR, needs_tables

FILES = ("word_bpe_49k.json", "byte_bpe_50k.json")
ODD = [
    "", " ", "a", "a" * 3000, "ab" * 999, "don't I'LL we've 's's", "x<|endoftext|>y <|startoftext|><|startoftext|>", "<|endoftext|",
    "İstanbul ΣΑΣ ς ﬁ ½ ² ª ſs", "a\u0085b\x1cc\x1f d　e\xa0f", "é ́a ö", "Å Ω Ά", "日本語のテキスト",
    "\U0001f600\U0001f44d\U0001f3fd", "Ⱥ Ⱦ", "１２３ ٣٤ Ⅷ", "﻿abc\x00", LONG, "Zyx " * 5000, "!" * 500 + "?!" * 500,
]
LETTERS = "abcdeABC'stredlm0123 \n\t.,;!?<|>_-éÉßİıſΣσςあ漢\U0001f600́ \u0085 ٣½"


def samples(count=600):
    random_ = random.Random(7)
    some = ["".join(random_.choice(LETTERS) for _ in range(random_.randint(0, 30))) for _ in range(count)]
    return some + ["".join(chr(random_.choice([random_.randint(0, 0x24F), random_.randint(0, 0xD7FF)])) for _ in range(9)) for _ in range(count)]


@pytest.fixture(scope="module", params=FILES)
def pair(request):
    path = public_tokenizers.path(request.param)
    return Tokenizer.from_file(path), Bpe(path)


def test_as_the_library(pair):
    library, ours = pair
    texts = ODD + samples()
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    coded = ours.encode(pa.array(texts))
    assert [np.frombuffer(c.as_py(), "<u4").tolist() for c in coded] == want
    assert ours.decode(coded).to_pylist() == [library.decode(ids, skip_special_tokens=False) for ids in want]


def test_only_the_known_split_works_by_runs():
    assert [Bpe(public_tokenizers.path(f)).by_run for f in FILES] == [True, False]


def test_memory_that_starts_again_changes_nothing(monkeypatch):
    monkeypatch.setattr("postrank.llm.bpe.REMEMBERED", 50)
    monkeypatch.setattr("postrank.llm.bpe.BLOCK_BYTES", 200)
    path = public_tokenizers.path(FILES[0])
    small, texts = Bpe(path), pa.array(samples(100))
    monkeypatch.undo()
    assert small.encode(texts) == Bpe(path).encode(texts)


def test_slices_nulls_and_unknown_ids(pair):
    library, ours = pair
    texts = pa.array(["skip me", None, "one two", "", None, "three"])
    assert ours.encode(texts.slice(1)).to_pylist() == ours.encode(pa.array(["", "one two", "", "", "three"])).to_pylist()
    ids = np.array([library.encode("one", add_special_tokens=False).ids[0], 4_000_000], "<u4").tobytes()
    rows = pa.array([b"junk", ids, None, b""])
    assert ours.decode(rows.slice(1)).to_pylist() == [library.decode([np.frombuffer(ids, "<u4")[0]], skip_special_tokens=False), "", ""]


def one_pair_at_a_time(symbols, ranks, made):
    while True:
        known = [(ranks[p], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in ranks]
        if not known:
            return symbols
        rank, i = min(known)
        symbols = [*symbols[:i], made[rank], *symbols[i + 2 :]]


@pytest.mark.parametrize("in_order", [True, False])
def test_rounds_equal_single_merges(in_order):
    """Random tables, also ones where a merge comes before those that make its parts."""
    random_ = random.Random(3)
    for _ in range(30):
        tokens, merges = list("abc"), []
        while len(merges) < 12:
            a, b = random_.choice(tokens), random_.choice(tokens)
            if a + b not in tokens:
                tokens.append(a + b)
                merges.append([a, b])
        if not in_order:
            random_.shuffle(merges)
        vocab = {t: i for i, t in enumerate([*byte_characters(), *(t for t in tokens if len(t) > 1)])}
        table = Merges(vocab, merges)
        ranks = {(vocab[a], vocab[b]): i for i, (a, b) in enumerate(merges)}
        words = ["".join(random_.choice("abc") for _ in range(random_.randint(0, 25))) for _ in range(40)]
        ids, sizes = table.merge(words)
        got = [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]
        assert got == [one_pair_at_a_time([vocab[c] for c in w], ranks, [vocab[a + b] for a, b in merges]) for w in words]


def test_columns_of_a_table(spark, docs):
    path = public_tokenizers.path(FILES[0])
    library = Tokenizer.from_file(path)
    rows = docs().withColumn("ids", encode_column(F.col("text"), path)).withColumn("back", decode_column(F.col("ids"), path)).collect()
    assert len(rows) == len(EDGES)
    for row in rows:
        want = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(row["ids"], "<u4").tolist() == want
        assert row["back"] == library.decode(want, skip_special_tokens=False)
    assert docs([]).withColumn("ids", encode_column(F.col("text"), path)).count() == 0


@needs_tables
def test_query_equals_the_library(spark, given):
    library = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    want = {}
    for row in given("documents").collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[row["doc_id"]] = (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()
        )
    found = op11_bpe(spark, SF_DIR)
    assert dict(found.dtypes)["n_tokens"] == "bigint"
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found.collect()} == want
