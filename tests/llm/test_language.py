import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from postrank.llm import language
from postrank.llm.queries import QUERIES
from tests.llm.conftest import EDGES, SF_DIR, document, needs_tables, same_columns

EN = "the house and the garden with the other children there "
DE = "das haus und der garten mit den anderen kindern dort "
FR = "la maison et le jardin avec les autres enfants dehors "


def slow_trigrams(text):
    text = text.lower()
    out = []
    for i, c in enumerate(text):
        if c.isalpha():
            before = text[i - 1] if i and text[i - 1].isalpha() else "\0"
            after = text[i + 1] if i + 1 < len(text) and text[i + 1].isalpha() else "\0"
            out.append((before, c, after))
    return out


def test_trigrams():
    texts = ["The cat", "", "x", "İé ß1a\nb", "-- "]
    codes, first, words = language.trigrams(texts)
    want = [g for t in texts for g in slow_trigrams(t)]
    assert len(codes) == len(want)
    seen = {}
    for code, gram in zip(codes.tolist(), want):
        assert seen.setdefault(gram, code) == code
    assert [want[i][0] for i in first] == ["\0"] * len(first)
    assert words.tolist() == [sum(g[0] == "\0" for g in slow_trigrams(t)) for t in texts]


def test_blocks_cover_all(monkeypatch):
    monkeypatch.setattr(language, "BLOCK_CHARS", 5)
    texts = ["abc", "de", "f" * 20, "", "gh"]
    assert [t for b in language.blocks(texts) for t in texts[b]] == texts
    assert list(language.blocks([])) == []


def slow_mixture(p):
    """The same search, one word at a time, in plain numbers."""

    def em(cols, share, rounds):
        for _ in range(rounds):
            sums = [0.0] * len(cols)
            for row in p:
                weights = [row[c] * s for c, s in zip(cols, share)]
                for i, w in enumerate(weights):
                    sums[i] += w / sum(weights)
            share = [s / len(p) for s in sums]
        return share, sum(math.log(sum(row[c] * s for c, s in zip(cols, share))) for row in p)

    many = len(p[0])
    full, _ = em(range(many), [1 / many] * many, language.ROUNDS)
    order = sorted(range(many), key=lambda c: -full[c])
    best, chosen = sum(math.log(row[order[0]]) for row in p), {order[0]: 1.0}
    for k in range(2, many + 1):
        cols = order[:k]
        start = [full[c] + 1e-6 for c in cols]
        share, score = em(cols, [s / sum(start) for s in start], language.REFINE)
        score -= language.PENALTY * (k - 1) * math.log(len(p))
        if score <= best:
            break
        best, chosen = score, dict(zip(cols, share))
    return chosen


def test_mixture_equals_plain_numbers():
    rng = np.random.default_rng(5)
    texts = []
    for mix in ([1, 0, 0], [0.6, 0.4, 0], [0.4, 0.3, 0.3], [0, 0, 1]):
        truth = rng.choice(3, size=80, p=mix)
        p = np.exp(-rng.uniform(2, 9, (80, 3)))
        p[np.arange(80), truth] = 1.0
        texts.append(p)
    texts.append(np.array([[0.5, 1.0, 0.1]]))
    mask, share = language.mixture(np.concatenate(texts).astype(np.float32), np.array([len(t) for t in texts]))
    for i, p in enumerate(texts):
        want = slow_mixture(p.tolist())
        assert set(np.flatnonzero(mask[i])) == set(want)
        for c, s in want.items():
            assert abs(share[i, c] - s) < 1e-3
        assert abs(share[i].sum() - 1) < 1e-3
    assert mask[1].sum() == 2 and mask[0].sum() == 1


def corpus():
    return [document(i, t * 8, lang) for i, (t, lang) in enumerate([(EN, "en"), (DE, "de"), (FR, "fr")] * 12)]


def test_mixed_texts(docs):
    model = language.train(docs(corpus()))
    assert model[0] == ["de", "en", "fr"]
    texts = [EN * 5, EN * 6 + DE * 3, FR + "123 !!", "", "42", "İ"]
    share = language.shares(texts, model[1])
    order = {n: i for i, n in enumerate(model[0])}
    assert share[0].argmax() == order["en"] and share[0].max() > 0.99
    assert share[1].argmax() == order["en"] and 0.5 < share[1, order["en"]] < 0.8 and 0.2 < share[1, order["de"]] < 0.5
    assert share[2].argmax() == order["fr"]
    assert not share[3].any() and not share[4].any() and share[5].any()


def test_columns_and_edges(docs):
    model = language.train(docs(corpus()))
    told, pred, score = language.identify(docs(), model)
    assert told.columns[:-2] == docs().columns and (pred, score) == ("_lang_pred", "_score")
    rows = told.select(F.col("text").alias("t"), F.col(pred).alias("p"), F.col(score).alias("s")).collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        assert (r.p == "und") == (not any(c.isalpha() for c in r.t or ""))
        assert r.s == 0 if r.p == "und" else 0 < r.s <= 1
    assert language.identify(docs([]), model)[0].count() == 0


def test_without_labels(docs):
    unlabelled = docs([document(1, EN, None), document(2, "!!", None), document(3, None, "en")])
    model = language.train(unlabelled)
    assert model[0] == []
    told, pred, score = language.identify(unlabelled, model)
    assert {(r[pred], r[score]) for r in told.collect()} == {("und", 0.0)}
    assert [r.doc_id for r in language.keep_identified(unlabelled).collect()] == [1]
    assert language.keep_identified(docs([])).count() == 0


def test_stage_keeps_plain_texts(docs):
    rows = corpus() + [document(100, EN * 3, None), document(101, None), document(102, "?!"), document(103, (EN + DE + FR) * 5)]
    out = language.keep_identified(docs(rows))
    same_columns(docs(rows), out)
    assert {r.doc_id for r in out.collect()} == set(range(36)) | {100, 103}
    strict = language.keep_identified(docs(rows), least_share=0.5)
    assert {r.doc_id for r in strict.collect()} == set(range(36)) | {100}


def test_learns_from_training_rows_only(docs):
    """Labels of held-out rows change nothing."""
    rows = corpus()
    other = [r[:2] + ("xx",) + r[3:] if zlib.crc32(str(r[0]).encode()) % 3 == 1 else r for r in rows]
    for some in (rows, other):
        frame = docs(some)
        names, table = language.train(frame.filter(~language.held_out(F.col("doc_id"))))
        assert names == ["de", "en", "fr"]


@needs_tables
def test_query_on_given_tables(spark, given):
    truth = {r.doc_id: r.lang for r in given("documents").collect()}
    got = QUERIES["op10_language_id"](spark, SF_DIR).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    unseen = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in unseen) >= 0.95 * len(unseen)
