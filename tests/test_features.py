import random

import pytest
from pyspark.sql import functions as F

from postrank import config as C
from postrank.functions import features
from postrank.functions.matching import contains_any, letters_bounded, matches


@pytest.mark.parametrize("text, want", [
    ("3 ans d'expérience", 3), ("5 années minimum", 5), ("2 ans", 2), ("pas d'expérience", None),
    ("6 mois", 0.5), ("12 mois", 1), ("1 an", 1), ("18 mois puis 2 ans", 2), ("20 ans, 6 mois", None),
    ("15 ans", 15), ("16 ans", None), ("3 analystes", 3), ("99999999999999999999999 ans", None), (None, None),
    ("7 annees", 7), ("190 mois", None),
])
def test_experience(values, text, want):
    assert values(lambda x: features.years_of_experience(x, 15).cast("double"), [text]) == [want]


@pytest.mark.parametrize("info, text, want", [
    ("45k", "", 45000), ("45 000 - 50 000", None, 45000), ("45000", "", 45000), ("12000", "30000", None),
    (None, "salaire 38k brut", 38000), ("100000", "", None), ("45K", "", None), ("1000", "", None),
    ("45K", "ou 52000", 52000), (None, None, None), ("24999", "", None), ("25000", "", 25000),
    ("45\xa0000", "", None), ("", "entre 40 000 et 45 000", 40000),
])
def test_salary(spark, info, text, want):
    df = spark.createDataFrame([(info, text)], "i string, d string")
    df = df.select(features.salary_match(F.col("i"), F.col("d")).alias("m"))
    assert df.select(features.salary_amount(F.col("m"), (25000, 180000))).first()[0] == want


def test_salary_pattern_equals_its_spelled_out_form(spark):
    """Searching two fields in turn is searching them joined."""
    rng = random.Random(5)
    pieces = ["1", "23", "456", "k", " ", "  ", "|", "K", "x", "45", "000", "-"]
    rows = [tuple("".join(rng.choices(pieces, k=rng.randint(0, 7))) if rng.random() > 0.1 else None for _ in "ab")
            for _ in range(3000)]
    df = spark.createDataFrame(rows, "i string, d string")
    joined = F.regexp_extract(F.concat_ws(" | ", "i", "d"), r"(\d{2}\s?\d{3}|\d{2}k|\d{5})", 1)
    want = F.regexp_replace(joined, r"\s", "")
    got = F.coalesce(features.salary_match(F.col("i"), F.col("d")), F.lit(""))
    assert df.filter(~got.eqNullSafe(want)).count() == 0


def flag(values, name, items):
    return values(lambda x: features.flags(F.lower(x), F.lit("Atelier Nord"))[name], items)


@pytest.mark.parametrize("name, hits, misses", [
    ("is_red_flag", ["Offre de stage en Data", "Contrat alternance", "Poste technicien"], ["Data Engineer junior"]),
    ("is_junior", ["Data Engineer junior", "débutant accepté", "jeune diplômé en Data"], ["senior data engineer"]),
    ("is_senior", ["senior data engineer", "expert en data", "lead data", "data confirmé"], ["junior data"]),
    ("is_ethical", ["entreprise à impact", "environnement", "coopérative", "adresse"], ["banque finance"]),
    ("is_remote", ["télétravail partiel", "remote friendly", "full remote", "home office", "homeoffice",
                   "en distanciel"], ["présentiel", "home  office"]),
])
def test_flags(values, name, hits, misses):
    assert flag(values, name, hits) == [True] * len(hits)
    assert flag(values, name, misses) == [False] * len(misses)


def test_ethical_flag_has_three_values(spark):
    rows = [("rien", None, None), ("impact", None, True), ("rien", "SCOP Verte", True), ("rien", "Autre", False)]
    df = spark.createDataFrame(rows, "t string, c string, want boolean")
    got = df.select(features.flags(F.col("t"), F.col("c"))["is_ethical"], "want").collect()
    assert all(r[0] == r[1] for r in got)


def test_skills_in_list_order(values):
    text = "we use s3, spark and python on aws lambda with fastapi; github actions; architecture médaillon"
    got = values(lambda x: features.skill_tags(x, C.SKILLS), [text, "pythonique scalable", "", None])
    assert got == [
        ["python", "spark", "aws", "S3", "Lambda", "fastapi", "github_actions", "architecture_medaillon"], [], [], [],
    ]


def test_needles_never_change_a_match(spark):
    """The cheap pre-test must be implied by the pattern it guards."""
    rng = random.Random(7)
    patterns = [(s.pattern, s.needles) for s in C.SKILLS] + [(C.REMOTE_PATTERN, C.REMOTE_NEEDLES)]
    words = sorted({n for _, needles in patterns for n in needles})
    words += ["pyspark", "amazon", "web", "services", "fast", "api", "actions", "ci/cd", "integration", "delivery", "medallion",
              "médaillon", "transform", "load", "extract", "full", "office", "k8s", "é", "x"]
    texts = ["".join(rng.choice(words) + rng.choice(["", " ", ", ", "é", "_", "\xa0"]) for _ in range(6))
             for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    differs = [matches(F.col("t"), p, n) != F.col("t").rlike(letters_bounded(p)) for p, n in patterns]
    counts = df.select(*[F.count_if(d).alias(f"d{i}") for i, d in enumerate(differs)]).first()
    assert sum(counts) == 0
    hits = df.select(*[F.count_if(matches(F.col("t"), p, n)).alias(f"h{i}") for i, (p, n) in enumerate(patterns)])
    assert min(hits.first()) > 0


def test_boundary_knows_accents(values):
    at_edge = lambda x: matches(x, r"\b(confirmé)\b")
    assert values(at_edge, ["confirmé", "profil confirmé.", "confirmée", "éconfirmé"]) == [True, True, False, False]


def test_contains_any_keeps_null(values):
    assert values(lambda x: contains_any(x, ("a", "b")), ["xa", "c", None]) == [True, False, None]


def test_quality_weight(values, cfg):
    weigh = lambda x: features.quality_weight(x, cfg.source_quality, cfg.other_source_quality)
    names = ["France Travail", "JSearch", "Adzuna", "Jooble", "Other", None]
    assert values(weigh, names) == [1.0, 1.0, 0.75, 0.75, 0.8, 0.8]


def test_fingerprint(spark):
    rows = [
        ("Dev – A ", "Corp", "Nantes"), ("dev - a", "CORP", " nantes"), ("dev - a", None, "nantes"),
        ("dev - a", "nantes", None), ("other", "corp", "nantes"),
    ]
    df = spark.createDataFrame(rows, "t string, c string, l string")
    f = [r[0] for r in df.select(features.fingerprint(F.col("t"), F.col("c"), F.col("l"))).collect()]
    assert f[0] == f[1] and f[2] == f[3] and len(set(f)) == 3 and len(f[0]) == 64


def test_embedding_text(spark):
    df = spark.createDataFrame([("é" * 10, "b" * 2000)], "t string, d string")
    cut = df.select(features.embedding_text(F.col("t"), F.col("d"), 1000)).first()[0]  # only if asked for
    whole = df.select(features.embedding_text(F.col("t"), F.col("d"), None)).first()[0]
    assert len(cut) == 1000 and cut.startswith("é" * 10 + " b") and len(whole) == 2011


def test_hashed_embedding_holds_one_chunk_of_words_at_a_time():
    """Long texts in a batch cost Python a few numbers a word of one chunk, with the same vectors."""
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from postrank.functions.embedding import _scatter

    rng = np.random.default_rng(0)
    lists = [rng.integers(0, 2**32, size=n).tolist() for n in (0, 3, 200_000, 50_000, 7)] + [None]
    hashes = pa.array(lists, pa.list_(pa.int64()))
    tracemalloc.start()
    got = _scatter(hashes, 32, chunk=4096).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1_000_000
    for words, vector in zip(lists, got):
        a = np.array(words or [], dtype="int64")
        counts = np.bincount((a >> 1) % 32, weights=1.0 - 2.0 * (a & 1), minlength=32)
        norm = np.sqrt((counts * counts).sum())
        assert vector == (counts / norm if norm else counts).astype("float32").tolist()
