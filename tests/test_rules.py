from datetime import datetime, timedelta

import pytest
from pyspark.sql import types as T

from postrank.functions import rules
from postrank.operators import scoring

AS_OF = datetime(2025, 2, 1)
FIELDS = {
    "title": ("Poste", "string"), "description": ("rien", "string"), "company_name": ("Atelier Nord", "string"),
    "is_junior": (False, "boolean"), "is_remote": (False, "boolean"), "exp_min_required": (None, "double"),
    "published_at": (AS_OF - timedelta(days=30), "timestamp"), "extracted_skills": ([], "array<string>"),
    "data_quality_score": (1.0, "double"), "raw_nlp_score": (0.0, "double"),
}


@pytest.fixture
def score(spark, cfg):
    def run(**changes):
        row = {name: value for name, (value, _) in FIELDS.items()} | changes
        schema = ", ".join(f"{name} {kind}" for name, (_, kind) in FIELDS.items())
        df = spark.createDataFrame([tuple(row.values())], schema)
        df = scoring.add_labels(scoring.add_rule_total(scoring.add_rule_scores(df, cfg), cfg))
        return scoring.add_final_scores(df, cfg).first()

    return run


def test_rule_names_are_the_rules(spark, cfg):
    assert list(rules.all_rules(cfg)) == list(rules.RULE_NAMES)


@pytest.mark.parametrize("changes, want", [
    ({"is_junior": True}, 30), ({"title": "Data Junior"}, 30), ({"title": "débutant accepté"}, 30),
    ({"is_junior": None}, 0), ({"title": "juniors"}, 0), ({"title": None}, 0),
])
def test_junior(score, changes, want):
    assert score(**changes)["score_junior"] == want


@pytest.mark.parametrize("title, description, want", [
    ("Directeur senior", "", -100), ("Principal Engineer", "", -100), ("Lead senior", "", -50),
    ("Analyste confirmé", "", -40), ("expert", "solide expérience", -40), ("Leader", "", 0),
    ("Poste", "plusieurs années d'expérience", -15), ("Poste", "Expérience significative", -15),
    ("experimenté", "", -40), ("expérimenté", "", 0), ("Analyste confirmée", "", 0),
])
def test_seniority(score, title, description, want):
    assert score(title=title, description=description)["score_seniority"] == want


@pytest.mark.parametrize("title, description, want", [
    ("Stage Data", "", -100), ("stages", "", 0), ("Poste", "gratification du stagiaire", -100),
    ("Poste", "gratification seule", 0), ("Apprentissage", None, -100), ("Poste", None, 0),
])
def test_internship(score, title, description, want):
    assert score(title=title, description=description)["score_veto_intern"] == want


@pytest.mark.parametrize("years, want", [(None, 0), (2.0, 0), (2.5, -20), (5.0, -20), (5.5, -50)])
def test_years(score, years, want):
    assert score(exp_min_required=years)["score_years"] == want


@pytest.mark.parametrize("company, description, want", [
    ("Banque du Lac", "", -15), ("Banques", "", 5), (None, "", 5), ("C", "notre finance", -15),
    ("C", "un comptable", -15), ("C", "une assurance auto", -15), ("C", "l'assurance de réussir", 5),
    ("C", "assurance d'être là", 5), ("C", "secteur défense", -15), ("C", "quartier la défense", 5),
    ("C", "situé à  la défense", 5), ("C", "un armement lourd", -60), ("C", "une banque et armement", -15),
    ("C", "la defense", -60), ("C", "armement en tête, collé au titre", 5), ("C", None, 5),
])
def test_ethics(score, company, description, want):
    assert score(company_name=company, description=description)["score_ethics"] == want


def test_title_and_description_join_without_a_space(score):
    assert score(title="Fin", description="ance d'entreprise")["score_ethics"] == -15
    assert score(title="Finance", description="x")["score_ethics"] == 5


@pytest.mark.parametrize("rule, description, want", [
    ("score_impact", "certifiée B Corp", 30), ("score_impact", "b-corp et climat", 30),
    ("score_impact", "écologie", 15), ("score_impact", "rien", 0), ("score_impact", None, 0),
    ("score_training", "mentorat offert", 15), ("score_training", "mentorat, encadrer juniors", 0),
    ("score_training", "pair programming; former  junior", 0), ("score_training", "formation", 0),
    ("score_os", "Open Source", 20), ("score_os", "contributeur", 20), ("score_os", "libre", 0),
    ("score_status", "un technicien", -15), ("score_status", None, 0),
])
def test_description_rules(score, rule, description, want):
    assert score(description=description)[rule] == want


@pytest.mark.parametrize("remote, want", [(True, 15), (False, 0), (None, 0)])
def test_remote(score, remote, want):
    assert score(is_remote=remote)["score_remote"] == want


@pytest.mark.parametrize("age, want", [
    (timedelta(0), 10), (timedelta(days=2, hours=23), 10), (timedelta(days=3), 0), (timedelta(days=-5), 10),
])
def test_freshness_counts_whole_days(score, age, want):
    assert score(published_at=AS_OF - age)["score_freshness"] == want


@pytest.mark.parametrize("skills, want", [
    ([], 0), (["python"], 15), (["dbt", "spark"], 15), (["dbt", "airflow"], 15), (["snowflake"], 0),
    (["aws", "S3", "Lambda"], 12), (["python", "spark", "aws", "dbt", "snowflake"], 57), (None, 0),
])
def test_skills(score, skills, want):
    assert score(extracted_skills=skills)["p_tech_skills"] == want


def test_worked_example_of_a_strong_posting(score):
    row = score(title="Data Engineer Junior", is_junior=True, is_remote=True, published_at=AS_OF,
                extracted_skills=["python", "dbt", "spark", "aws"], raw_nlp_score=60.0)
    assert row["raw_rule_score"] == 122 and row["rules_score"] == 100
    assert row["semantic_score"] == 60 and row["matching_score"] == 80
    assert row["positive_labels"] == "🌱 Junior Friendly | 🏠 Télétravail | 🚀 Stack intéressante"
    assert row["negative_labels"] == ""


def test_worked_example_of_an_internship(score):
    row = score(title="Stage Data Engineer", published_at=AS_OF - timedelta(days=10))
    assert (row["raw_rule_score"], row["rules_score"], row["matching_score"]) == (-75, 0, 0)
    assert row["negative_labels"] == "🚫 Stage/Alternance" and row["positive_labels"] == ""


def test_labels_for_seniors(score):
    row = score(title="Lead Data", is_junior=True, description="mentorat, banque", exp_min_required=4.0)
    assert row["positive_labels"] == ""
    assert row["negative_labels"] == "⚠️ Offre pour séniors | 🏦 Secteur Sensible | ⏳ > 2 ans exp."
    assert score(title="Senior")["negative_labels"] == "⚖️ Expérience requise"


@pytest.mark.parametrize("nlp, quality, want", [(120.0, 1.0, (100, 63)), (-5.0, 1.0, (0, 13)), (50.4, 0.75, (50, 28))])
def test_blend(score, nlp, quality, want):
    row = score(raw_nlp_score=nlp, data_quality_score=quality)
    assert row["raw_rule_score"] == 25
    assert (row["semantic_score"], row["matching_score"]) == want


def test_weights_can_be_replaced(spark, cfg):
    assert cfg.with_weights(remote=1).weights["remote"] == 1 and cfg.weights["remote"] == 15
    with pytest.raises(ValueError, match="unknown rule weights"):
        cfg.with_weights(nope=1)


SILVER_ROW = {
    "job_id": "1", "title": "Data Engineer Junior", "company_name": "Corp", "location_clean": "Nantes",
    "description": "python", "url": "u", "published_at": AS_OF, "source_name": "JSearch", "data_quality_score": 1.0,
    "extracted_skills": ["python"], "salary_min_numeric": 45000, "exp_min_required": None, "is_junior": True,
    "is_senior": False, "is_red_flag": False, "is_ethical": None, "is_remote": False,
    "description_vector": None, "ingestion_date": AS_OF.date(),
}


@pytest.fixture
def silver(spark):
    from postrank.schemas import SILVER

    return lambda *rows: spark.createDataFrame([tuple((SILVER_ROW | r).values()) for r in rows], SILVER)


def test_gold_takes_usable_vectors_one_row_per_url(silver, cfg):
    ones, zeros = [1.0] * 32, [0.0] * 32
    half = [1.0] * 16 + [-1.0] * 16
    rows = silver(
        {"job_id": "a", "description_vector": ones}, {"job_id": "b", "url": "v", "description_vector": zeros},
        {"job_id": "c", "url": "w", "description_vector": ones[:31]}, {"job_id": "d", "url": "x"},
        {"job_id": "e", "url": "y", "description_vector": half},
        {"job_id": "f", "description_vector": half, "published_at": AS_OF - timedelta(days=1)},
    )
    gold = {r["job_id"]: r for r in scoring.build_gold(rows, cfg, [2.0] * 32).collect()}
    assert sorted(gold) == ["a", "b", "e"]
    assert gold["a"]["raw_nlp_score"] == pytest.approx(100) and gold["a"]["semantic_score"] == 100
    assert gold["b"]["raw_nlp_score"] == 0 and gold["e"]["raw_nlp_score"] == pytest.approx(0)
    assert gold["a"]["rules_score"] == 20 + 30 + 5 + 15 + 10
    assert gold["a"]["matching_score"] == 90


def test_gold_without_a_profile_scores_by_rules_alone(silver, cfg):
    row = scoring.build_gold(silver({"description_vector": [1.0] * 32}), cfg, None).first()
    assert row["raw_nlp_score"] == 0 and row["matching_score"] == 40


def test_scoring_adds_no_shuffle_and_no_join(silver, cfg):
    rows = silver({"description_vector": [1.0] * 32})
    scored = scoring.score_postings(scoring.staging_view(rows), cfg, [1.0] * 32)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    plan = scoring.build_gold(rows, cfg, [1.0] * 32)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("LeftSemi") == 1 and plan.count("Join") == 1


def test_repeated_ids_do_not_multiply(silver, cfg):
    rows = [{"url": f"u{i}", "description_vector": [1.0] * 32} for i in range(3)]
    assert scoring.build_gold(silver(*rows), cfg, [1.0] * 32).count() == 3


def test_gold_columns(silver, cfg):
    gold = scoring.build_gold(silver({}), cfg, [1.0] * 32)
    assert tuple(gold.columns) == scoring.STAGING_COLUMNS + scoring.SCORE_COLUMNS
    assert gold.schema["rules_score"].dataType == T.IntegerType()
    assert gold.schema["matching_score"].dataType == T.DoubleType()
