"""The scoring rules. Each rule is one column of points.

A rule lists its cases in order; the first that holds gives the points. The
inputs are the columns of a cleaned posting plus three lowered texts made by
:func:`lowered_texts`. A condition that is NULL counts as not met.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postrank.config import RankingConfig
from postrank.functions.matching import contains_any, matches
from postrank.functions.text import moment

# --- Fixed values: patterns and phrases of the rules, by rule ---
TITLE_JUNIOR = r"\b(junior|débutant)\b"
TITLE_DIRECTOR = r"\b(directeur|principal)\b"
TITLE_LEAD = r"\b(lead)\b"
TITLE_SENIOR = r"\b(senior|expert|confirmé|experimenté)\b"
HIDDEN_SENIORITY = (
    "expérience significative", "solide expérience", "expérience confirmée",
    "plusieurs années d'expérience",
)
TITLE_INTERNSHIP = r"\b(stage|internship|alternance|apprentissage)\b"
INTERN_PAY = r"\bgratification\b"
INTERN = r"\bstagiaire\b"
COMPANY_SECTOR = r"\b(banque|finance|assurance|mutuelle|comptable)\b"
TEXT_SECTOR = r"\b(banque|finance|mutuelle)\b"
ACCOUNTANT = r"\bcomptable\b"
INSURANCE = r"\bassurance\b"
INSURANCE_PROMISE = r"\bassurance\s+(de|que|d'être|d'avoir)\b"
DEFENCE = r"\bdéfense\b"
DEFENCE_PLACE = r"(quartier|paris|situé à|siège à)\s+la\s+défense"
ARMS = r"\b(armement|missile|defense|militaire)\b"
IMPACT_CERTIFIED = ("b corp", "b-corp", "société à mission", "économie sociale")
IMPACT_CLIMATE = ("décarbonation", "écologie", "climat")
TRAINING = ("budget formation", "mentorat", "pairing", "pair programming")
TRAINING_OTHERS = r"(encadrer|coacher|former|management|pilotage|accompagnement d[ee]s?)\s+juniors?"
OPEN_SOURCE = ("open source", "contribution", "contributeur")
TECHNICIAN = "technicien"
DBT_COMPANIONS = r"snowflake|bigquery|airflow"
CLOUD_SKILLS = ("aws", "S3", "Lambda")


def lowered_texts() -> dict[str, Column]:
    """Lowered title, description, company and title+description.

    The last has no separator and is NULL if either part is.
    """
    title, description = F.lower("title"), F.lower("description")
    return {
        "l_title": title,
        "l_desc": description,
        "l_company": F.lower("company_name"),
        "l_both": F.concat(title, description),
    }


def _first_case(*cases: tuple[Column, int], default: int = 0) -> Column:
    points = [F.when(condition, F.lit(value)) for condition, value in cases]
    return F.coalesce(*points, F.lit(default))


def experience_rules(cfg: RankingConfig) -> dict[str, Column]:
    w, title, desc = cfg.weights, F.col("l_title"), F.col("l_desc")
    years = F.col("exp_min_required")
    paid_intern = matches(desc, INTERN_PAY, ("gratification",)) & matches(desc, INTERN, ("stagiaire",))
    return {
        "score_junior": _first_case((F.col("is_junior") | matches(title, TITLE_JUNIOR), w["junior"])),
        "score_seniority": _first_case(
            (matches(title, TITLE_DIRECTOR), w["director"]),
            (matches(title, TITLE_LEAD), w["lead"]),
            (matches(title, TITLE_SENIOR), w["senior"]),
            (contains_any(desc, HIDDEN_SENIORITY), w["hidden_seniority"]),
        ),
        "score_veto_intern": _first_case((matches(title, TITLE_INTERNSHIP) | paid_intern, w["internship"])),
        "score_years": _first_case(
            (years > cfg.years_high, w["years_high"]),
            (years > cfg.years_mid, w["years_mid"]),
        ),
    }


def ethics_rules(cfg: RankingConfig) -> dict[str, Column]:
    w, desc, both = cfg.weights, F.col("l_desc"), F.col("l_both")
    insurance = matches(desc, INSURANCE, ("assurance",)) & ~matches(desc, INSURANCE_PROMISE)
    defence = matches(desc, DEFENCE, ("défense",)) & ~matches(desc, DEFENCE_PLACE)
    sector = (
        matches(both, TEXT_SECTOR, ("banque", "finance", "mutuelle"))
        | matches(desc, ACCOUNTANT, ("comptable",))
        | insurance
        | defence
    )
    arms = matches(both, ARMS, ("armement", "missile", "defense", "militaire"))
    return {
        "score_ethics": _first_case(
            (matches(F.col("l_company"), COMPANY_SECTOR), w["ethics_light"]),
            (sector, w["ethics_light"]),
            (arms, w["ethics_heavy"]),
            default=w["ethics_clear"],
        ),
        "score_impact": _first_case(
            (contains_any(desc, IMPACT_CERTIFIED), w["impact_certified"]),
            (contains_any(desc, IMPACT_CLIMATE), w["impact_climate"]),
        ),
    }


def culture_rules(cfg: RankingConfig) -> dict[str, Column]:
    w, desc = cfg.weights, F.col("l_desc")
    # "junior" is part of every match of the excluding pattern
    trains_others = matches(desc, TRAINING_OTHERS, ("junior",))
    return {
        "score_training": _first_case((contains_any(desc, TRAINING) & ~trains_others, w["training"])),
        "score_os": _first_case((contains_any(desc, OPEN_SOURCE), w["open_source"])),
        "score_status": _first_case((desc.contains(TECHNICIAN), w["technician"])),
        "score_remote": _first_case((F.col("is_remote"), w["remote"])),
    }


def freshness_rules(cfg: RankingConfig) -> dict[str, Column]:
    """Whole elapsed days count; a posting from the future is fresh."""
    age = F.timestamp_diff("DAY", F.col("published_at"), moment(cfg.as_of))
    return {"score_freshness": _first_case((age <= cfg.fresh_days, cfg.weights["fresh"]))}


def skill_rules(cfg: RankingConfig) -> dict[str, Column]:
    w, skills = cfg.weights, F.col("extracted_skills")

    def has(tag: str) -> Column:
        return F.array_contains(skills, tag)

    companions = F.array_join(skills, ",").rlike(DBT_COMPANIONS)
    cloud = F.arrays_overlap(skills, F.array(*[F.lit(s) for s in CLOUD_SKILLS]))
    return {
        "p_tech_skills": _first_case((has("python"), w["skill_python"]))
        + _first_case((has("dbt") & has("spark"), w["skill_dbt_spark"]))
        + _first_case((has("dbt") & companions, w["skill_dbt_stack"]))
        + _first_case((cloud, w["skill_cloud"])),
    }


RULE_GROUPS = (experience_rules, ethics_rules, culture_rules, freshness_rules, skill_rules)
# --- Fixed values: columns of the rules, in order ---
RULE_NAMES = (
    "score_junior", "score_seniority", "score_veto_intern", "score_years", "score_ethics", "score_impact",
    "score_training", "score_os", "score_status", "score_remote", "score_freshness", "p_tech_skills",
)


def all_rules(cfg: RankingConfig) -> dict[str, Column]:
    return {name: points for group in RULE_GROUPS for name, points in group(cfg).items()}


# --- Fixed values: label texts, in display order ---
LABEL_SEPARATOR = " | "
POSITIVE_LABELS = (
    "🌱 Junior Friendly", "🌍 Impact Positif", "🎓 Mentorat/Formation",
    "💻 Open Source", "🏠 Télétravail", "🚀 Stack intéressante",
)
NEGATIVE_LABELS = (
    "🚫 Stage/Alternance", "⚠️ Offre pour séniors", "⚖️ Expérience requise",
    "🏦 Secteur Sensible", "⏳ > 2 ans exp.",
)
STRONG_STACK = 40


def _labels(texts, conditions) -> Column:
    shown = [F.when(condition, F.lit(text)) for text, condition in zip(texts, conditions, strict=True)]
    return F.concat_ws(LABEL_SEPARATOR, *shown)


def positive_labels() -> Column:
    open_to_juniors = F.col("score_seniority") >= 0
    return _labels(POSITIVE_LABELS, (
        (F.col("score_junior") > 0) & open_to_juniors,
        F.col("score_impact") > 0,
        (F.col("score_training") > 0) & open_to_juniors,
        F.col("score_os") > 0,
        F.col("score_remote") > 0,
        F.col("p_tech_skills") > STRONG_STACK,
    ))


def negative_labels() -> Column:
    seniority = F.col("score_seniority")
    return _labels(NEGATIVE_LABELS, (
        F.col("score_veto_intern") < 0,
        seniority <= -50,
        seniority.between(-49, -15),
        F.col("score_ethics") < 0,
        F.col("score_years") < 0,
    ))
