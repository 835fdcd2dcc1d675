"""Settings of the ranking job: word lists, patterns, weights, thresholds.

Everything the operators read is a field of :class:`RankingConfig`, so a
caller changes a weight or adds a skill without touching an operator.
``as_of`` stands for "now" everywhere; no operator asks the clock.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from datetime import datetime
from typing import NamedTuple


class Skill(NamedTuple):
    """A skill tag, the pattern that finds it and the substrings it needs.

    ``needles`` is a cheap pre-test: a text holding none of them cannot match
    ``pattern``. An empty tuple means the pattern is always tried.
    """

    tag: str
    pattern: str
    needles: tuple[str, ...] = ()


# --- Fixed values: names of the sources, in order ---
ADZUNA = "Adzuna"
FRANCE_TRAVAIL = "France Travail"
JOOBLE = "Jooble"
JSEARCH = "JSearch"
SOURCE_NAMES = (ADZUNA, FRANCE_TRAVAIL, JOOBLE, JSEARCH)

# --- Fixed values: skill tags and their patterns, in tag order ---
SKILLS = (
    Skill("python", r"\bpython\b", ("python",)),
    Skill("sql", r"\bsql\b", ("sql",)),
    Skill("pyspark", r"\bpyspark\b", ("spark",)),
    Skill("scala", r"\bscala\b", ("scala",)),
    Skill("spark", r"\bspark\b", ("spark",)),
    Skill("aws", r"\baws\b|amazon\s?web\s?services", ("aws", "amazon")),
    Skill("S3", r"\bs3\b|amazon\s?s3", ("s3",)),
    Skill("Lambda", r"\blambda\b", ("lambda",)),
    Skill("ECR", r"\becr\b", ("ecr",)),
    Skill("Athena", r"\bathena\b", ("athena",)),
    Skill("dbt", r"\bdbt\b", ("dbt",)),
    Skill("snowflake", r"\bsnowflake\b", ("snowflake",)),
    Skill("airflow", r"\bairflow\b", ("airflow",)),
    Skill("pandas", r"\bpandas\b", ("pandas",)),
    Skill("streamlit", r"\bstreamlit\b", ("streamlit",)),
    Skill("fastapi", r"\bfastapi|fast\s?api\b", ("fast",)),
    Skill("git", r"\bgit\b", ("git",)),
    Skill("github_actions", r"github\s?actions", ("github",)),
    Skill("cicd", r"ci/cd|continuous\s?integration|continuous\s?delivery", ("ci/cd", "continuous")),
    Skill("docker", r"\bdocker\b", ("docker",)),
    Skill("kubernetes", r"kubernetes|\bk8s\b", ("kubernetes", "k8s")),
    Skill("terraform", r"\bterraform\b", ("terraform",)),
    Skill("architecture_medaillon", r"architecture\s?m[ée]daillon|medallion\s?architecture", ("architecture",)),
    Skill("etl", r"\betl\b|extract\s?transform\s?load", ("etl", "extract")),
    Skill("elt", r"\belt\b|extract\s?load\s?transform", ("elt", "extract")),
)

# --- Fixed values: phrases behind the posting flags ---
JUNIOR_PHRASES = ("junior", "débutant", "jeune diplômé")
SENIOR_PHRASES = ("senior", "expert", "lead", "confirmé")
RED_FLAG_PHRASES = ("alternance", "stage", "support", "technicien", "helpdesk")
ETHICAL_PHRASES = ("impact", "green", "environnement", "transition", "coopérative", "scic", "scop", "ess")
REMOTE_PATTERN = r"télétravail|remote|home\s?office|full\s?remote|distanciel"
REMOTE_NEEDLES = ("télétravail", "remote", "home", "distanciel")

# --- Fixed values: patterns for numbers in the text ---
YEARS_PATTERN = r"(\d+)\s*(?:ans?|ann[ée]es?)(?:\s*d['\s]exp[ée]rience|\s*de\s*pratique|\s*minimum)?"
MONTHS_PATTERN = r"(\d+)\s*mois"
MONTHS_NEEDLE = "mois"
SALARY_PATTERN = r"(\d{2}\s?\d{3}|\d{2}k|\d{5})"

# --- Fixed values: trust in each source, and in any other ---
SOURCE_QUALITY = {FRANCE_TRAVAIL: 1.0, JSEARCH: 1.0, ADZUNA: 0.75, JOOBLE: 0.75}
OTHER_SOURCE_QUALITY = 0.8

# --- Fixed values: points of each scoring rule ---
WEIGHTS = {
    "base": 20,
    "junior": 30,
    "director": -100,
    "lead": -50,
    "senior": -40,
    "hidden_seniority": -15,
    "internship": -100,
    "years_high": -50,
    "years_mid": -20,
    "ethics_light": -15,
    "ethics_heavy": -60,
    "ethics_clear": 5,
    "impact_certified": 30,
    "impact_climate": 15,
    "training": 15,
    "open_source": 20,
    "technician": -15,
    "remote": 15,
    "fresh": 10,
    "skill_python": 15,
    "skill_dbt_spark": 15,
    "skill_dbt_stack": 15,
    "skill_cloud": 12,
}


@dataclass(frozen=True)
class RankingConfig:
    """All parameters of one run."""

    as_of: str | datetime
    """The moment the run counts as "now"; text is read in the session zone."""

    vector_dim: int = 384
    skills: tuple[Skill, ...] = SKILLS
    weights: dict[str, int] = field(default_factory=lambda: dict(WEIGHTS))
    source_quality: dict[str, float] = field(default_factory=lambda: dict(SOURCE_QUALITY))
    other_source_quality: float = OTHER_SOURCE_QUALITY
    ellipsis_sources: tuple[str, ...] = (ADZUNA, JOOBLE)
    max_years: float = 15
    salary_range: tuple[int, int] = (25000, 180000)
    years_high: float = 5
    years_mid: float = 2
    fresh_days: int = 2
    embedding_chars: int | None = None
    """Embed only a prefix of this length; by default the whole text is embedded."""

    relevance_threshold: float = 40
    rules_share: float = 0.5

    def with_weights(self, **points: int) -> "RankingConfig":
        """A copy with some rule points replaced; unknown names are refused."""
        unknown = sorted(set(points) - set(self.weights))
        if unknown:
            raise ValueError(f"unknown rule weights: {unknown}")
        return replace(self, weights={**self.weights, **points})
