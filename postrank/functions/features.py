"""Features read out of a posting by pattern."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postrank import config as C
from postrank.functions.matching import contains_any, first_number, matches
from postrank.functions.text import fold_dashes


def years_of_experience(lowered: Column, max_years: float) -> Column:
    """Years asked for in a lowered text, else months as years.

    NULL above ``max_years``. Years out of range hide months in range: the
    first kind found decides.
    """
    years = first_number(lowered, C.YEARS_PATTERN).try_cast("float")
    months = F.when(lowered.contains(C.MONTHS_NEEDLE), first_number(lowered, C.MONTHS_PATTERN))
    required = F.coalesce(years, months.try_cast("float") / 12.0)
    return F.when(required <= max_years, required)


def skill_tags(text: Column, skills) -> Column:
    """Tags found in ``text``, in the order of ``skills``."""
    tags = [F.when(matches(text, s.pattern, s.needles), F.lit(s.tag)) for s in skills]
    return F.array_distinct(F.array_compact(F.array(*tags)))


def salary_match(info: Column, description: Column) -> Column:
    """First salary-like run in the salary field or, failing that, the text."""
    run = F.coalesce(first_number(info, C.SALARY_PATTERN), first_number(description, C.SALARY_PATTERN))
    return F.regexp_replace(run, r"\s", "")


def salary_amount(match: Column, bounds: tuple[int, int]) -> Column:
    """Amount of a salary match; NULL outside ``bounds``."""
    amount = F.when(
        match.endswith("k"), F.replace(match, F.lit("k"), F.lit("")).try_cast("int") * 1000
    ).otherwise(match.try_cast("int"))
    return F.when(amount.between(*bounds), amount)


def flags(text: Column, company: Column) -> dict[str, Column]:
    """Posting flags. ``is_ethical`` is NULL for no hit and no company."""
    return {
        "is_junior": contains_any(text, C.JUNIOR_PHRASES),
        "is_senior": contains_any(text, C.SENIOR_PHRASES),
        "is_red_flag": contains_any(text, C.RED_FLAG_PHRASES),
        "is_ethical": contains_any(text, C.ETHICAL_PHRASES)
        | contains_any(F.lower(company), C.ETHICAL_PHRASES),
        "is_remote": matches(text, C.REMOTE_PATTERN, C.REMOTE_NEEDLES),
    }


def quality_weight(source: Column, weights: dict[str, float], other: float) -> Column:
    known = [F.when(source == name, F.lit(weight)) for name, weight in weights.items()]
    return F.coalesce(*known, F.lit(other))


def fingerprint(title: Column, company: Column, location: Column) -> Column:
    """Hash of what makes two postings the same job. NULL parts are skipped."""
    return F.sha2(
        F.concat_ws(
            "||",
            F.lower(fold_dashes(F.trim(title))),
            F.lower(fold_dashes(F.trim(company))),
            F.lower(F.trim(location)),
        ),
        256,
    )


def embedding_text(title: Column, description: Column, max_chars: int | None) -> Column:
    text = F.concat_ws(" ", title, description)
    return text if max_chars is None else F.substring(text, 1, max_chars)
