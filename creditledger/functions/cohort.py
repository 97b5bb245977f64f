"""School-year arithmetic and the years a cohort text names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

LONGEST_YEAR_TEXT = 11  # sign and digits of a 32-bit integer


def expected_grad_year(grade: Column, curr_grad_year: int) -> Column:
    """Year text, empty for a NULL grade.

    Never NULL, so that no not-null filter of one lookup moves below the shuffle
    of the students and keeps the other lookup from sharing it.
    """
    return F.coalesce((F.lit(curr_grad_year) + F.lit(12) - grade).cast("string"), F.lit(""))


def has_dated_semester(grade: Column) -> Column:
    """Grades 9 to 12 look up their own cohort; a NULL grade does not."""
    return F.coalesce(grade.between(9, 12), F.lit(False))


def current_semester(grade: Column, mid_year: int) -> Column:
    dated = F.when(has_dated_semester(grade), (grade - 9) * 2 + 1 + mid_year)
    return F.coalesce(dated, F.lit(1))


def grad_year_of_semester(semester: Column, curr_grad_year: int) -> Column:
    return (F.lit(curr_grad_year) - (F.ceil(semester / 2) - 4)).cast("int").cast("string")


def ledger_years(curr_grad_year: int) -> list[str]:
    """What ``grad_year_of_semester`` gives for the semesters of a ledger: -1, and 1 to 8."""
    return [str(curr_grad_year + ahead) for ahead in range(5)]


def _texts(years: Sequence[str]) -> Column:
    return F.array(*[F.lit(y) for y in years]).cast("array<string>")


def named_years(cohort: Column, match: str, years: Sequence[str] | None = None) -> Column:
    """Array of the distinct year texts that ``cohort`` names; of ``years`` alone, if given.

    With ``contains`` these are all its substrings that read as an integer, so
    an equality join on the year finds exactly the cohorts whose text contains
    it.  With ``token`` only whole numbers count; the dash of a range is no sign.
    """
    if match == "token":
        found = F.array_distinct(F.regexp_extract_all(cohort, F.lit(r"[0-9]+"), F.lit(0)))
        return found if years is None else F.array_intersect(found, _texts(years))
    if years is not None:
        return F.filter(_texts(years), lambda year: F.contains(cohort, year))
    starts = F.when(F.length(cohort) > 0, F.sequence(F.lit(1), F.length(cohort)))
    lengths = F.sequence(F.lit(1), F.lit(LONGEST_YEAR_TEXT))
    pieces = F.flatten(
        F.transform(starts, lambda s: F.transform(lengths, lambda n: F.substring(cohort, s, n)))
    )
    return F.array_distinct(F.filter(pieces, lambda p: p.rlike(r"^-?[0-9]+$")))
