"""Who must do what: ledger rows and the requirement of the current semester."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cohort import (
    current_semester,
    expected_grad_year,
    has_dated_semester,
    named_years,
)
from ..functions.text import subject_key
from ..rules import DEFAULT_RULES, Rules, keys
from .joins import lookup_join, requirements_are_small
from .keyed import parted, refusing

ANY_COHORT = "any"
#: More different years than this, from unusual grades, are not looked for one by one.
MOST_YEARS = 256
# Why a student is set aside.
SEVERAL_FULL = "a subject has several full requirements"
SEVERAL_CURRENT = "a subject has several current requirements"


def _small(reqs: DataFrame, small: bool | None, years: Sequence[str] | None) -> bool:
    return requirements_are_small(reqs, years) if small is None else small


def asked_years(students: DataFrame, curr_grad_year: int) -> list[str] | None:
    """The year texts that the students' grades ask for, a dozen; ``None`` for over MOST_YEARS.

    One aggregate over the grades, of which at most ``MOST_YEARS`` + 1 rows reach the driver.
    """
    year = expected_grad_year(F.col("grade"), curr_grad_year).alias("year")
    found = students.select(year).distinct().limit(MOST_YEARS + 1).collect()
    return sorted(r.year for r in found if r.year) if len(found) <= MOST_YEARS else None


def cohort_rows(
    reqs: DataFrame, rules: Rules = DEFAULT_RULES, years: Sequence[str] | None = None
) -> DataFrame:
    """One row per requirement and year its cohort text names.

    Turns "cohort text contains the year" into an equality on ``year``, worked
    out on the small table instead of once per student.  Where the ``years`` that
    are asked for are known, there are at most requirements times years of them.
    """
    named = named_years(F.col("gradYear"), rules.cohort_match, years)
    return reqs.select(
        F.explode(named).alias("year"),
        "semester",
        "subject",
        subject_key("subject").alias("subj_key"),
        "semsReqd",
        "semsClose",
    )


def by_student(students: DataFrame) -> DataFrame:
    """One row per student and grade, hashed on studentID.

    Grades are gathered as sets before they move, so that a student listed very
    often, or with several grades, is one row for each map task.
    """
    known = students.filter(F.col("studentID").isNotNull())
    sets = known.groupBy("studentID").agg(F.collect_set(F.struct("grade")).alias("grades"))
    return sets.select("studentID", F.inline("grades"))


def _full_rows(reqs: DataFrame, rules: Rules, years: Sequence[str] | None) -> DataFrame:
    full = cohort_rows(reqs.filter(F.col("semester") == rules.full_semester), rules, years)
    return full.filter(~F.col("subj_key").isin(keys(rules.seed_excluded)))


def _seeded(rows: DataFrame, totals: Column, rules: Rules) -> DataFrame:
    """Settle the different full requirements ``totals`` of a ledger row: one row each, or one."""
    if rules.duplicate_seed == "error":
        message = "a subject has two full requirements for one student"
        rows = refusing(rows, F.size(totals) > 1, message)
    if rules.duplicate_seed == "max":
        totals = F.array(F.array_max(totals))
    each = rows.withColumn("_total", F.explode(totals))
    return each.withColumn("semsReqdTotal", F.col("_total.semsReqd").cast("int")).drop("_total")


def _ledger_rows(rows: DataFrame, found: dict[str, Column]) -> DataFrame:
    """Ledger rows without semesters; ``found`` fills in the current requirement."""
    return rows.select(
        "studentID",
        found.get("semester", F.lit(-1)).alias("semester"),
        "subject",
        "subj_key",
        F.lit(0).cast("bigint").alias("semsComplete"),
        F.lit(0).cast("bigint").alias("semsInProgress"),
        found.get("semsReqdGrade", F.lit(0)).alias("semsReqdGrade"),
        found.get("semsClose", F.lit(0)).alias("semsClose"),
        "semsReqdTotal",
    )


def seed_ledger(
    students: DataFrame,
    reqs: DataFrame,
    curr_grad_year: int,
    rules: Rules = DEFAULT_RULES,
    small: bool | None = None,
    years: Sequence[str] | None = None,
) -> DataFrame:
    """A zero row per student and subject of the student's full requirement."""
    full = (
        _full_rows(reqs, rules, years)
        .groupBy("year", "subj_key", "semsReqd")
        .agg(F.min("subject").alias("subject"))
    )
    year = expected_grad_year(F.col("grade"), curr_grad_year)
    due = students.select("studentID", year.alias("year"))
    rows = (
        lookup_join(due, full, ["year"], _small(reqs, small, years), ["studentID"])
        .groupBy("studentID", "subj_key")
        .agg(
            F.min("subject").alias("subject"), F.collect_set(F.struct("semsReqd")).alias("totals")
        )
    )
    if rules.duplicate_seed == "set_aside":
        rows, _ = parted(rows, F.when(F.size("totals") > 1, SEVERAL_FULL), ["studentID"])
    return _ledger_rows(_seeded(rows, F.col("totals"), rules), {})


def _current_rows(reqs: DataFrame, rules: Rules, years: Sequence[str] | None) -> DataFrame:
    """Requirement rows by (semester, cohort), a cohort being a year or any."""
    fields = ["semester", "subject", "subj_key", "semsReqd", "semsClose"]
    own = cohort_rows(reqs, rules, years)
    first = reqs.filter(F.col("semester") == 1).withColumn("subj_key", subject_key("subject"))
    return own.select(F.col("year").alias("cohort"), *fields).unionByName(
        first.select(F.lit(ANY_COHORT).alias("cohort"), *fields)
    )


def requirements_by_grade(
    students: DataFrame,
    reqs: DataFrame,
    curr_grad_year: int,
    mid_year: int,
    rules: Rules = DEFAULT_RULES,
    small: bool | None = None,
    years: Sequence[str] | None = None,
) -> DataFrame:
    """Requirement rows of each student's current semester.

    Grades 9 to 12 use their own cohort; all others use the first semester of
    every cohort, hence several rows per subject are possible.
    """
    grade = F.col("grade")
    wanted = students.select(
        "studentID",
        current_semester(grade, mid_year).alias("semester"),
        F.when(has_dated_semester(grade), expected_grad_year(grade, curr_grad_year))
        .otherwise(ANY_COHORT)
        .alias("cohort"),
    )
    lookup = _current_rows(reqs, rules, years)
    found = lookup_join(
        wanted, lookup, ["semester", "cohort"], _small(reqs, small, years), ["studentID"]
    )
    return found.select("studentID", "semester", "subject", "subj_key", "semsReqd", "semsClose")


def found_requirements(
    students: DataFrame,
    reqs: DataFrame,
    curr_grad_year: int,
    mid_year: int,
    rules: Rules = DEFAULT_RULES,
    small: bool | None = None,
    years: Sequence[str] | None = None,
) -> DataFrame:
    """Per student and subject the different full requirements, least and largest current one.

    A student's grades ask for full requirements by year and for current ones by
    semester and cohort.  Both kinds are one lookup on one key, so that a student
    moves once and the answers are grouped where they arise.
    """
    year = F.concat(F.lit("full "), "year").alias("ask")
    total = F.struct("semsReqd").alias("total")
    full = _full_rows(reqs, rules, years).select(
        year, "subj_key", "subject", total, F.lit(None).alias("now")
    )
    now = F.struct("semester", "semsReqd", "semsClose").alias("now")
    at = F.concat(F.lit("now "), F.col("semester").cast("string"), F.lit(" "), "cohort")
    current = _current_rows(reqs, rules, years).select(
        at.alias("ask"), "subj_key", F.lit(None).alias("subject"), F.lit(None).alias("total"), now
    )
    lookup = full.unionByName(current)
    grade = F.col("grade")
    own_year = expected_grad_year(grade, curr_grad_year)
    cohort = F.when(has_dated_semester(grade), own_year).otherwise(ANY_COHORT)
    semester = current_semester(grade, mid_year).cast("string")
    asks = F.array(
        F.concat(F.lit("full "), own_year), F.concat(F.lit("now "), semester, F.lit(" "), cohort)
    )
    asking = students.select("studentID", F.explode(asks).alias("ask"))
    return (
        lookup_join(asking, lookup, ["ask"], _small(reqs, small, years), ["studentID"])
        .groupBy("studentID", "subj_key")
        .agg(
            F.min("subject").alias("subject"),
            F.collect_set("total").alias("totals"),
            F.min("now").alias("now"),
            F.max("now").alias("last"),
        )
        .filter(F.size("totals") > 0)
    )


def clashes(rules: Rules | None = None) -> Column:
    """Why a found requirement is no single one; NULL where it is, or where ``rules`` settle it."""
    several_full = F.size("totals") > 1
    several_current = F.col("now") != F.col("last")
    if rules is not None:
        several_full = several_full & F.lit(rules.duplicate_seed == "set_aside")
        several_current = several_current & F.lit(rules.current_match == "set_aside")
    return F.when(several_full, SEVERAL_FULL).when(several_current, SEVERAL_CURRENT)


def refused_students(found: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The students set aside: a row for each subject that is in the way, and why."""
    _, refused = parted(found, clashes(rules), ["studentID"])
    return refused.select("studentID", "subject", F.col("_problem").alias("reason"))


def ledger_requirements(
    students: DataFrame,
    reqs: DataFrame,
    curr_grad_year: int,
    mid_year: int,
    rules: Rules = DEFAULT_RULES,
    small: bool | None = None,
    years: Sequence[str] | None = None,
) -> DataFrame:
    """Ledger rows with their current requirement; 0 and semester -1 where there is none."""
    found = found_requirements(students, reqs, curr_grad_year, mid_year, rules, small, years)
    return settled_requirements(found, rules)


def settled_requirements(rows: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Ledger rows from what was found, several requirements settled as ``rules`` say."""
    if "set_aside" in (rules.duplicate_seed, rules.current_match):
        rows, _ = parted(rows, clashes(rules), ["studentID"])
    if rules.current_match == "error":
        message = "several current requirements match one ledger row"
        rows = refusing(rows, F.col("now") != F.col("last"), message)
    found = F.col("now")
    current = {
        "semester": F.coalesce(found["semester"], F.lit(-1)),
        "semsReqdGrade": F.when(found.isNotNull(), found["semsReqd"]).otherwise(0),
        "semsClose": F.when(found.isNotNull(), found["semsClose"]).otherwise(0),
    }
    return _ledger_rows(_seeded(rows, F.col("totals"), rules), current)
