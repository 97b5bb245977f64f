"""Transcript credits to semesters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import mark_above_zero, subject_key, text_after, text_before
from ..rules import DEFAULT_RULES, Rules, key, keys
from .checks import Checks
from .joins import lookup_join
from .keyed import NO_CHECKS

# Column names of the dual courses' counters.
DUAL_COUNTERS = (
    "primaryComplete",
    "primaryInProgress",
    "secondaryComplete",
    "secondaryInProgress",
    "overflowComplete",
    "overflowInProgress",
    "semsCompleteGS",
    "semsInProgressGS",
)


def with_key(rows: DataFrame) -> DataFrame:
    """Add ``subj_key`` once; the conditions below and all later steps read it."""
    if "subj_key" in rows.columns:
        return rows
    return rows.withColumn("subj_key", subject_key("subject"))


def any_grade_subject(rules: Rules = DEFAULT_RULES) -> Column:
    return F.col("subj_key").isin(keys(rules.any_grade_subjects))


def taken_late() -> Column:
    """Taken after grade 8, or in the summer term of grade 8."""
    grade, term = F.col("studentGrade"), F.col("semester")
    return (grade > 8) | ((grade == 8) & (term == 3))


def high_school_only(rules: Rules = DEFAULT_RULES) -> Column:
    return taken_late() & ~any_grade_subject(rules)


def _credits(condition: Column, credits: str) -> Column:
    """Sum of credits on rows that meet the condition; 0 when there are none."""
    amount = F.sum(F.when(condition, F.col(credits)))
    return F.coalesce(amount, F.lit(0))


def _semesters(credits: Column | str, rules: Rules) -> Column:
    return F.floor(F.sum(credits) / rules.credits_per_semester).cast("bigint")


def _vocabulary(reqs: DataFrame, rules: Rules) -> DataFrame:
    full = reqs.filter(F.col("semester") == rules.full_semester)
    return full.select(subject_key("subject").alias("subj_key")).distinct()


def _flag_required(rows: DataFrame, reqs: DataFrame, rules: Rules, small: bool) -> DataFrame:
    """Add ``required``: true where some cohort requires the subject."""
    vocabulary = _vocabulary(reqs, rules).withColumn("required", F.lit(True))
    keyed, spread_by = with_key(rows), ["studentID", "subject"]
    found = lookup_join(keyed, vocabulary, ["subj_key"], small, spread_by, "left")
    return found.select(*keyed.columns, "required")


def relevant_courses(rows: DataFrame, reqs: DataFrame, rules: Rules, small: bool) -> DataFrame:
    """Drop rows that can reach no ledger: neither required, donor nor dual."""
    needed = (
        F.col("required").isNotNull()
        | (F.col("subj_key") == key(rules.donor))
        | F.col("subject").contains(rules.dual_separator)
    )
    return _flag_required(rows, reqs, rules, small).filter(needed).drop("required")


def ledger_courses(rows: DataFrame, reqs: DataFrame, rules: Rules, small: bool) -> DataFrame:
    """Only courses that some cohort requires, and the donor, so few per student.

    ``required`` tells the former from a donor that no cohort requires.
    """
    flagged = _flag_required(rows, reqs, rules, small)
    required = F.col("required").isNotNull()
    kept = flagged.withColumn("required", required)
    return kept.filter(F.col("required") | (F.col("subj_key") == key(rules.donor)))


def course_sums(transcript: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Every credit sum any later step needs, in one pass over the transcript.

    One row per student and subject as spelled.  Partial sums are taken before
    the shuffle, so a student or course with very many rows arrives as a few.
    """
    passed = mark_above_zero(F.col("mark"), transcript.schema["mark"].dataType)
    flagged = with_key(transcript).select(
        "studentID",
        "subject",
        "earnedCredits",
        "attemptedCredits",
        (any_grade_subject(rules) | taken_late()).alias("counted"),
        F.col("mark").isNull().alias("running"),
        passed.alias("passed"),
    )
    counted, running, passed = F.col("counted"), F.col("running"), F.col("passed")
    finished = ~running
    sums = flagged.groupBy("studentID", "subject").agg(
        F.count(F.when(counted, 1)).alias("countedRows"),
        _credits(counted & finished, "earnedCredits").alias("countedDone"),
        _credits(counted & running, "attemptedCredits").alias("countedOpen"),
        _credits(finished, "earnedCredits").alias("anyDone"),
        _credits(running, "attemptedCredits").alias("anyOpen"),
        _credits(passed, "earnedCredits").alias("passedDone"),
    )
    return with_key(sums)


def _by_subject(sums: DataFrame, done: str, open_: str, rules: Rules) -> DataFrame:
    return sums.groupBy("studentID", "subj_key").agg(
        F.min("subject").alias("subject"),
        _semesters(done, rules).alias("semsComp"),
        _semesters(open_, rules).alias("semsInp"),
    )


def credits_to_semesters(
    transcript: DataFrame, where: Column | None = None, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Completed and in-progress semesters per student and subject."""
    rows = with_key(transcript)
    rows = rows if where is None else rows.filter(where)
    return _by_subject(course_sums(rows, rules), "anyDone", "anyOpen", rules)


def counted_semesters(sums: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Semesters under the grade rule of each subject, from the one-pass sums."""
    rows = sums.filter((F.col("countedRows") > 0) & F.col("subject").isNotNull())
    return _by_subject(rows, "countedDone", "countedOpen", rules)


def donor_semesters(sums: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Semesters of the donor subject, whatever the grade."""
    rows = sums.filter(F.col("subj_key") == key(rules.donor))
    return rows.groupBy("studentID").agg(
        _semesters("anyDone", rules).alias("semsComp"),
        _semesters("anyOpen", rules).alias("semsInp"),
    )


def student_semesters(sums: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per student: counted semesters by subject, and the donor's.

    Counts and donor come from one grouping, on rows that move to their student
    once.  ``sums`` holds required and donor courses only, which bounds the map.
    """
    counted = (F.col("countedRows") > 0) & F.col("subject").isNotNull()
    is_donor = F.col("subj_key") == key(rules.donor)
    per_subject = sums.groupBy("studentID", "subj_key").agg(
        F.count(F.when(counted & F.col("required"), 1)).alias("counts"),
        *[
            _semesters(F.when(counted, F.col(c)), rules).alias(c)
            for c in ("countedDone", "countedOpen")
        ],
        *[_semesters(c, rules).alias(c) for c in ("anyDone", "anyOpen")],
    )
    of_subject = F.struct(F.col("countedDone").alias("semsComp"), F.col("countedOpen").alias("semsInp"))
    entry = F.when(F.col("counts") > 0, F.struct("subj_key", of_subject))
    return per_subject.groupBy("studentID").agg(
        F.map_from_entries(F.collect_list(entry)).alias("counts"),
        F.max(F.when(is_donor, F.col("anyDone"))).alias("donorDone"),
        F.max(F.when(is_donor, F.col("anyOpen"))).alias("donorOpen"),
    )


def count_semesters(
    ledger: DataFrame, semesters: DataFrame, checks: Checks = NO_CHECKS
) -> DataFrame:
    """The ledger with its counts, and the student's donor semesters beside them."""
    found = F.try_element_at("counts", F.col("subj_key"))
    semesters = checks.sum(semesters, subjects_counted=F.size("counts"))
    joined = ledger.join(semesters, "studentID", "left")
    joined = checks.count(joined, ledger_rows_counted=found.isNotNull())
    changed = {
        "semsComplete": F.coalesce(found["semsComp"], F.col("semsComplete")),
        "semsInProgress": F.coalesce(found["semsInp"], F.col("semsInProgress")),
    }
    return joined.select(
        *[changed.get(c, F.col(c)).alias(c) for c in ledger.columns], "donorDone", "donorOpen"
    )


def dual_rows(sums: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return sums.filter(F.col("subject").contains(rules.dual_separator))


def split_dual_courses(sums: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Courses that count for two subjects, with their allocation counters at zero.

    Unlike a plain course, a finished dual course counts only with a mark above 0.
    """
    separator = rules.dual_separator
    rows = _by_subject(dual_rows(sums, rules), "passedDone", "anyOpen", rules)
    return rows.select(
        "studentID",
        "subj_key",
        "subject",
        text_before(F.col("subj_key"), separator).alias("primary_key"),
        text_after(F.col("subj_key"), separator).alias("secondary_key"),
        text_before(F.col("subject"), separator).alias("primarySubj"),
        text_after(F.col("subject"), separator).alias("secondarySubj"),
        F.col("semsComp").alias("semsComplete"),
        F.col("semsInp").alias("semsInProgress"),
        *[F.lit(0).cast("bigint").alias(name) for name in DUAL_COUNTERS],
    )
