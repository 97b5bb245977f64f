"""Grading subjects and students: 2 on track, 1 close, 0 off track."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cohort import grad_year_of_semester
from ..rules import DEFAULT_RULES, Rules, keys
from .joins import lookup_join, requirements_are_small, spread_join
from .keyed import update_from
from .requirements import cohort_rows

# The texts written to the status tables.
LABELS = {2: "on track", 1: "close", 0: "off track"}


def status_code(taken: Column, required: Column, close: Column) -> Column:
    return F.when(taken >= required, 2).when(taken >= close, 1).otherwise(0)


def status_label(code: Column) -> Column:
    return F.when(code == 2, LABELS[2]).when(code == 1, LABELS[1]).otherwise(LABELS[0])


def _taken() -> Column:
    return F.col("semsComplete") + F.col("semsInProgress")


def subject_status(ledger: DataFrame) -> DataFrame:
    code = status_code(_taken(), F.col("semsReqdGrade"), F.col("semsClose"))
    return ledger.withColumn("subjOnTrack", code)


def student_standing(ledger: DataFrame) -> DataFrame:
    """Worst subject and sums over subjects, in one aggregate per student."""
    return ledger.groupBy("studentID").agg(
        F.min("subjOnTrack").alias("minStatus"),
        F.max("semester").alias("semester"),
        F.sum("semsComplete").alias("semsComplete"),
        F.sum("semsInProgress").alias("semsInProgress"),
    )


def worst_status(ledger: DataFrame) -> DataFrame:
    return student_standing(ledger).select("studentID", "minStatus")


def total_sems(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("studentID").agg(
        F.max("semester").alias("semester"),
        F.sum("semsComplete").alias("semsComplete"),
        F.sum("semsInProgress").alias("semsInProgress"),
    )


def total_status(
    totals: DataFrame,
    reqs: DataFrame,
    curr_grad_year: int,
    rules: Rules = DEFAULT_RULES,
    small: bool | None = None,
    years: Sequence[str] | None = None,
) -> DataFrame:
    """Grade the semester total against the cohort's total requirement.

    A student gets one row per matching total row, and none without one.
    """
    wanted = (
        cohort_rows(reqs, rules, years)
        .filter(F.col("subj_key").isin(keys(rules.total_subjects)))
        .select("semester", "year", "semsReqd", "semsClose")
    )
    small = requirements_are_small(reqs, years) if small is None else small
    placed = totals.withColumn("year", grad_year_of_semester(F.col("semester"), curr_grad_year))
    found = lookup_join(placed, wanted, ["semester", "year"], small, ["studentID"])
    kept = [c for c in ("minStatus",) if c in totals.columns]
    code = status_code(_taken(), F.col("semsReqd"), F.col("semsClose"))
    return found.select("studentID", "semester", *kept, code.alias("semStatus"))


def _final(rows: DataFrame) -> DataFrame:
    return rows.select(
        "studentID",
        "semester",
        "minStatus",
        "semStatus",
        F.least("minStatus", "semStatus").alias("finalStatus"),
    )


def final_status_of(
    ledger: DataFrame,
    reqs: DataFrame,
    curr_grad_year: int,
    rules: Rules = DEFAULT_RULES,
    small: bool | None = None,
    years: Sequence[str] | None = None,
) -> DataFrame:
    """Worst subject and graded total of each student, and the lesser of the two."""
    totals = student_standing(ledger)
    return _final(total_status(totals, reqs, curr_grad_year, rules, small, years))


def overall_status(ledger: DataFrame, final: DataFrame) -> DataFrame:
    """Final code on every ledger row; 0 for students without one."""
    return update_from(
        ledger.withColumn("overallOnTrack", F.lit(0)),
        final,
        ["studentID"],
        assign={"overallOnTrack": "finalStatus"},
        multi_match="min",
    )


def publish_student_status(status: DataFrame, final: DataFrame) -> DataFrame:
    """New labels for students with a final status; other rows stay, none is added.

    Students with very many status rows are split over several tasks.
    """
    least = final.groupBy("studentID").agg(F.min("finalStatus").alias("finalStatus"))
    labels = least.select("studentID", status_label(F.col("finalStatus")).alias("label"))
    return spread_join(status, labels, ["studentID"], F.spark_partition_id()).select(
        "studentID", F.coalesce("label", "gradStatus").alias("gradStatus")
    )


def final_report(ledger: DataFrame) -> DataFrame:
    """The published shape: status as text, working columns gone."""
    return ledger.select(
        "studentID",
        F.col("subject").alias("hsSubject"),
        "semsComplete",
        "semsInProgress",
        "semsReqdGrade",
        F.col("semsClose").alias("semsReqdClose"),
        "semsReqdTotal",
        status_label(F.col("subjOnTrack")).alias("subjStatus"),
    )
