"""The four input tables derived from order data.

Customers become students, line items become transcript rows.  Spellings, marks
and credits vary so that every rule is reached; grade 6 matches no cohort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.graduation import Inputs

YEAR = 2024
MID_YEAR = 0

# Course of a line item, by l_partkey % 16.
COURSES = (
    "English",
    "Algebra I",
    "ALGEBRA I",
    "Algebra II",
    "Mathematics",
    "Biological Science",
    "Physical Science",
    "General Science",
    "World History",
    "US History",
    "Physical Education",
    "Electives",
    "Physical Science|Mathematics",
    "US History|Biological Science",
    "US History|World History",
    "Art",
)

# Full requirement per cohort; the second has no General Science.
COHORTS = {
    "2022,2023,2024,2025": {
        "English": 8,
        "Algebra I": 2,
        "Mathematics": 4,
        "Biological Science": 2,
        "Physical Science": 2,
        "General Science": 2,
        "World History": 2,
        "US History": 2,
        "Physical Education": 4,
        "Electives": 10,
    },
    "2026,2027,2028,2029": {
        "English": 10,
        "Algebra I": 2,
        "Mathematics": 4,
        "Biological Science": 2,
        "Physical Science": 2,
        "World History": 2,
        "US History": 2,
        "Physical Education": 4,
        "Electives": 10,
    },
}
SHORT_TOTAL_COHORT = "2026,2027,2028,2029"  # writes "T" for "Total" below semester 8


# Columns used; stated, so that reading needs no job to look at file footers.
COLUMNS = {
    "customer": "c_custkey long",
    "orders": "o_orderkey long, o_custkey long",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int,"
    " l_quantity double, l_returnflag string, l_linestatus string",
}


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.schema(COLUMNS[table]).parquet(f"{folder}/{table}.parquet")


def students(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "customer").select(
        F.col("c_custkey").alias("studentID"),
        (F.col("c_custkey") % 8 + 6).cast("int").alias("grade"),
    )


def student_status(spark: SparkSession, folder: str) -> DataFrame:
    return _read(spark, folder, "customer").select(
        F.col("c_custkey").alias("studentID"), F.lit("unknown").alias("gradStatus")
    )


def transcript(spark: SparkSession, folder: str) -> DataFrame:
    orders = _read(spark, folder, "orders")
    items = _read(spark, folder, "lineitem")
    quantity = F.floor("l_quantity").cast("int")
    open_ = (F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "O")
    course: Column = F.element_at(
        F.array(*[F.lit(c) for c in COURSES]), (F.col("l_partkey") % 16 + 1).cast("int")
    )
    earned = F.when(quantity % 10 == 0, 0.0).when(quantity % 7 == 0, 2.5).otherwise(5.0)
    return items.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("studentID"),
        course.alias("subject"),
        (F.col("l_suppkey") % 5 + 8).cast("int").alias("studentGrade"),
        (F.col("l_linenumber") % 3 + 1).cast("int").alias("semester"),
        F.when(open_, F.lit(None)).otherwise(quantity % 5).cast("int").alias("mark"),
        earned.alias("earnedCredits"),
        F.lit(5.0).alias("attemptedCredits"),
    )


def requirements(spark: SparkSession) -> DataFrame:
    """A share of the full requirement per semester, and the totals."""
    rows = []
    for cohort, subjects in COHORTS.items():
        for semester in range(1, 9):
            short = cohort == SHORT_TOTAL_COHORT and semester < 8
            total = {"T" if short else "Total": sum(subjects.values())}
            for part, slack in ((subjects, 1), (total, 3)):
                for subject, full in part.items():
                    due = -(-full * semester // 8)
                    rows.append((cohort, semester, subject, due, max(due - slack, 0)))
    return spark.sql(
        "select * from values "
        + ", ".join(map(str, rows))
        + " as r(gradYear, semester, subject, semsReqd, semsClose)"
    )


def second_requirement(spark: SparkSession) -> DataFrame:
    """A second full requirement of a subject, in other letters, for two of the years."""
    return spark.sql(
        "select '2024,2025' as gradYear, 8 as semester, 'english' as subject, 6 as semsReqd, 5 as semsClose"
    )


def inputs(spark: SparkSession, folder: str) -> Inputs:
    return Inputs(
        students(spark, folder),
        requirements(spark),
        transcript(spark, folder),
        student_status(spark, folder),
    )
