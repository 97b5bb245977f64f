"""Courses that count for two subjects.

All needs come from one ledger snapshot, so two courses with the same primary
subject both see the same need; the second overflow round moves what they
over-fill.  After :func:`measure_needs` every step is a projection.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..rules import DEFAULT_RULES, Rules, key, keys
from .checks import Checks
from .joins import split_join
from .keyed import NO_CHECKS, one_row_per_key, update_from

NEEDS = ("primaryReqd", "primaryNeed", "secondaryNeed", "hasGroup", "hasSink")


def _c(name: str) -> Column:
    return F.col(name)


def needs_by_student(ledger: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One row per student: requirement and open need of each ledger subject.

    The map has one entry per required subject, so its size does not grow with
    the number of courses.  Where a subject has two ledger rows, the one with the
    larger requirement counts.
    """
    if rules.duplicate_seed == "keep":
        own = F.struct("semsReqdTotal", "semsComplete", "semsInProgress")
        ledger = (
            ledger.groupBy("studentID", "subj_key").agg(F.max(own).alias("own"))
            .select("studentID", "subj_key", "own.*")
        )
    entry = F.struct(
        "subj_key",
        F.struct(
            F.col("semsReqdTotal").cast("bigint").alias("reqd"),
            (F.col("semsReqdTotal") - F.col("semsComplete") - F.col("semsInProgress")).alias("need"),
        ),
    )
    return ledger.groupBy("studentID").agg(
        F.map_from_entries(F.collect_list(entry)).alias("needs"),
        F.max(F.col("subj_key") == key(rules.group_subject)).alias("hasGroup"),
        F.max(F.col("subj_key") == key(rules.sink)).alias("hasSink"),
    )


def measure_needs(
    dual: DataFrame, ledger: DataFrame, rules: Rules = DEFAULT_RULES
) -> DataFrame:
    """Give each dual course the needs of its two subjects, NULL without a ledger row.

    The courses of students who have very many meet these needs where they are.
    """
    needs = needs_by_student(ledger, rules)
    rows = split_join(dual, needs, ["studentID"])
    primary = F.try_element_at("needs", F.col("primary_key"))
    secondary = F.try_element_at("needs", F.col("secondary_key"))
    return rows.select(
        *[F.col(c) for c in dual.columns],
        primary["reqd"].alias("primaryReqd"),
        primary["need"].alias("primaryNeed"),
        secondary["need"].alias("secondaryNeed"),
        F.coalesce("hasGroup", F.lit(False)).alias("hasGroup"),
        F.coalesce("hasSink", F.lit(False)).alias("hasSink"),
    )


def _primary_in_group(rules: Rules) -> Column:
    return _c("primary_key").isin(keys(rules.group_members))


def _allocate(dual: DataFrame, applies: Column, complete: str, in_progress: str, done: Column,
              open_: Column, need: Column, topped_up: Column) -> DataFrame:
    """Fill ``need`` with completed semesters, then with in-progress ones.

    ``topped_up`` is the in-progress amount where both together suffice.
    """
    applies = F.coalesce(applies & (need > 0), F.lit(False))
    open_used = F.when(done >= need, 0).when(done + open_ >= need, topped_up).otherwise(open_)
    return dual.withColumns(
        {
            complete: F.when(applies, F.least(done, need)).otherwise(_c(complete)),
            in_progress: F.when(applies, open_used).otherwise(_c(in_progress)),
        }
    )


def allocate_primary(dual: DataFrame) -> DataFrame:
    done, open_, need = _c("semsComplete"), _c("semsInProgress"), _c("primaryNeed")
    return _allocate(
        dual, F.lit(True), "primaryComplete", "primaryInProgress", done, open_, need, need - done
    )


def allocate_group(dual: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """What the primary leaves goes to the group subject.

    The need is the primary subject's, and the top-up is all of it: an
    in-progress allocation may exceed what the course has.
    """
    done = _c("semsComplete") - _c("primaryComplete")
    open_ = _c("semsInProgress") - _c("primaryInProgress")
    need = _c("primaryNeed")
    applies = _primary_in_group(rules) & _c("hasGroup")
    return _allocate(
        dual, applies, "semsCompleteGS", "semsInProgressGS", done, open_, need, need
    )


def allocate_secondary(dual: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The rest goes to the secondary subject, unless the primary is a group member."""
    done = _c("semsComplete") - _c("primaryComplete") - _c("semsCompleteGS")
    open_ = _c("semsInProgress") - _c("primaryInProgress") - _c("semsInProgressGS")
    need = _c("secondaryNeed")
    return _allocate(
        dual, ~_primary_in_group(rules), "secondaryComplete", "secondaryInProgress",
        done, open_, need, need,
    )


def secondary_group_surplus(dual: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Add the surplus of courses whose secondary subject is a group member.

    Measured against the requirement of the primary subject; NULL elsewhere.
    """
    applies = (
        _c("secondary_key").isin(keys(rules.group_members))
        & _c("hasGroup")
        & _c("primaryReqd").isNotNull()
    )
    surplus = F.greatest(
        F.lit(0).cast("bigint"), _c("semsInProgress") + _c("semsComplete") - _c("primaryReqd")
    )
    open_part = F.least(_c("semsInProgress"), surplus)
    return dual.withColumns(
        {
            "surplusInProgress": F.when(applies, open_part),
            "surplusComplete": F.when(applies, surplus - open_part),
        }
    )


def post_group_surplus(dual: DataFrame) -> DataFrame:
    """Credit the surplus to the group subject and take it from the course.

    Both sides change, so the leftover below is reduced by it twice.
    """
    done = F.coalesce("surplusComplete", F.lit(0))
    open_ = F.coalesce("surplusInProgress", F.lit(0))
    return dual.withColumns(
        {
            "semsCompleteGS": _c("semsCompleteGS") + done,
            "semsInProgressGS": _c("semsInProgressGS") + open_,
            "semsComplete": _c("semsComplete") - done,
            "semsInProgress": _c("semsInProgress") - open_,
        }
    )


def dual_overflow(dual: DataFrame) -> DataFrame:
    """What no subject took; below zero where more was given than the course has."""
    return dual.withColumns(
        {
            "overflowComplete": _c("semsComplete")
            - (_c("primaryComplete") + _c("secondaryComplete") + _c("semsCompleteGS")),
            "overflowInProgress": _c("semsInProgress")
            - (_c("primaryInProgress") + _c("secondaryInProgress") + _c("semsInProgressGS")),
        }
    )


def allocate(dual: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """All allocation steps in order, on rows that carry their needs."""
    for step in (
        allocate_primary,
        lambda d: allocate_group(d, rules),
        lambda d: allocate_secondary(d, rules),
        lambda d: secondary_group_surplus(d, rules),
        post_group_surplus,
        dual_overflow,
    ):
        dual = step(dual)
    return dual


def dual_postings(dual: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Semesters to add per student and ledger subject.

    The four kinds of contribution read only the dual courses, so they add up
    in any order; partial sums are taken before the shuffle.
    """

    def to(subj_key: Column, done: str, open_: str) -> Column:
        return F.struct(
            subj_key.alias("subj_key"), _c(done).alias("addComplete"), _c(open_).alias("addInProgress")
        )

    group_key = F.lit(key(rules.group_subject))
    kinds = [
        to(_c("primary_key"), "primaryComplete", "primaryInProgress"),
        to(_c("secondary_key"), "secondaryComplete", "secondaryInProgress"),
        to(F.lit(key(rules.sink)), "overflowComplete", "overflowInProgress"),
    ]
    if rules.multi_match == "sum":
        kinds.append(to(group_key, "semsCompleteGS", "semsInProgressGS"))
    adds = dual.select("studentID", F.inline(F.array(*kinds)))
    if rules.multi_match != "sum":
        values = ["addComplete", "addInProgress"]
        per_secondary = dual.groupBy("studentID", "secondary_key").agg(
            F.sum("semsCompleteGS").alias("addComplete"),
            F.sum("semsInProgressGS").alias("addInProgress"),
        )
        picked = one_row_per_key(per_secondary, ["studentID"], values, rules.multi_match)
        adds = adds.unionByName(picked.withColumn("subj_key", group_key))
    moves = (F.col("addComplete") != 0) | (F.col("addInProgress") != 0)
    return (
        adds.filter(moves)
        .groupBy("studentID", "subj_key")
        .agg(
            F.sum("addComplete").alias("addComplete"), F.sum("addInProgress").alias("addInProgress")
        )
        .filter(moves)
    )


def post_dual(ledger: DataFrame, postings: DataFrame, checks: Checks = NO_CHECKS) -> DataFrame:
    """Add the postings; those without a ledger row vanish."""
    return update_from(
        ledger,
        postings,
        ["studentID", "subj_key"],
        add={"semsComplete": "addComplete", "semsInProgress": "addInProgress"},
        multi_match=None,
        checks=checks,
        name="dual_posting",
    )
