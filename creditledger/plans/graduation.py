"""The graduation run: every ledger version, and the named outputs.

Given a shared folder, the transcript is read once: its credit sums are written
there and every later step reads those.  All ledger steps stay hashed on
studentID, and so does the written ledger, which is kept in buckets of it.
Without a folder nothing is written, and every step is one lazy plan.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.cohort import ledger_years
from ..operators import credits, dual, joins, journal, requirements, status, transfer
from ..operators.checks import Checks
from ..rules import DEFAULT_RULES, Rules
from ..session import Scratch


@dataclass(frozen=True)
class Inputs:
    students: DataFrame
    reqs: DataFrame
    transcript: DataFrame
    student_status: DataFrame

    def conformed(self, rules: Rules = DEFAULT_RULES) -> Inputs:
        """The columns in use in their types; subjects as the rules compare them."""

        def subjects(df: DataFrame) -> DataFrame:
            return df.withColumn("subject", F.rtrim("subject")) if rules.rtrim_subjects else df

        return Inputs(
            schema.conform(self.students, schema.STUDENTS, "students"),
            subjects(schema.conform(self.reqs, schema.REQUIREMENTS, "reqs")),
            subjects(schema.conform(self.transcript, schema.TRANSCRIPT, "transcript")),
            schema.conform(self.student_status, schema.STUDENT_STATUS, "student_status"),
        )


class Graduation:
    """Each step as a DataFrame, built when first asked for.

    ``folder`` is a folder that all executors see, for the tables that steps
    rest on: asking for a step writes these, the step itself stays lazy.
    ``close`` removes them.  ``keep_stages`` also writes the versions that only
    several outputs share.  ``checks`` counts what clashes or matches nothing.
    """

    def __init__(
        self,
        inputs: Inputs,
        curr_grad_year: int,
        mid_year: int,
        rules: Rules = DEFAULT_RULES,
        folder: str | None = None,
        keep_stages: bool = False,
        checks: bool = False,
    ) -> None:
        if not isinstance(curr_grad_year, int):
            raise ValueError("curr_grad_year must be given as an int")
        if mid_year not in (0, 1):
            raise ValueError("mid_year must be 0 or 1")
        self.inputs = inputs.conformed(rules)
        self.year = curr_grad_year
        self.mid_year = mid_year
        self.rules = rules
        self.keep_stages = keep_stages
        self.scratch = Scratch(inputs.students.sparkSession, folder)
        self.checks = Checks(on=checks)

    def close(self) -> None:
        self.scratch.close()

    def _kept(self, df: DataFrame) -> DataFrame:
        return self.scratch.cut(df) if self.keep_stages else df

    def _kept_hashed(self, ledger: DataFrame) -> DataFrame:
        return self.scratch.cut_hashed(ledger, "studentID") if self.keep_stages else ledger

    @cached_property
    def small(self) -> bool:
        return joins.requirements_are_small(self.inputs.reqs, self.years)

    @cached_property
    def years(self) -> list[str] | None:
        """The years that grades ask for, if few, and those that ledger semesters do."""
        asked = requirements.asked_years(self.inputs.students, self.year)
        return None if asked is None else sorted({*asked, *ledger_years(self.year)})

    @cached_property
    def reqs(self) -> DataFrame:
        """Requirements; in one partition when small, so lookups need no shuffle."""
        return self.inputs.reqs.coalesce(1) if self.small else self.inputs.reqs

    # --- requirements

    @cached_property
    def students(self) -> DataFrame:
        no_id = F.col("studentID").isNull()
        return requirements.by_student(self.checks.count(self.inputs.students, students_without_id=no_id))

    @cached_property
    def seed(self) -> DataFrame:
        return requirements.seed_ledger(
            self.students, self.reqs, self.year, self.rules, self.small, self.years
        )

    @cached_property
    def by_grade(self) -> DataFrame:
        return requirements.requirements_by_grade(
            self.students, self.reqs, self.year, self.mid_year, self.rules, self.small, self.years
        )

    @cached_property
    def required(self) -> DataFrame:
        found = self.checks.count(
            self.found,
            several_full=F.size("totals") > 1,
            several_current=F.col("now") != F.col("last"),
            ledger_rows=F.lit(True),
        )
        return schema.check_ledger(requirements.settled_requirements(found, self.rules))

    @cached_property
    def found(self) -> DataFrame:
        return requirements.found_requirements(
            self.students, self.reqs, self.year, self.mid_year, self.rules, self.small, self.years
        )

    @cached_property
    def refused(self) -> DataFrame:
        """Students that the rules set aside, who are in no ledger."""
        return requirements.refused_students(self.found, self.rules)

    # --- transcript

    @cached_property
    def sums(self) -> DataFrame:
        """Credit sums of the courses that can reach a ledger.

        Irrelevant courses go before the aggregate when the requirements can be
        broadcast, and after it, on far fewer rows, when they cannot.
        """
        reqs = self.reqs
        rows = self.checks.count(
            self.inputs.transcript,
            transcript_rows=F.lit(True),
            transcript_without_student=F.col("studentID").isNull(),
            transcript_without_subject=F.col("subject").isNull(),
        )
        if self.small:
            rows = credits.relevant_courses(rows, reqs, self.rules, True)
            sums = credits.course_sums(rows, self.rules)
        else:
            sums = credits.course_sums(rows, self.rules)
            sums = credits.relevant_courses(sums, reqs, self.rules, False)
        return self.scratch.cut(sums)

    @cached_property
    def with_donor(self) -> DataFrame:
        """The counted ledger, with each student's donor semesters beside it."""
        courses = credits.ledger_courses(self.sums, self.reqs, self.rules, self.small)
        semesters = credits.student_semesters(courses.repartition("studentID"), self.rules)
        return self._kept_hashed(credits.count_semesters(self.required, semesters, self.checks))

    @cached_property
    def counted(self) -> DataFrame:
        return self.with_donor.drop("donorDone", "donorOpen")

    @cached_property
    def donor(self) -> DataFrame:
        return credits.donor_semesters(self.sums, self.rules)

    # --- transfers and overflow

    @cached_property
    def transferred(self) -> DataFrame:
        return transfer.apply_donor(self.with_donor, self.rules)

    @cached_property
    def grouped(self) -> DataFrame:
        return self._kept_hashed(transfer.settle_group(self.transferred, self.rules))

    @cached_property
    def spilled(self) -> DataFrame:
        return transfer.spill_to_sink(self.grouped, self.rules)

    @cached_property
    def snapshot(self) -> DataFrame:
        """The ledger that dual courses are measured against and posted to, written once."""
        return self.scratch.cut_hashed(self.spilled, "studentID")

    # --- dual courses

    @cached_property
    def dual_split(self) -> DataFrame:
        return credits.split_dual_courses(self.sums, self.rules)

    @cached_property
    def dual_needs(self) -> DataFrame:
        return dual.measure_needs(self.dual_split, self.snapshot, self.rules)

    @cached_property
    def dual(self) -> DataFrame:
        return self._kept(dual.allocate(self.dual_needs, self.rules))

    @cached_property
    def postings(self) -> DataFrame:
        return dual.dual_postings(self.dual, self.rules)

    @cached_property
    def posted(self) -> DataFrame:
        return dual.post_dual(self.snapshot, self.postings, self.checks)

    @cached_property
    def journal(self) -> DataFrame:
        """Every move of semesters between the counted and the settled ledger."""
        versions = (self.with_donor, self.transferred, self.grouped, self.dual, self.posted)
        return journal.journal(*versions, self.rules)

    @cached_property
    def settled(self) -> DataFrame:
        return transfer.spill_to_sink(self.posted, self.rules)

    # --- status

    @cached_property
    def graded(self) -> DataFrame:
        return schema.check_ledger(status.subject_status(self.settled))

    def final_of(self, graded: DataFrame) -> DataFrame:
        return status.final_status_of(
            graded, self.reqs, self.year, self.rules, self.small, self.years
        )

    def total_status_of(self, graded: DataFrame) -> DataFrame:
        totals = status.total_sems(graded)
        return status.total_status(totals, self.reqs, self.year, self.rules, self.small, self.years)

    @cached_property
    def final(self) -> DataFrame:
        return self.final_of(self.graded)

    def published(self, final: DataFrame) -> DataFrame:
        return status.publish_student_status(self.inputs.student_status, final)

    @cached_property
    def graded_table(self) -> DataFrame:
        """The graded ledger written once, for outputs that need it more than once."""
        return self.scratch.cut_hashed(self.graded, "studentID")

    @cached_property
    def lost(self) -> DataFrame:
        """What the rules leave without a place, for people to look at.

        ``donor``: donor semesters and no row that takes the rest; ``overflow``:
        surplus and no sink row; ``requirement``: a ledger row without a current
        requirement, with the semesters it has when grading begins.
        """
        over = transfer.sink_posting(self.grouped, self.rules).filter(~F.col("posted"))
        amounts = ("semsComplete", "semsInProgress")
        rows = {
            "donor": transfer.lost_donor(self.with_donor, self.rules),
            "overflow": over.withColumnsRenamed(
                {"compOverflow": "semsComplete", "inpOverflow": "semsInProgress"}
            ),
            "requirement": self.settled.filter(F.col("semester") == -1),
        }
        subject = {"donor": F.lit(self.rules.donor), "requirement": F.col("subject")}
        parts = [
            df.select(
                "studentID",
                F.lit(kind).alias("kind"),
                subject.get(kind, F.lit(None).cast("string")).alias("subject"),
                *amounts,
            )
            for kind, df in rows.items()
        ]
        return parts[0].unionByName(parts[1]).unionByName(parts[2])


@dataclass(frozen=True)
class Outputs:
    """DataFrames ready to be written; ``close`` removes the tables they rest on."""

    ledger: DataFrame
    student_status: DataFrame
    final_status: DataFrame
    totals: DataFrame
    overflow: DataFrame
    dual: DataFrame
    counts: DataFrame
    total_status: DataFrame
    second_overflow: DataFrame
    lost: DataFrame
    refused: DataFrame
    journal: DataFrame | None
    checks: Checks
    scratch: Scratch

    def counts_of_checks(self) -> dict[str, int]:
        """What the run met in passing: rows without keys, clashes, sources without a target."""
        return self.checks.report()

    def close(self) -> None:
        self.scratch.close()

    def __enter__(self) -> Outputs:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


DUAL_COLUMNS = (
    "studentID",
    "subject",
    "primarySubj",
    "secondarySubj",
    "semsComplete",
    "semsInProgress",
    *credits.DUAL_COUNTERS,
)


def run(
    students: DataFrame,
    reqs: DataFrame,
    transcript: DataFrame,
    student_status: DataFrame,
    curr_grad_year: int,
    mid_year: int,
    folder: str,
    rules: Rules = DEFAULT_RULES,
) -> Outputs:
    """Grade every student; returns DataFrames ready to be written.

    Ledger versions that several outputs need are written once to ``folder``,
    which all executors must see, so that no output repeats the run.  Close the
    outputs, or use them in a ``with`` block, to remove these tables.
    """
    if not folder:
        raise ValueError("a run needs a folder that all executors see")
    inputs = Inputs(students, reqs, transcript, student_status)
    steps = Graduation(inputs, curr_grad_year, mid_year, rules, folder, True, checks=True)
    try:
        graded = steps.graded_table
        final = steps.final_of(graded)
        sums = credits.counted_semesters(steps.sums, rules)
        return Outputs(
            ledger=status.final_report(graded),
            student_status=steps.published(final),
            final_status=final,
            totals=transfer.student_totals(steps.grouped),
            overflow=transfer.subject_overflow(steps.grouped, rules).drop("subj_key"),
            dual=steps.dual.select(*DUAL_COLUMNS),
            counts=sums.select("studentID", "subject", "semsComp", "semsInp"),
            total_status=steps.total_status_of(graded),
            second_overflow=transfer.subject_overflow(steps.posted, rules).drop("subj_key"),
            lost=steps.lost,
            refused=steps.refused,
            journal=steps.journal if rules.multi_match == "sum" else None,
            checks=steps.checks,
            scratch=steps.scratch,
        )
    except BaseException:
        steps.close()
        raise
