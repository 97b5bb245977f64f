"""Moving surplus semesters between the subjects of one student.

Every rule reads and changes rows of a single student, so each is a window
over studentID and the chain shares one shuffle.  A student has at most one row
per required subject, which bounds every window.  Names of columns that are
written out, as ``compOverflow`` and ``inpOverflow``, are fixed values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..rules import DEFAULT_RULES, Rules, key, keys
from .keyed import over_matches, refusing


def _student() -> WindowSpec:
    return Window.partitionBy("studentID")


def _is(subject: str) -> Column:
    return F.col("subj_key") == key(subject)


def _member(rules: Rules) -> Column:
    return F.col("subj_key").isin(keys(rules.group_members))


def _owns(subject: str) -> Column:
    return F.max(_is(subject)).over(_student())


def _taken() -> Column:
    return F.col("semsComplete") + F.col("semsInProgress")


def _over(amount: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), amount)


def _with_changed(rows: DataFrame, ledger: DataFrame, changed: dict[str, Column]) -> DataFrame:
    """The ledger columns of ``rows``, some of them replaced."""
    return rows.select([changed.get(c, F.col(c)).alias(c) for c in ledger.columns])


# --- donor to receiver, rest to a third subject ---------------------------------


def with_transfer(ledger: DataFrame, rules: Rules) -> DataFrame:
    """Add what the student's donor gives to the receiver and what is left.

    ``short`` is NULL without a receiver row: then nothing is transferred and
    all of it is rest.  The in-progress need is what completed semesters leave.
    """
    short = F.max(F.when(_is(rules.receiver), F.col("semsReqdTotal") - _taken())).over(_student())
    rows = ledger.withColumn("short", short)
    need, known = F.col("short"), F.col("short").isNotNull()
    done = F.when(known, F.least(_over(need), F.col("donorDone"))).otherwise(0)
    open_ = F.when(known, F.least(_over(need - done), F.col("donorOpen"))).otherwise(0)
    return rows.withColumns({"transferComplete": done, "transferInProgress": open_})


def donor_transfer(ledger: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Per student with a donor and a receiver row: semesters transferred and left."""
    rows = with_transfer(ledger, rules)
    return rows.filter(_is(rules.receiver) & F.col("donorDone").isNotNull()).select(
        "studentID",
        "transferComplete",
        "transferInProgress",
        (F.col("donorDone") - F.col("transferComplete")).alias("restComplete"),
        (F.col("donorOpen") - F.col("transferInProgress")).alias("restInProgress"),
    )


def apply_donor(ledger: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Post the transfer and the rest.

    ``ledger`` has ``donorDone`` and ``donorOpen`` beside it, NULL without a donor.
    """
    gives = F.col("donorDone").isNotNull()

    def posted(column: str, transfer: str, available: str) -> Column:
        return (
            F.when(gives & _is(rules.receiver), F.col(column) + F.col(transfer))
            .when(gives & _is(rules.remainder), F.col(column) + F.col(available) - F.col(transfer))
            .otherwise(F.col(column))
        )

    changed = {
        "semsComplete": posted("semsComplete", "transferComplete", "donorDone"),
        "semsInProgress": posted("semsInProgress", "transferInProgress", "donorOpen"),
    }
    own = ledger.drop("donorDone", "donorOpen")
    return _with_changed(with_transfer(ledger, rules), own, changed)


def lost_donor(ledger: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Donor semesters left over for students without a row that takes them."""
    rows = with_transfer(ledger, rules)
    return (
        rows.groupBy("studentID")
        .agg(
            F.max(F.col("donorDone") - F.col("transferComplete")).alias("semsComplete"),
            F.max(F.col("donorOpen") - F.col("transferInProgress")).alias("semsInProgress"),
            F.max(_is(rules.remainder)).alias("taken"),
        )
        .filter(~F.col("taken") & ((F.col("semsComplete") > 0) | (F.col("semsInProgress") > 0)))
        .select("studentID", "semsComplete", "semsInProgress")
    )


# --- surplus of group members to the group subject ------------------------------


def _with_surplus(ledger: DataFrame, rules: Rules) -> DataFrame:
    """Add the surplus of member rows, in-progress semesters taken first."""
    surplus = _over(_taken() - F.col("semsReqdTotal"))
    open_part = F.least(F.col("semsInProgress"), surplus)
    return ledger.withColumns(
        {
            "surplusInProgress": F.when(_member(rules), open_part),
            "surplusComplete": F.when(_member(rules), surplus - open_part),
        }
    )


def group_surplus(ledger: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Surplus of the member rows of students who own the group subject."""
    return (
        _with_surplus(ledger, rules)
        .withColumn("owns", _owns(rules.group_subject))
        .filter(_member(rules) & F.col("owns"))
        .select("studentID", "subject", "subj_key", "surplusComplete", "surplusInProgress")
    )


def settle_group(ledger: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Post the surplus to the group subject and take it from the members."""

    def settled(column: str, surplus: str) -> Column:
        received = over_matches(F.col(surplus), rules.multi_match, _student())
        return (
            F.when(_is(rules.group_subject), F.col(column) + F.coalesce(received, F.lit(0)))
            .when(_member(rules) & _owns(rules.group_subject), F.col(column) - F.col(surplus))
            .otherwise(F.col(column))
        )

    changed = {
        "semsComplete": settled("semsComplete", "surplusComplete"),
        "semsInProgress": settled("semsInProgress", "surplusInProgress"),
    }
    rows = _with_surplus(ledger, rules)
    if rules.multi_match == "error":
        rows = rows.withColumn("_members", F.count("surplusComplete").over(_student()))
        several = _is(rules.group_subject) & (F.col("_members") > 1)
        rows = refusing(rows, several, "several source rows match one group row")
    return _with_changed(rows, ledger, changed)


def student_totals(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("studentID").agg(F.sum(_taken()).alias("total"))


# --- overflow to the sink -------------------------------------------------------


def _with_overflow(ledger: DataFrame, rules: Rules) -> DataFrame:
    """Add the overflow of rows above their requirement; NULL on the others."""
    done, open_, total = F.col("semsComplete"), F.col("semsInProgress"), F.col("semsReqdTotal")
    spills = ~_is(rules.sink) & (_taken() > total)
    return ledger.withColumns(
        {
            "compOverflow": F.when(spills, _over(done - total)),
            "inpOverflow": F.when(spills, _over(open_ - _over(total - done))),
        }
    )


def subject_overflow(ledger: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    return (
        _with_overflow(ledger, rules)
        .filter(F.col("compOverflow").isNotNull())
        .select("studentID", "subject", "subj_key", "compOverflow", "inpOverflow")
    )


def overflow_with_sink(ledger: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """The overflow, and whether the student has a sink row that receives it."""
    rows = _with_overflow(ledger, rules).withColumn("hasSink", _owns(rules.sink))
    return rows.filter(F.col("compOverflow").isNotNull()).select(
        "studentID", "subject", "subj_key", "compOverflow", "inpOverflow", "hasSink"
    )


def sink_posting(ledger: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Overflow per student; ``posted`` is false where no sink row receives it."""
    return (
        _with_overflow(ledger, rules)
        .groupBy("studentID")
        .agg(
            F.sum("compOverflow").alias("compOverflow"),
            F.sum("inpOverflow").alias("inpOverflow"),
            F.max(_is(rules.sink)).alias("posted"),
        )
        .filter(F.col("compOverflow").isNotNull())
    )


def spill_to_sink(ledger: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """Post the overflow to the sink and take it from its own subject.

    The subject gives its overflow up even when the student has no sink row.
    """

    def settled(column: str, overflow: str) -> Column:
        received = F.coalesce(F.sum(overflow).over(_student()), F.lit(0))
        given = F.coalesce(F.col(overflow), F.lit(0))
        return F.when(_is(rules.sink), F.col(column) + received).otherwise(F.col(column) - given)

    changed = {
        "semsComplete": settled("semsComplete", "compOverflow"),
        "semsInProgress": settled("semsInProgress", "inpOverflow"),
    }
    return _with_changed(_with_overflow(ledger, rules), ledger, changed)
