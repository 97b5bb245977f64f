"""The posting journal: one row for every move of semesters, and the ledger it adds up to.

A move has a source, a target, the rule that made it and its amounts.  ``taken`` says that the
source is a ledger row, which gives the amounts up; donors and dual courses are no ledger rows.
``landed`` says that the target is one, which receives them; what does not land is lost.  The
settled ledger is the counted one, less what was taken, plus what landed.

Every rule gives its rows from the ledger version it works on, as projections of the windows
that the rule itself uses, so the journal adds no shuffle to those versions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..rules import DEFAULT_RULES, Rules, key
from . import transfer

AMOUNTS = ("semsComplete", "semsInProgress")
COLUMNS = ("studentID", "rule", "fromSubject", "toSubject", *AMOUNTS, "taken", "landed")
# Names of the rules.
DONOR, REST, GROUP, DUAL = "donor", "donor rest", "group", "dual course"
OVERFLOW, SECOND_OVERFLOW = "overflow", "second overflow"


def _text(value: Column | str | None) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("string")


def _move(rule: str, source, target, done: Column, open_: Column, taken: bool, landed) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"),
        _text(source).alias("fromSubject"),
        _text(target).alias("toSubject"),
        done.cast("bigint").alias(AMOUNTS[0]),
        open_.cast("bigint").alias(AMOUNTS[1]),
        F.lit(taken).alias("taken"),
        (landed if isinstance(landed, Column) else F.lit(landed)).alias("landed"),
    )


def _moves(rows: DataFrame, *moves: Column) -> DataFrame:
    """The moves of each row that move something."""
    each = rows.select("studentID", F.inline(F.array(*moves)))
    return each.filter((F.col(AMOUNTS[0]) != 0) | (F.col(AMOUNTS[1]) != 0)).select(*COLUMNS)


def donor_moves(with_donor: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """From the donor to the receiver, and its rest to the third subject."""
    per_student = (
        transfer.with_transfer(with_donor, rules)
        .filter(F.col("donorDone").isNotNull())
        .groupBy("studentID")
        .agg(
            *[F.max(c).alias(c) for c in ("donorDone", "donorOpen")],
            *[F.max(c).alias(c) for c in ("transferComplete", "transferInProgress")],
            F.max(F.col("subj_key") == key(rules.remainder)).alias("hasRest"),
        )
    )
    done, open_ = F.col("transferComplete"), F.col("transferInProgress")
    donor = key(rules.donor)
    return _moves(
        per_student,
        _move(DONOR, donor, key(rules.receiver), done, open_, False, True),
        _move(
            REST, donor, key(rules.remainder), F.col("donorDone") - done, F.col("donorOpen") - open_,
            False, F.col("hasRest"),
        ),
    )


def group_moves(transferred: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """From the members to the group subject.

    Where several members do not add up, each gives its own amounts up without a target, and
    the group subject receives what counts without a source.
    """
    rows = transfer.group_surplus(transferred, rules)
    done, open_ = F.col("surplusComplete"), F.col("surplusInProgress")
    group, own = key(rules.group_subject), F.col("subj_key")
    if rules.multi_match == "sum":
        return _moves(rows, _move(GROUP, own, group, done, open_, True, True))
    given = _moves(rows, _move(GROUP, own, None, done, open_, True, False))
    least = rows.groupBy("studentID").agg(F.min(done).alias("done"), F.min(open_).alias("open"))
    got = _move(GROUP, None, group, F.col("done"), F.col("open"), False, True)
    return given.unionByName(_moves(least, got))


def overflow_moves(ledger: DataFrame, rule: str, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """From every subject above its requirement to the sink, whether there is one or not."""
    rows = transfer.overflow_with_sink(ledger, rules)
    return _moves(
        rows,
        _move(
            rule, F.col("subj_key"), key(rules.sink), F.col("compOverflow"), F.col("inpOverflow"),
            True, F.col("hasSink"),
        ),
    )


def dual_moves(dual: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """From every dual course to its two subjects, the group subject and the sink."""

    def to(target, name: str, landed: Column) -> Column:
        done, open_ = f"{name}Complete", f"{name}InProgress"
        if name == "group":
            done, open_ = "semsCompleteGS", "semsInProgressGS"
        return _move(DUAL, F.col("subj_key"), target, F.col(done), F.col(open_), False, landed)

    return _moves(
        dual,
        to(F.col("primary_key"), "primary", F.col("primaryReqd").isNotNull()),
        to(F.col("secondary_key"), "secondary", F.col("secondaryNeed").isNotNull()),
        to(key(rules.group_subject), "group", F.col("hasGroup")),
        to(key(rules.sink), "overflow", F.col("hasSink")),
    )


def journal(
    with_donor: DataFrame,
    transferred: DataFrame,
    grouped: DataFrame,
    dual: DataFrame,
    posted: DataFrame,
    rules: Rules = DEFAULT_RULES,
) -> DataFrame:
    """Every move of a run, from the ledger versions that the rules work on."""
    if rules.multi_match != "sum":
        raise ValueError("the journal of dual courses needs amounts that add up")
    parts = [
        donor_moves(with_donor, rules),
        group_moves(transferred, rules),
        overflow_moves(grouped, OVERFLOW, rules),
        dual_moves(dual, rules),
        overflow_moves(posted, SECOND_OVERFLOW, rules),
    ]
    return reduce(DataFrame.unionByName, parts)


def balances(counted: DataFrame, moves: DataFrame) -> DataFrame:
    """The ledger that the journal leads to: per student and subject, counts and moves added up.

    Every move gives what it takes and what lands in one pass, so that the ledger versions behind
    the journal are worked out once.  Partial sums are taken before the one shuffle.
    """

    def leg(subject: str, sign: int, which: str) -> Column:
        amounts = [(F.col(c) * sign).alias(c) for c in AMOUNTS]
        return F.when(F.col(which), F.struct(F.col(subject).alias("subj_key"), *amounts))

    both = F.array(leg("fromSubject", -1, "taken"), leg("toSubject", 1, "landed"))
    legs = moves.select("studentID", F.inline(F.array_compact(both)))
    rows = counted.select("studentID", "subj_key", *AMOUNTS).unionByName(legs)
    return rows.groupBy("studentID", "subj_key").agg(*[F.sum(c).alias(c) for c in AMOUNTS])
