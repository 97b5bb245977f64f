"""Students set aside, counts taken in passing, and the journal of moves."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from creditledger import Graduation, Rules, run
from creditledger.operators import journal, requirements
from creditledger.sources import derived
from test_plans import FOLDER, at_scale, plan_of, shuffles, written  # noqa: F401
from worlds import YEAR, make_inputs, random_world


def rows(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


def clashing(spark, seed: int = 3):
    """A random world where some cohorts have a second, different full requirement."""
    students, reqs, courses, before = random_world(seed, 120)
    reqs = [*reqs, ("2025;2027", 8, "ENGLISH", 9, 9), ("2026", 8, "Electives", 1, 1), ("2026", 8, "Electives", 2, 1)]
    return make_inputs(spark, students, reqs, courses, before)


def test_students_set_aside_are_listed_and_the_others_graded_as_ever(spark):
    inputs = clashing(spark)
    kept = Graduation(inputs, YEAR, 0)
    aside = Graduation(inputs, YEAR, 0, Rules(duplicate_seed="set_aside"))
    several = kept.required.groupBy("studentID", "subj_key").count().filter("count > 1")
    refused = {r.studentID for r in several.collect()}
    everyone = {r[0] for r in kept.required.select("studentID").distinct().collect()}
    assert refused and refused != everyone
    assert {r.studentID for r in aside.refused.collect()} == refused
    assert {r.reason for r in aside.refused.collect()} == {requirements.SEVERAL_FULL}
    own = ~F.col("studentID").isin(list(refused))
    for step in ("seed", "required", "settled", "graded", "final"):
        assert rows(getattr(aside, step)) == rows(getattr(kept, step).filter(own)), step
    with pytest.raises(PySparkException):
        Graduation(inputs, YEAR, 0, Rules(duplicate_seed="error")).required.collect()
    assert kept.refused.count() == 0


def test_several_current_requirements_set_aside(spark):
    inputs = make_inputs(
        spark,
        [(1, 9), (2, 9), (3, 10)],
        [("2027", 8, "English", 4, 3), ("2027", 1, "English", 1, 0), ("2026", 8, "English", 4, 3),
         ("2026", 3, "English", 2, 1), ("2026,2030", 3, "english", 3, 1), ("2027", 8, "Total", 9, 9)],
        [], [(1, "old"), (2, "old"), (3, "old")],
    )
    aside = Graduation(inputs, YEAR, 0, Rules(current_match="set_aside"))
    assert rows(aside.refused) == Counter([(3, "English", requirements.SEVERAL_CURRENT)])
    assert {r.studentID for r in aside.required.collect()} == {1, 2}
    assert aside.published(aside.final).filter("studentID = 3").first().gradStatus == "old"


def test_both_sides_need_no_further_shuffle(at_scale):  # noqa: F811
    steps = Graduation(derived.inputs(at_scale, FOLDER), YEAR, 0, Rules(duplicate_seed="set_aside"))
    assert shuffles(steps.required) == ["studentID"]
    assert shuffles(steps.refused) == ["studentID"]


def test_counts_are_taken_without_a_further_shuffle(at_scale, written):  # noqa: F811
    inputs = derived.inputs(at_scale, FOLDER)
    plain, counted = written(inputs), written(inputs, checks=True)
    for step in ("spilled", "graded"):
        assert shuffles(getattr(counted, step)) == shuffles(getattr(plain, step))
    assert "CollectMetrics" in plan_of(counted.spilled)
    assert "CollectMetrics" not in plan_of(plain.spilled)


def test_the_default_run_counts_what_it_meets(spark, tmp_path):
    students, reqs, courses, before = random_world(9, 80)
    reqs = [*reqs, ("2025;2027", 8, "ENGLISH", 9, 9)]
    students = [*students, (None, 9), (None, 10)]
    courses = [*courses, (None, "English", 10, 1, 3, 5.0, 5.0), (1, None, 10, 1, 3, 5.0, 5.0)]
    inputs = make_inputs(spark, students, reqs, courses, before)
    named = (inputs.students, inputs.reqs, inputs.transcript, inputs.student_status)
    with run(*named, YEAR, 0, str(tmp_path)) as out:
        found = out.counts_of_checks()
    steps = Graduation(inputs, YEAR, 0)
    ledger = rows(steps.required.select("studentID", "subj_key"))
    counts = steps.sums.filter("countedRows > 0 and subject is not null")
    postings = steps.postings.select("studentID", "subj_key").collect()
    assert found["students_without_id"] == 2
    assert found["transcript_rows"] == len(courses)
    assert found["transcript_without_student"] == sum(c[0] is None for c in courses)
    assert found["transcript_without_subject"] == sum(c[1] is None for c in courses)
    assert found["ledger_rows"] == len(ledger)
    assert found["several_full"] == sum(n > 1 for n in ledger.values()) > 0
    keys = {(r[0], r[1]) for r in counts.select("studentID", "subj_key").collect()}
    assert found["ledger_rows_counted"] == sum(n for key, n in ledger.items() if tuple(key) in keys)
    assert found["subjects_counted"] >= found["ledger_rows_counted"] - found["several_full"]
    assert found["dual_posting_sources"] == len(postings)
    assert found["dual_posting_rows"] == sum(ledger[tuple(p)] for p in postings)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_journal_leads_from_the_counted_to_the_settled_ledger(spark, seed):
    steps = Graduation(make_inputs(spark, *random_world(seed, 150)), YEAR, 0)
    moves = steps.journal.collect()
    assert {m.rule for m in moves} >= {journal.DONOR, journal.GROUP, journal.DUAL, journal.OVERFLOW}
    own = defaultdict(lambda: [0, 0])
    for r in steps.counted.collect():
        own[r.studentID, r.subj_key] = [r.semsComplete, r.semsInProgress]
    lost = Counter()
    for m in moves:
        for subject, sign, counts in ((m.fromSubject, -1, m.taken), (m.toSubject, 1, m.landed)):
            if counts:
                assert (m.studentID, subject) in own
                own[m.studentID, subject][0] += sign * m.semsComplete
                own[m.studentID, subject][1] += sign * m.semsInProgress
        if not m.landed:
            lost[m.studentID] += m.semsComplete + m.semsInProgress
    want = {(r.studentID, r.subj_key): [r.semsComplete, r.semsInProgress] for r in steps.settled.collect()}
    assert own == want
    found = journal.balances(steps.counted, steps.journal).collect()
    assert {(r.studentID, r.subj_key): [r.semsComplete, r.semsInProgress] for r in found} == want

    # Per student: what the ledger had, and came from outside, is in the ledger or lost.
    before, after, outside = Counter(), Counter(), Counter()
    for r in steps.counted.collect():
        before[r.studentID] += r.semsComplete + r.semsInProgress
    for (sid, _), (c, i) in want.items():
        after[sid] += c + i
    for m in moves:
        if not m.taken:
            outside[m.studentID] += m.semsComplete + m.semsInProgress
    for sid in before:
        assert before[sid] + outside[sid] == after[sid] + lost[sid]


def test_a_journal_where_members_do_not_add_up(spark):
    steps = Graduation(make_inputs(spark, *random_world(4, 120)), YEAR, 0, Rules(multi_match="min"))
    moves = journal.group_moves(steps.transferred, steps.rules)
    found = journal.balances(steps.transferred, moves)
    want = steps.grouped.select("studentID", "subj_key", "semsComplete", "semsInProgress")
    assert rows(found) == rows(want)
    with pytest.raises(ValueError, match="add up"):
        steps.journal
