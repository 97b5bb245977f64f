"""The whole run against the per-student rules on random small worlds."""

from __future__ import annotations

from collections import defaultdict

import pytest

from brute_force import grade_student
from creditledger import Graduation, run
from worlds import YEAR, make_inputs, random_world

LABEL = {2: "on track", 1: "close", 0: "off track"}


def by_student(world, mid_year):
    students, reqs, courses, _ = world
    grades, taken = defaultdict(set), defaultdict(list)
    for sid, grade in students:
        grades[sid].add(grade)
    for sid, *course in courses:
        taken[sid].append(course)
    return {s: grade_student(grades[s], reqs, taken[s], YEAR, mid_year) for s in grades}


@pytest.mark.parametrize(("seed", "mid_year"), [(1, 0), (2, 1)])
def test_run_agrees_with_brute_force(spark, tmp_path, seed, mid_year):
    world = random_world(seed)
    want = by_student(world, mid_year)
    inputs = make_inputs(spark, *world)
    tables = (inputs.students, inputs.reqs, inputs.transcript, inputs.student_status)
    out = run(*tables, YEAR, mid_year, str(tmp_path))

    ledger = {
        (r.studentID, r.hsSubject.upper()): (
            r.semsComplete, r.semsInProgress, r.semsReqdGrade, r.semsReqdClose, r.semsReqdTotal,
            r.subjStatus,
        )
        for r in out.ledger.collect()
    }
    assert ledger == {
        (sid, k): (w["c"], w["i"], w["need"], w["close"], w["R"], LABEL[w["code"]])
        for sid, (rows, _, _) in want.items()
        for k, w in rows.items()
    }

    names = ("semsComplete", "semsInProgress", "primaryComplete", "primaryInProgress",
             "secondaryComplete", "secondaryInProgress", "semsCompleteGS", "semsInProgressGS",
             "overflowComplete", "overflowInProgress")
    short = ("C", "I", "pC", "pI", "sC", "sI", "gC", "gI", "oC", "oI")
    dual = {
        (r.studentID, r.subject.upper()): tuple(r[n] for n in names) for r in out.dual.collect()
    }
    expected_dual = {
        (sid, k): tuple(w[n] for n in short)
        for sid, (_, rows, _) in want.items()
        for k, w in rows.items()
    }
    # Students without a ledger keep their dual courses, all of it overflow.
    assert {k: v for k, v in dual.items() if want[k[0]][0]} == expected_dual

    # A cohort with both a "Total" and a "T" row gives two; the lower one counts.
    final = {}
    for r in out.final_status.collect():
        final[r.studentID] = min(r.finalStatus, final.get(r.studentID, 2))
    assert final == {sid: f for sid, (_, _, f) in want.items() if f is not None}
    status = {r.studentID: r.gradStatus for r in out.student_status.collect()}
    assert status == {
        sid: LABEL[want[sid][2]] if want[sid][2] is not None else "old"
        for sid, _ in world[3]
    }


def test_order_and_partitions_change_nothing(spark):
    world = random_world(3, 80)
    plain = make_inputs(spark, *world)
    shuffled = make_inputs(spark, world[0][::-1], world[1][::-1], world[2][::-1], world[3])
    one = Graduation(plain, YEAR, 0).settled
    other = Graduation(shuffled, YEAR, 0)
    other.inputs = type(plain)(
        shuffled.students.repartition(5),
        shuffled.reqs.coalesce(1),
        shuffled.transcript.repartition(13),
        shuffled.student_status,
    ).conformed()
    assert one.exceptAll(other.settled).count() == 0
    assert other.settled.exceptAll(one).count() == 0
