"""The totals that a separate per-student model gave for the derived inputs."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from creditledger import Graduation
from creditledger.sources import derived

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    made = Graduation(derived.inputs(spark, FOLDER), 2024, 0, folder=folder)
    yield made
    made.close()


def semesters(ledger):
    return tuple(ledger.agg(F.sum("semsComplete"), F.sum("semsInProgress")).first())


def codes(df, column):
    n = Counter(r[0] for r in df.select(column).collect())
    return n[0], n[1], n[2]


def test_ledger_rows(steps):
    assert steps.required.count() == 12_369
    students = steps.inputs.students.select("studentID").distinct().count()
    assert students - steps.required.select("studentID").distinct().count() == 188


def test_semesters_after_each_stage(steps):
    assert semesters(steps.counted) == (20_144, 5_220)
    assert semesters(steps.transferred) == (22_330, 5_764)
    assert semesters(steps.grouped) == semesters(steps.spilled) == (22_330, 5_764)
    assert semesters(steps.posted) == semesters(steps.settled) == (27_921, 7_302)


def test_codes_at_the_start_of_the_year(steps):
    assert codes(steps.graded, "subjOnTrack") == (1_206, 1_138, 10_025)
    assert codes(steps.final, "finalStatus") == (568, 370, 374)


def test_codes_at_mid_year(spark):
    later = Graduation(derived.inputs(spark, FOLDER), 2024, 1)
    assert codes(later.graded, "subjOnTrack") == (1_327, 1_120, 9_922)
    assert codes(later.final, "finalStatus") == (645, 331, 336)
