"""Small hand-made and random inputs."""

from __future__ import annotations

import random

from pyspark.sql import SparkSession

from creditledger import Inputs

YEAR = 2024


def make_inputs(spark: SparkSession, students, reqs, courses, status=()) -> Inputs:
    """``courses``: (student, subject, taken_in, term, mark, earned, attempted)."""
    return Inputs(
        spark.createDataFrame(students, "studentID long, grade int"),
        spark.createDataFrame(
            reqs, "gradYear string, semester int, subject string, semsReqd int, semsClose int"
        ),
        spark.createDataFrame(
            courses,
            "studentID long, subject string, studentGrade int, semester int, mark int,"
            " earnedCredits double, attemptedCredits double",
        ),
        spark.createDataFrame(list(status), "studentID long, gradStatus string"),
    )


SUBJECTS = (
    "English",
    "Algebra I",
    "Mathematics",
    "Biological Science",
    "Physical Science",
    "General Science",
    "World History",
    "Electives",
    "T",
)
EXTRA = ("Algebra II", "ALGEBRA ii", "Art", "Foreign Languange", "english", "electives")


def random_world(seed: int, n_students: int = 250):
    """Cohorts that miss some subjects; students with odd grades and odd courses."""
    rnd = random.Random(seed)
    reqs = []
    for grad_year in range(2021, 2032):
        cohort = rnd.choice((f"{grad_year}", f"class of {grad_year}", f"{grad_year};1900"))
        for subject in SUBJECTS:
            if rnd.random() < 0.2:
                continue
            full = rnd.randint(0, 4)
            spelled = rnd.choice((subject, subject.upper()))
            for semester in range(1, 9):
                if semester == 8 or rnd.random() < 0.9:
                    due = full * semester // 8
                    reqs.append((cohort, semester, spelled, due, max(due - 1, 0)))
        for semester in range(1, 9):
            if rnd.random() < 0.8:
                due = rnd.randint(0, 12)
                reqs.append((cohort, semester, "Total", due, due - rnd.randint(0, 4)))
    reqs.append((None, 8, "Lost", 1, 1))
    students, courses = [], []
    singles = SUBJECTS[:-1] + EXTRA
    for sid in range(n_students):
        students.append((sid, rnd.choice((None, 6, 8, 8, 9, 9, 10, 10, 11, 11, 12, 12, 13))))
        if rnd.random() < 0.1:
            students.append(students[-1])
        for _ in range(rnd.randint(0, 40)):
            subject = rnd.choice(singles)
            if rnd.random() < 0.35:
                subject += "|" + rnd.choice(singles)
            if rnd.random() < 0.02:
                subject = rnd.choice((None, "|English", "Algebra I|", "A|B|C", subject + "|x"))
            courses.append(
                (
                    sid,
                    subject,
                    rnd.choice((None, 7, 8, 8, 9, 10, 11, 12)),
                    rnd.choice((1, 2, 3, 3)),
                    rnd.choice((None, None, 0, 1, 2, 3, 4)),
                    rnd.choice((None, 0.0, 2.5, 5.0, 5.0, 10.0)),
                    rnd.choice((None, 2.5, 5.0, 5.0)),
                )
            )
    status = [(sid, "old") for sid, _ in dict(students).items() if sid % 7]
    return students, reqs, courses, status
