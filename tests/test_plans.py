"""The shape of the plans: what is scanned, moved and broadcast; and hot students."""

from __future__ import annotations

import contextlib
import io
import re
from collections import Counter
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from brute_force import grade_student
from creditledger import Graduation, Rules, configure, run
from creditledger.operators import credits, joins, status
from creditledger.sources import derived, tables
from worlds import YEAR, make_inputs, random_world

FOLDER = "/root/testdata/sf0.001"
NO_BROADCAST = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}


@pytest.fixture
def at_scale(spark):
    """Joins as they are planned when no side is known to be small."""
    before = {k: spark.conf.get(k, None) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan_of(df, run: bool = False) -> str:
    """The physical plan; after ``run``, the one that was executed."""
    if run:
        df.collect()
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain()
    return text.getvalue().split("Initial Plan")[0]


@pytest.fixture
def written(request, tmp_path):
    """Steps of a run that writes its tables, which are removed afterwards."""
    made = []

    def steps(inputs, **how):
        made.append(Graduation(inputs, YEAR, 0, folder=str(tmp_path), **how))
        return made[-1]

    yield steps
    for one in made:
        one.close()
    assert not list(tmp_path.rglob("*.parquet"))


@pytest.mark.parametrize("name", ["final_report", "status_publish", "dual_overflow", "credits_all"])
def test_no_nested_loops_and_no_python(spark, name):
    plan = plan_of(entry_points.queries()[name](spark, FOLDER), run=True)
    for bad in ("NestedLoop", "CartesianProduct", "Python", "Pandas"):
        assert bad not in plan


def test_transcript_is_read_once(spark, written):
    """The ledger reads the written sums only; the sums read the transcript once."""
    steps = written(derived.inputs(spark, FOLDER))
    assert "l_orderkey" not in plan_of(steps.settled)
    sums = plan_of(credits.course_sums(steps.inputs.transcript))
    assert len(re.findall(r"FileScan parquet \[l_orderkey", sums)) == 1


def test_sums_are_taken_before_the_shuffle(spark):
    steps = Graduation(derived.inputs(spark, FOLDER), YEAR, 0)
    plan = plan_of(credits.course_sums(steps.inputs.transcript))
    shuffle = plan.index("Exchange hashpartitioning(studentID")
    assert "SortAggregate" not in plan
    assert "partial_sum" in plan[shuffle:]


def shuffles(df) -> list[str]:
    """Hash keys of the executed shuffles of fact rows (requirements do not matter)."""
    moved = re.findall(r"[+:]- Exchange hashpartitioning\((.*?), \d+\)", plan_of(df, run=True))
    return sorted(re.sub(r"#\d+L?", "", m) for m in moved if m.startswith("studentID"))


def test_ledger_is_not_shuffled_between_steps(at_scale, written):
    steps = written(derived.inputs(at_scale, FOLDER))
    # Students and course sums, each once; joins, windows and the donor add none.
    assert shuffles(steps.spilled) == ["studentID"] * 2
    # The written ledger stays where it is.  Dual courses are hashed by course, counted by
    # student, moved to the student's needs, and their postings gathered.
    steps.snapshot
    own = shuffles(steps.graded)
    assert own == ["studentID"] * 2 + ["studentID, subj_key"] * 2
    assert shuffles(steps.final) == own


def test_asking_for_a_step_runs_nothing(spark):
    """Without a folder no job runs while plans are built, but the look at the requirements."""
    context = spark.sparkContext
    steps = Graduation(derived.inputs(spark, FOLDER), YEAR, 0)
    assert steps.small
    context.setJobGroup("plans only", "")
    try:
        assert steps.required.columns and steps.published(steps.final).columns
        assert list(context.statusTracker().getJobIdsForGroup("plans only")) == []
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)


def test_listed_students(at_scale):
    """Copies of a student, and a second grade, take the same way and the same shuffle."""
    inputs = derived.inputs(at_scale, FOLDER)
    once = Graduation(inputs, YEAR, 0)
    assert shuffles(once.required) == ["studentID"]

    copies = replace(inputs, students=inputs.students.unionByName(inputs.students))
    twice = Graduation(copies, YEAR, 0)
    assert shuffles(twice.required) == ["studentID"]

    # A grade without any full requirement adds none.
    other = inputs.students.withColumn("grade", F.lit(6)).filter("studentID < 40")
    two = Graduation(replace(inputs, students=inputs.students.unionByName(other)), YEAR, 0)
    assert shuffles(two.required) == ["studentID"]
    for more in (twice, two):
        seeds = more.required.select("studentID", "subj_key", "semsReqdTotal")
        want = once.required.select("studentID", "subj_key", "semsReqdTotal")
        assert seeds.exceptAll(want).count() == 0 and want.exceptAll(seeds).count() == 0
    assert twice.required.exceptAll(once.required).count() == 0


@pytest.fixture(scope="module")
def both_ways(spark, tmp_path_factory):
    inputs = derived.inputs(spark, FOLDER)
    lazy = Graduation(inputs, YEAR, 0)
    kept = Graduation(inputs, YEAR, 0, folder=str(tmp_path_factory.mktemp("kept")))
    yield lazy, kept
    kept.close()


@pytest.mark.parametrize("name", list(entry_points.QUERIES))
def test_queries_are_the_same_without_a_folder(both_ways, name):
    lazy, kept = (Counter(entry_points.QUERIES[name](g).collect()) for g in both_ways)
    assert lazy == kept and lazy


def hot_world():
    """One student holds most rows: many copies, and many distinct dual courses."""
    students, reqs, courses, before = random_world(5, 60)
    hot = students[0][0]
    students = [(s, 12 if s == hot else g) for s, g in students]
    names = ("English", "Mathematics", "Physical Science", "Biological Science", "Nothing")
    for n in range(3000):
        subject = f"{names[n % 5]}|{names[n % 3] if n % 2 else f'Topic {n}'}"
        courses.append((hot, subject, 10, 1, n % 4 if n % 3 else None, 5.0, 5.0))
        courses.append((hot, "English", 10, 1, 3, 0.0, 5.0))
    return students, reqs, courses, before, hot


def test_hot_student_is_split_and_complete(at_scale):
    students, reqs, courses, before, hot = hot_world()
    steps = Graduation(make_inputs(at_scale, students, reqs, courses, before), YEAR, 0)
    found = joins.hot_keys(steps.dual_split, ["studentID"]).collect()
    assert [r._hot.studentID for r in found] == [hot] and found[0]._parts >= 7 * 8
    got = {
        r.subj_key: (r.semsComplete, r.semsInProgress)
        for r in steps.settled.filter(F.col("studentID") == hot).collect()
    }
    own = [c[1:] for c in courses if c[0] == hot]
    ledger, duals, _ = grade_student({12}, reqs, own, YEAR, 0)
    assert got == {k: (w["c"], w["i"]) for k, w in ledger.items()}
    assert len(duals) > 1000


def sizes_of_tasks(df) -> list[int]:
    return [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]


@pytest.fixture
def many_partitions(at_scale):
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    before = {k: at_scale.conf.get(k, None) for k in names}
    at_scale.conf.set(names[0], "2100")
    at_scale.conf.set(names[1], "false")
    yield at_scale
    for k, v in before.items():
        at_scale.conf.unset(k) if v is None else at_scale.conf.set(k, v)


def test_every_hot_key_is_split(many_partitions):
    """Far more hot keys than a list would hold: none is left whole."""
    spark = many_partitions
    keys, copies = 1010, 40
    facts = spark.range(keys * copies).select((F.col("id") % keys).alias("k"), F.col("id").alias("n"))
    unknown = F.lit(None).cast("long").alias("k")
    facts = facts.unionByName(spark.range(keys * copies).select(unknown, F.col("id").alias("n")))
    lookup = spark.range(keys).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = joins.hot_keys(facts, ["k"]).collect()
    assert {r._hot.k for r in hot} == {*range(keys), None}
    joined = joins.spread_join(facts, lookup, ["k"], F.xxhash64("n"))
    want = facts.join(lookup, ["k"], "left").select("k", "n", "v")
    rows = joined.select("k", "n", "v")
    assert rows.exceptAll(want).count() == 0 and want.exceptAll(rows).count() == 0
    inner = joins.spread_join(facts, lookup, ["k"], F.xxhash64("n"), "inner")
    assert inner.count() == keys * copies


def test_hot_rows_meet_a_lookup_of_one_row_a_key_where_they_are(many_partitions):
    """As many hot keys again, and rows without a key: all are there, none has moved."""
    spark = many_partitions
    keys, copies = 1010, 40
    facts = spark.range(keys * copies).select((F.col("id") % keys).alias("k"), F.col("id").alias("n"))
    unknown = F.lit(None).cast("long").alias("k")
    facts = facts.unionByName(spark.range(keys * copies).select(unknown, F.col("id").alias("n")))
    facts = facts.unionByName(spark.range(keys, 3 * keys).select(F.col("id").alias("k"), F.lit(0).alias("n")))
    lookup = spark.range(2 * keys).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    joined = joins.split_join(facts, lookup, ["k"])
    want = facts.join(lookup, ["k"], "left").select("k", "n", "v")
    rows = joined.select("k", "n", "v")
    assert rows.exceptAll(want).count() == 0 and want.exceptAll(rows).count() == 0
    largest = max(sizes_of_tasks(joined))
    assert largest < 2 * facts.count() / facts.rdd.getNumPartitions()


def above(plan: str, text: str) -> list[str]:
    """The nodes above the first one with ``text``, from it up, until a join."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if text in line)
    depth, found = len(lines[at]) - len(lines[at].lstrip(" :+-*")), []
    for line in reversed(lines[:at]):
        own = len(line) - len(line.lstrip(" :+-*"))
        if own < depth:
            depth = own
            found.append(line)
            if "Join" in line:
                break
    return found


def test_the_written_ledger_does_not_move_to_its_dual_courses(at_scale, written):
    steps = written(derived.inputs(at_scale, FOLDER))
    steps.snapshot
    plan = plan_of(steps.dual, run=True)
    nodes = above(plan, "Bucketed: true")
    assert "SortMergeJoin" in nodes[-1] and "LeftOuter" in nodes[-1]
    assert not [node for node in nodes if "Exchange" in node]
    assert "_slot" not in plan


@pytest.mark.parametrize("name, ledgers", [("posting_journal", 4), ("journal_balances", 5)])
def test_a_journal_reads_written_ledgers_once(at_scale, name, ledgers):
    """Each part reads the version it works on, the dual courses are met twice; no step runs again."""
    plan = plan_of(entry_points.queries()[name](at_scale, FOLDER))
    assert "c_custkey" not in plan
    assert plan.count("Bucketed: true") == ledgers
    assert plan.count("FileScan parquet") == ledgers + 2


def test_a_bucketed_transcript_is_summed_up_where_it_is(at_scale, tmp_path):
    inputs = derived.inputs(at_scale, FOLDER)
    name = "transcript_in_buckets"
    tables.write_transcript(inputs.transcript, name, 16, str(tmp_path / "t"))
    try:
        for table, df in (("src_student", inputs.students), ("grad_reqs", inputs.reqs), ("student_status", inputs.student_status)):
            df.write.parquet(f"{tmp_path}/in/{table}")
        read = tables.read_inputs(at_scale, f"{tmp_path}/in", name)
        plain, kept = Graduation(inputs, YEAR, 0), Graduation(read, YEAR, 0)
        assert shuffles(plain.sums) and not shuffles(kept.sums)
        assert Counter(kept.sums.collect()) == Counter(plain.sums.collect())
        assert Counter(kept.final.collect()) == Counter(plain.final.collect())
    finally:
        at_scale.sql(f"drop table if exists {name}")


def test_salted_rows_spread_over_tasks(at_scale):
    """One key with half of all rows, and null keys with a third: no task has twice the mean."""
    at_scale.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sixth = F.col("id") % 6
        k = F.when(sixth < 3, 7).when(sixth < 5, F.lit(None)).otherwise(F.col("id"))
        facts = at_scale.range(0, 60000, 1, 16).select(k.alias("k"), F.lit("copy").alias("c"))
        lookup = at_scale.range(60000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
        for spread in (F.spark_partition_id(), F.xxhash64(F.rand(1))):
            joined = joins.spread_join(facts, lookup, ["k"], spread)
            sizes = sizes_of_tasks(joined)
            assert sum(sizes) == 60000
            assert max(sizes) < 2 * sum(sizes) / 8
    finally:
        at_scale.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_only_required_courses_move_to_their_student(at_scale):
    """A student's many dual courses must not all arrive in one ledger task."""
    students, reqs, courses, before, hot = hot_world()
    steps = Graduation(make_inputs(at_scale, students, reqs, courses, before), YEAR, 0)
    rows = credits.ledger_courses(steps.sums, steps.inputs.reqs, steps.rules, steps.small)
    assert rows.filter(F.col("studentID") == hot).count() <= 20
    assert steps.sums.filter(F.col("studentID") == hot).count() > 1000


def test_copies_of_a_status_row_are_all_published(spark):
    before = spark.createDataFrame(
        [(1, "old")] * 300 + [(2, "old"), (3, "old"), (None, "old")], "studentID long, gradStatus string"
    )
    final = spark.createDataFrame([(1, 2), (2, 0), (2, 1)], "studentID long, finalStatus int")
    rows = status.publish_student_status(before, final).groupBy("studentID", "gradStatus")
    assert {tuple(r) for r in rows.count().collect()} == {
        (1, "on track", 300),
        (2, "off track", 1),
        (3, "old", 1),
        (None, "old", 1),
    }


def test_many_copies_of_a_student_row_add_nothing(spark):
    students, reqs, courses, before = random_world(6, 30)
    once = Graduation(make_inputs(spark, students, reqs, courses, before), YEAR, 0, Rules())
    many = [*students, *[students[0]] * 500]
    again = Graduation(make_inputs(spark, many, reqs, courses, before), YEAR, 0, Rules())
    assert once.settled.exceptAll(again.settled).count() == 0
    assert again.settled.exceptAll(once.settled).count() == 0


def test_large_requirements_change_nothing(spark):
    world = random_world(7, 60)
    small = Graduation(make_inputs(spark, *world), YEAR, 0)
    large = Graduation(make_inputs(spark, *world), YEAR, 0)
    large.__dict__["small"] = False
    for name in ("graded", "final", "dual"):
        one, other = getattr(small, name), getattr(large, name)
        assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0
    assert "_slot" in plan_of(large.required)


def test_tables_round_trip(spark, tmp_path):
    world = random_world(8, 40)
    inputs = make_inputs(spark, *world)
    for name, table in tables.INPUT_TABLES.items():
        getattr(inputs, name).write.parquet(f"{tmp_path}/in/{table}")
    read = tables.read_inputs(spark, f"{tmp_path}/in")
    shared = tmp_path / "shared"
    named = (read.students, read.reqs, read.transcript, read.student_status)
    before = {t.name for t in spark.catalog.listTables()}
    with run(*named, YEAR, 0, str(shared)) as out:
        tables.write_outputs(out, f"{tmp_path}/out")
        assert list(shared.rglob("*.parquet"))
    assert not list(shared.rglob("*.parquet"))
    assert {t.name for t in spark.catalog.listTables()} == before
    written = tables.read_outputs(spark, f"{tmp_path}/out")
    assert set(written) == set(tables.OUTPUT_TABLES.values())
    with pytest.raises(ValueError, match="folder"):
        run(*named, YEAR, 0, "")
    report = written["grad_progress"]
    want = status.final_report(Graduation(inputs, YEAR, 0).graded)
    assert report.columns == want.columns
    assert report.exceptAll(want).count() == 0 and want.exceptAll(report).count() == 0
    published = written["student_status"]
    assert published.count() == inputs.student_status.count()


def test_shuffles_are_sized_by_the_transcript(spark):
    name = "spark.sql.shuffle.partitions"
    usual = spark.conf.get(name)
    try:
        configure(spark, transcript_bytes=1 << 20)
        assert spark.conf.get(name) == usual
        configure(spark, transcript_bytes=10 << 40)
        assert spark.conf.get(name) == "20480"
        configure(spark, transcript_bytes=100 * 10**12)
        assert spark.conf.get(name) == str(-(-100 * 10**12 // (512 << 20)))
    finally:
        spark.conf.set(name, usual)
