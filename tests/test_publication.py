"""Publishing tables together: versions, failures in between, and what is rewritten."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from creditledger import run
from creditledger.sources import tables
from creditledger.sources.publication import MOST_BUCKETS, Publication, PublicationError
from worlds import YEAR, make_inputs, random_world

KEYS = {"a": "id", "b": "id"}


def rows(df) -> Counter:
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture
def published(spark, tmp_path):
    return Publication(spark, str(tmp_path / "out"), buckets=8)


def numbers(spark, n: int = 100, add: int = 0):
    return spark.range(n).select("id", (F.col("id") + add).alias("v"), F.lit(None).cast("string").alias("t"))


def failing(spark):
    return numbers(spark).withColumn("v", F.raise_error(F.lit("broken")).cast("bigint"))


def test_all_tables_or_none(spark, published):
    """A run that fails at its second table leaves both as they were."""
    assert published.current() is None and published.read_all() == {}
    first = {"a": numbers(spark), "b": numbers(spark, 10)}
    published.publish(first, KEYS)
    want = {name: rows(df) for name, df in first.items()}
    with pytest.raises(PySparkException, match="broken"):
        published.publish({"a": numbers(spark, 100, 5), "b": failing(spark)}, KEYS)
    assert {name: rows(df) for name, df in published.read_all().items()} == want
    assert published.current().version == 1
    published.publish({"a": numbers(spark, 100, 5)}, KEYS)
    assert rows(published.read("a")) == rows(numbers(spark, 100, 5))
    assert rows(published.read("b")) == want["b"]
    assert rows(published.read("a", version=1)) == want["a"]
    for wrong in (("c", None), ("a", 9)):
        with pytest.raises(PublicationError, match="no published table"):
            published.read(*wrong)


def test_a_manifest_that_was_not_written_to_its_end_is_passed_over(spark, published):
    published.publish({"a": numbers(spark)}, KEYS)
    manifests = Path(published.folder) / "manifests"
    whole = (manifests / "00000001.json").read_text()
    (manifests / "00000002.json").write_text(whole[: len(whole) // 2])
    (manifests / "00000003.json").write_text("")
    assert published.current().version == 1
    assert published.publish({"a": numbers(spark, 5)}, KEYS).version == 4
    assert rows(published.read("a")) == rows(numbers(spark, 5))


def test_of_two_runs_at_once_the_later_to_end_fails(spark, published, monkeypatch):
    published.publish({"a": numbers(spark)}, KEYS)
    written = Publication._written

    def slow(self, *args):
        monkeypatch.setattr(Publication, "_written", written)
        Publication(spark, published.folder, 8).publish({"a": numbers(spark, 7)}, KEYS)
        return written(self, *args)

    monkeypatch.setattr(Publication, "_written", slow)
    with pytest.raises(PublicationError, match="another run"):
        published.publish({"a": numbers(spark, 9)}, KEYS)
    assert rows(published.read("a")) == rows(numbers(spark, 7))


def files(folder: str) -> set[str]:
    return {str(p.relative_to(folder)) for p in Path(folder).rglob("*.parquet")}


def test_only_buckets_with_changed_rows_are_written(spark, published):
    before = published.publish({"a": numbers(spark), "b": numbers(spark)}, KEYS)
    there = files(published.folder)
    same = published.publish({"a": numbers(spark).repartition(3), "b": numbers(spark)}, KEYS)
    assert same.paths() == before.paths() and files(published.folder) == there

    changed = numbers(spark).withColumn("v", F.when(F.col("id") == 42, -1).otherwise(F.col("v")))
    after = published.publish({"a": changed}, KEYS)
    assert len(after.paths() - before.paths()) == 1
    (new,) = after.paths() - before.paths()
    assert {f for f in files(published.folder) - there} == {f for f in files(published.folder) if new in f}
    assert rows(published.read("a")) == rows(changed)
    assert rows(published.read("b")) == rows(numbers(spark))


def test_added_removed_and_moved_rows_are_seen(spark, published):
    base = spark.createDataFrame([(1, "x", None), (1, None, "x"), (2, "y", "y"), (None, "z", "z")], "id long, s string, t string")
    published.publish({"a": base}, KEYS)
    swapped = base.filter("id = 2 or id is null").unionByName(
        spark.createDataFrame([(1, "x", None), (1, "x", None)], base.schema)
    )
    versions = [swapped, base.unionByName(base), base.filter("id is not null"), base.limit(0), base]
    for rows_now in versions:
        published.publish({"a": rows_now}, KEYS)
        assert rows(published.read("a")) == rows(rows_now)


def test_another_schema_or_number_of_buckets_writes_all(spark, published):
    published.publish({"a": numbers(spark)}, KEYS)
    wider = numbers(spark).withColumn("more", F.lit(1.5))
    published.publish({"a": wider}, KEYS)
    assert published.read("a").columns == wider.columns and rows(published.read("a")) == rows(wider)
    other = Publication(spark, published.folder, buckets=3)
    assert len(other.publish({"a": wider}, KEYS).tables["a"].parts) == 3
    assert rows(published.read("a")) == rows(wider)
    for n in (0, MOST_BUCKETS + 1):
        with pytest.raises(ValueError, match="buckets"):
            Publication(spark, published.folder, n)


def test_vacuum_keeps_what_the_last_versions_name(spark, published):
    for add in range(4):
        published.publish({"a": numbers(spark, 100, add), "b": numbers(spark)}, KEYS)
    with pytest.raises(PySparkException):
        published.publish({"a": numbers(spark, 50), "b": failing(spark)}, KEYS)
    removed = published.vacuum(keep=2)
    assert published.versions() == [3, 4] and removed
    for version, add in ((3, 2), (4, 3)):
        assert rows(published.read("a", version)) == rows(numbers(spark, 100, add))
        assert rows(published.read("b", version)) == rows(numbers(spark))
    used = published.manifest(3).paths() | published.manifest(4).paths()
    assert {f.rpartition("/")[0] for f in files(published.folder)} == used
    with pytest.raises(ValueError, match="kept"):
        published.vacuum(0)


def test_one_changed_student_rewrites_one_bucket(spark, tmp_path):
    """Of every table of a run: the bucket of that student, or none."""
    students, reqs, courses, before = random_world(11, 60)

    def grade(courses, name: str):
        inputs = make_inputs(spark, students, reqs, courses, before)
        named = (inputs.students, inputs.reqs, inputs.transcript, inputs.student_status)
        with run(*named, YEAR, 0, str(tmp_path / name)) as out:
            made = tables.write_outputs(out, str(tmp_path / "out"), buckets=16)
            wanted = {t: rows(getattr(out, n)) for n, t in tables.OUTPUT_TABLES.items()}
        found = tables.read_outputs(spark, str(tmp_path / "out"))
        assert {t: rows(df) for t, df in found.items()} == wanted
        return made

    first = grade(courses, "one")
    sid = students[20][0]
    second = grade([*courses, (sid, "English", 11, 1, 4, 40.0, 40.0)], "two")
    changed = {
        (table, n)
        for table, t in second.tables.items()
        for n, part in t.parts.items()
        if part.path != first.tables[table].parts.get(n, part).path or n not in first.tables[table].parts
    }
    assert {"grad_sems"} <= {table for table, _ in changed}
    assert len({n for _, n in changed}) == 1
