"""Publishing tables together, and rewriting only what changed.

A publication is a folder with data and numbered manifests.  A manifest names, for every table
and key bucket, the folder that holds its rows; it is written last, so readers see all tables of
a version or none, and a run that fails leaves the version before in place.  A version keeps the
folders of buckets whose rows are what they were, and holds new ones for the others only.

Rows are compared by bucket: how many there are, and two sums of their hashes that do not depend
on their order.  These are kept in the manifest, so that the version before need not be read.

    folder/manifests/00000007.json     the versions; the highest that can be read is current
    folder/data/<run>/<table>/_bucket=<n>/   rows, written once and never changed

The manifest has one entry for each table and bucket, and so has what the driver collects: the
number of buckets bounds both, whatever the tables hold.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
MOST_BUCKETS = 4096
BUCKET = "_bucket"


class PublicationError(RuntimeError):
    """Another run has published in between, or a version is not there."""


@dataclass(frozen=True)
class Part:
    """The rows of one bucket of a table: where they are, and what they come to."""

    path: str
    rows: int
    total: str
    mixed: int

    def same_rows(self, other: Part | None) -> bool:
        return other is not None and (self.rows, self.total, self.mixed) == (
            other.rows, other.total, other.mixed,
        )


@dataclass(frozen=True)
class Table:
    key: str
    buckets: int
    schema: str
    parts: dict[int, Part]

    def comparable(self, other: Table | None) -> bool:
        return other is not None and (self.key, self.buckets, self.schema) == (
            other.key, other.buckets, other.schema,
        )


@dataclass(frozen=True)
class Manifest:
    version: int
    tables: dict[str, Table]

    def text(self) -> str:
        tables = {
            name: {
                "key": t.key, "buckets": t.buckets, "schema": json.loads(t.schema),
                "parts": {str(n): [p.path, p.rows, p.total, p.mixed] for n, p in t.parts.items()},
            }
            for name, t in self.tables.items()
        }
        return json.dumps({"version": self.version, "tables": tables, "whole": True})

    @staticmethod
    def parse(text: str) -> Manifest | None:
        """The manifest, or None where it was not written to its end."""
        try:
            found = json.loads(text)
        except ValueError:
            return None
        if not isinstance(found, dict) or not found.get("whole"):
            return None
        tables = {
            name: Table(
                t["key"], t["buckets"], json.dumps(t["schema"], sort_keys=True),
                {int(n): Part(*p) for n, p in t["parts"].items()},
            )
            for name, t in found["tables"].items()
        }
        return Manifest(found["version"], tables)

    def paths(self) -> set[str]:
        return {part.path for table in self.tables.values() for part in table.parts.values()}


class Publication:
    """The published versions of a set of tables."""

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS) -> None:
        if not 0 < buckets <= MOST_BUCKETS:
            raise ValueError(f"buckets must be between 1 and {MOST_BUCKETS}")
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    # --- files

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.folder, *parts)))

    def _files(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, *parts: str) -> list[str]:
        files, path = self._files(), self._path(*parts)
        if not files.exists(path):
            return []
        return [status.getPath().getName() for status in files.listStatus(path)]

    def _claim(self, version: int, text: str) -> None:
        """Create the manifest of a version; only one run can create it."""
        path = self._path("manifests", f"{version:08d}.json")
        try:
            out = self._files().create(path, False)
        except Py4JJavaError as error:
            raise PublicationError(f"version {version} was published by another run") from error
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    # --- reading

    def versions(self) -> list[int]:
        """The numbers of all manifests, whole or not, ascending."""
        found = [name.removesuffix(".json") for name in self._names("manifests")]
        return sorted(int(name) for name in found if name.isdigit())

    def manifest(self, version: int) -> Manifest | None:
        path = f"{self.folder}/manifests/{version:08d}.json"
        rows = self.spark.read.text(path, wholetext=True).collect()
        return Manifest.parse(rows[0][0]) if rows else None

    def current(self) -> Manifest | None:
        """The last version that was published whole."""
        for version in reversed(self.versions()):
            if found := self.manifest(version):
                return found
        return None

    def read(self, table: str, version: int | None = None) -> DataFrame:
        """A table as of a version, the current one by default."""
        known = version is None or version in self.versions()
        found = self.current() if version is None else self.manifest(version) if known else None
        if found is None or table not in found.tables:
            raise PublicationError(f"no published table {table!r}")
        return self._rows(found.tables[table])

    def read_all(self) -> dict[str, DataFrame]:
        """All tables of the current version, which one look at the manifests decides."""
        found = self.current()
        return {name: self._rows(table) for name, table in found.tables.items()} if found else {}

    def _rows(self, table: Table) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(table.schema))
        paths = sorted({f"{self.folder}/{part.path}" for part in table.parts.values()})
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # --- writing

    def publish(self, tables: dict[str, DataFrame], keys: dict[str, str]) -> Manifest:
        """Publish a new version; tables that are not given stay as they are.

        ``keys`` names the column whose hash tells a row's bucket.  Of a table that was published
        before, rows are compared first and those of changed buckets written then, so its
        DataFrame runs twice; a table that is new runs once.
        """
        numbers = self.versions()
        base = next((m for n in reversed(numbers) if (m := self.manifest(n))), None)
        run = f"data/{uuid.uuid4().hex}"
        done = dict(base.tables) if base else {}
        for name, df in tables.items():
            done[name] = self._written(df, keys[name], f"{run}/{name}", done.get(name))
        # A run that has published since made a manifest of this number: then this one is too late.
        made = Manifest((numbers[-1] if numbers else 0) + 1, done)
        self._claim(made.version, made.text())
        return made

    def _written(self, df: DataFrame, key: str, path: str, before: Table | None) -> Table:
        bucketed = df.withColumn(BUCKET, bucket_of(F.col(key), self.buckets))
        schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])
        own = Table(key, self.buckets, json.dumps(schema.jsonValue(), sort_keys=True), {})
        if not own.comparable(before):
            self._write(bucketed, path)
            # Read back, as one scan of what was written is less than the run again.
            if not self._names(path):
                return own
            whole = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
            files = self.spark.read.schema(whole).parquet(f"{self.folder}/{path}")
            return Table(key, own.buckets, own.schema, self._parts(files, path))
        found = self._parts(bucketed, path)
        changed = [n for n, part in found.items() if not part.same_rows(before.parts.get(n))]
        if changed:
            self._write(bucketed.filter(F.col(BUCKET).isin(changed)), path)
        parts = {n: part if n in set(changed) else before.parts[n] for n, part in found.items()}
        return Table(key, own.buckets, own.schema, parts)

    def _write(self, bucketed: DataFrame, path: str) -> None:
        """Rows of a bucket in few files; a large bucket in several, written by several tasks."""
        rows = bucketed.hint("rebalance", BUCKET)
        rows.write.partitionBy(BUCKET).parquet(f"{self.folder}/{path}")

    def _parts(self, bucketed: DataFrame, path: str) -> dict[int, Part]:
        columns = [c for c in bucketed.columns if c != BUCKET]
        sums = bucketed.groupBy(BUCKET).agg(*content_sums(columns))
        return {
            r[BUCKET]: Part(f"{path}/{BUCKET}={r[BUCKET]}", r.rows, str(r.total), r.mixed)
            for r in sums.collect()
        }

    # --- removing

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove data that the last ``keep`` whole versions do not name, and older manifests.

        Readers of removed versions fail, and so does a run that publishes meanwhile: vacuum
        when none does.  Returns the folders removed.
        """
        if keep < 1:
            raise ValueError("at least the current version is kept")
        numbers = self.versions()
        whole = [m for n in reversed(numbers) if (m := self.manifest(n))][:keep]
        used = {path for m in whole for path in m.paths()}
        removed, files = [], self._files()
        for n in numbers:
            if n not in {m.version for m in whole} and n < max((m.version for m in whole), default=0):
                files.delete(self._path("manifests", f"{n:08d}.json"), False)
        for run in self._names("data"):
            for table in self._names("data", run):
                for part in self._names("data", run, table):
                    path = f"data/{run}/{table}/{part}"
                    if part.startswith(f"{BUCKET}=") and path not in used:
                        files.delete(self._path(path), True)
                        removed.append(path)
        return removed


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def content_sums(columns: list[str]) -> list[Column]:
    """What the rows of a group come to, in any order: their number and two sums of hashes.

    Hashes pass nulls over, so where the nulls are is hashed as well.
    """
    values = [F.col(c) for c in columns] + [F.isnull(c) for c in columns]
    return [
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*values).cast("decimal(38,0)")).alias("total"),
        F.bit_xor(F.xxhash64(F.lit("second"), *reversed(values))).alias("mixed"),
    ]
