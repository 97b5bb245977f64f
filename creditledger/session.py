"""Session settings the plans rely on, and the cut points between stages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rows hashed on studentID alone may join on (studentID, subj_key) in place.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}


BYTES_PER_PARTITION = 512 << 20


def configure(spark: SparkSession, transcript_bytes: int | None = None) -> SparkSession:
    """Apply the settings; results are the same without them, only slower.

    Given the size of the transcript, shuffles start with enough partitions for
    each to fit a task; adaptive execution merges those that turn out small.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if transcript_bytes is not None:
        usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
        sized = -(-transcript_bytes // BYTES_PER_PARTITION)
        spark.conf.set("spark.sql.shuffle.partitions", str(max(usual, sized)))
    return spark


def shared_folder(spark: SparkSession) -> str | None:
    """The folder the cluster names for data that must outlive an executor, if it names one."""
    return spark.conf.get("spark.checkpoint.dir", None) or None


class Scratch:
    """Tables written between the stages of one run, in a folder of their own.

    A lost executor then costs a read, not a recomputation.  Without a folder
    nothing is written and plans stay lazy from end to end.  ``close`` removes
    the folder; use as a context manager to remove it after a failure, too.
    """

    def __init__(self, spark: SparkSession, folder: str | None) -> None:
        self.spark = spark
        self.root = folder and f"{folder.rstrip('/')}/creditledger/{uuid.uuid4().hex}"
        self.names: list[str] = []

    def cut(self, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it back, as a columnar table."""
        if not self.root:
            return df
        path = f"{self.root}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def cut_hashed(self, df: DataFrame, key: str) -> DataFrame:
        """The same in buckets of ``key``: joins and groups on it need no shuffle.

        ``df`` should be hashed on ``key`` into the session's number of shuffle
        partitions already; a task then writes the buckets it has.
        """
        if not self.root:
            return df
        name = f"creditledger_{uuid.uuid4().hex}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        writer = df.write.format("parquet").option("path", f"{self.root}/{name}")
        writer.bucketBy(buckets, key).saveAsTable(name)
        self.names.append(name)
        return self.spark.table(name)

    def close(self) -> None:
        for name in self.names:
            self.spark.sql(f"drop table if exists {name}")
        self.names.clear()
        if self.root:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()
