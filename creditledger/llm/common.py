"""What several operators share: tables, words, and cut points."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors see: ``spark.checkpoint.dir``, else the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def session_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/llm/{spark.sparkContext.applicationId}"


def new_folder(spark: SparkSession) -> str:
    return f"{session_folder(spark)}/{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, so that a lost executor costs a read."""
    spark, path = df.sparkSession, new_folder(df.sparkSession)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_cut(df: DataFrame) -> None:
    """Remove the files of a table that ``cut`` wrote and that nothing reads any more."""
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        _remove(df.sparkSession, folder)


def clean(spark: SparkSession) -> None:
    """Remove all tables that this session has cut; results must have been written."""
    _remove(spark, session_folder(spark))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), 0)


def n_words_of(text: Column) -> Column:
    """The number of words of a text, as a long; 0 for null.

    Every white-space run is one space after the first replacement, so that counting words
    is counting spaces.
    """
    spaced = F.concat(F.lit(" "), F.regexp_replace(F.coalesce(text, F.lit("")), WORD, "x"))
    plain = F.translate(spaced, SPACES, "")
    return F.length(plain).cast("bigint")


def arrow_rows(spark: SparkSession, rows: int = 1000) -> None:
    """Set how many rows go to Python at once; with long texts, few, so that little is held.

    A setting of the session that stays, as plans read it when they run.  Results are the same
    with any number.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
