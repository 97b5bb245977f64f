"""Reading the four input tables and writing the results, as parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.graduation import Inputs, Outputs
from .publication import BUCKETS, Manifest, Publication

# Table names of the inputs and outputs.
INPUT_TABLES = {
    "students": "src_student",
    "reqs": "grad_reqs",
    "transcript": "Transcript",
    "student_status": "student_status",
}
OUTPUT_TABLES = {
    "ledger": "grad_progress",
    "student_status": "student_status",
    "final_status": "final_grad_status",
    "totals": "grad_total_sems",
    "overflow": "grad_subj_overflow",
    "dual": "dual_courses",
    "counts": "grad_sems",
    "total_status": "total_grad_sems_status",
    "second_overflow": "grad_subj_overflow2",
    "lost": "lost_semesters",
    "refused": "refused_students",
    "journal": "posting_journal",
}


def read_inputs(spark: SparkSession, folder: str, transcript_table: str | None = None) -> Inputs:
    """The input tables as parquet in ``folder``.

    ``transcript_table`` names a catalog table that is read instead of the transcript there.
    Kept in buckets of ``studentID``, see ``write_transcript``, it is summed up where it is.
    """

    def read(name: str) -> DataFrame:
        if name == "transcript" and transcript_table:
            return spark.table(transcript_table)
        return spark.read.parquet(f"{folder.rstrip('/')}/{INPUT_TABLES[name]}")

    return Inputs(**{name: read(name) for name in INPUT_TABLES}).conformed()


def write_transcript(transcript: DataFrame, table: str, buckets: int, path: str | None = None) -> None:
    """Keep a transcript as a catalog table in buckets of ``studentID``, sorted by it.

    Every run that reads the table is spared the shuffle of the largest input.  Choose as many
    buckets as tasks that a bucket's share of the rows should fit.
    """
    rows = transcript.repartition(buckets, "studentID")
    writer = rows.write.format("parquet").bucketBy(buckets, "studentID").sortBy("studentID")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def write_outputs(outputs: Outputs, folder: str, buckets: int = BUCKETS) -> Manifest:
    """Publish all output tables together, as a new version of the publication in ``folder``.

    Only buckets of students with changed rows are written; readers see the version before until
    all tables are there, also if the run fails.
    """
    tables = {table: getattr(outputs, name) for name, table in OUTPUT_TABLES.items()}
    present = {name: df for name, df in tables.items() if df is not None}
    keys = dict.fromkeys(present, "studentID")
    return Publication(outputs.ledger.sparkSession, folder, buckets).publish(present, keys)


def read_outputs(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All output tables by their table names, as of the last version published whole."""
    return Publication(spark, folder).read_all()
