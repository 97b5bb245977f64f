"""Input and ledger schemas, and the check made where tables enter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the inputs and of the ledger.
STUDENTS = {"studentID": T.LongType(), "grade": T.IntegerType()}
REQUIREMENTS = {
    "gradYear": T.StringType(),
    "semester": T.IntegerType(),
    "subject": T.StringType(),
    "semsReqd": T.IntegerType(),
    "semsClose": T.IntegerType(),
}
TRANSCRIPT = {
    "studentID": T.LongType(),
    "subject": T.StringType(),
    "studentGrade": T.IntegerType(),
    "semester": T.IntegerType(),
    "mark": (T.NumericType, T.StringType, T.NullType),  # NULL = in progress
    "earnedCredits": (T.NumericType,),  # decimal sums are exact in any order
    "attemptedCredits": (T.NumericType,),
}
STUDENT_STATUS = {"studentID": T.LongType(), "gradStatus": T.StringType()}

LEDGER = T.StructType(
    [
        T.StructField("studentID", T.LongType()),
        T.StructField("semester", T.IntegerType()),
        T.StructField("subject", T.StringType()),
        T.StructField("subj_key", T.StringType()),
        T.StructField("semsComplete", T.LongType()),
        T.StructField("semsInProgress", T.LongType()),
        T.StructField("semsReqdGrade", T.IntegerType()),
        T.StructField("semsClose", T.IntegerType()),
        T.StructField("semsReqdTotal", T.IntegerType()),
        T.StructField("subjOnTrack", T.IntegerType()),
        T.StructField("overallOnTrack", T.IntegerType()),
    ]
)


def check_ledger(ledger: DataFrame) -> DataFrame:
    """``ledger`` if its columns are the ledger's, in their types; looks at the schema only."""
    wanted = {f.name: f.dataType for f in LEDGER}
    wrong = [f.name for f in ledger.schema if wanted.get(f.name) != f.dataType]
    if wrong:
        raise TypeError(f"not columns of a ledger, or of another type: {wrong}")
    return ledger


def conform(df: DataFrame, wanted: dict, table: str) -> DataFrame:
    """Select the wanted columns in their types.

    A type means exactly that one, except that integers widen or narrow (an
    overflow fails under ANSI mode); a tuple lists the kinds a column may have.
    Any other difference is an error, since guessing would change results.
    """
    present = {f.name.lower(): f for f in df.schema.fields}
    missing = [name for name in wanted if name.lower() not in present]
    if missing:
        raise ValueError(f"{table}: missing columns {missing}")
    columns = []
    for name, dtype in wanted.items():
        have = present[name.lower()].dataType
        if isinstance(dtype, tuple):
            if not isinstance(have, dtype):
                raise TypeError(f"{table}.{name}: cannot use {have.simpleString()}")
            columns.append(F.col(name).alias(name))
            continue
        both_integral = isinstance(dtype, T.IntegralType) and isinstance(have, T.IntegralType)
        if have != dtype and not both_integral and not isinstance(have, T.NullType):
            raise TypeError(
                f"{table}.{name}: expected {dtype.simpleString()}, got {have.simpleString()}"
            )
        columns.append(F.col(name).cast(dtype).alias(name))
    return df.select(columns)
