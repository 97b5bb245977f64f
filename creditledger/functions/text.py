from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Leading numeric part of a text mark; "85%" counts as 85, "A" as no number.
NUMBER_PREFIX = r"^\s*([-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?)"


def subject_key(subject: Column | str) -> Column:
    """Subjects are equal when their upper-case forms are."""
    return F.upper(subject)


def text_before(text: Column, separator: str) -> Column:
    return F.substring_index(text, separator, 1)


def text_after(text: Column, separator: str) -> Column:
    """Everything behind the first separator, later separators included."""
    return F.substring(text, F.instr(text, separator) + F.lit(len(separator)), F.length(text))


def mark_above_zero(mark: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        mark = F.regexp_extract(mark, NUMBER_PREFIX, 1).try_cast("double")
    return mark > 0
