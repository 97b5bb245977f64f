"""Key checks and the update-by-key pattern."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from .checks import Checks
from .joins import spread_join

NO_CHECKS = Checks(on=False)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def refusing(df: DataFrame, problem: Column, message: str) -> DataFrame:
    """``df``, or a failing query where ``problem`` holds for a row.

    The check is a filter: it stays whichever columns are read, and if none are.
    """
    passes = F.when(problem, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))
    return df.filter(passes)


def parted(
    df: DataFrame, problem: Column, group: list[str], problem_column: str = "_problem"
) -> tuple[DataFrame, DataFrame]:
    """The rows of groups without a ``problem``, and the rows that have one.

    ``problem`` is NULL on rows without one.  Both sides read one plan, in which a window over
    ``group`` spreads the verdict: rows hashed on ``group`` stay where they are.
    """
    marked = df.withColumn(problem_column, problem)
    worst = F.max(problem_column).over(Window.partitionBy(*group))
    sound = marked.withColumn("_worst", worst).filter(F.col("_worst").isNull())
    return sound.drop("_worst", problem_column), marked.filter(F.col(problem_column).isNotNull())


def assert_unique(df: DataFrame, keys: list[str], message: str | None = None) -> DataFrame:
    """``df`` unchanged, or a failing query when two rows share a key."""
    copies = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    counted = df.withColumn("_copies", copies)
    text = message or f"duplicate keys {tuple(keys)}"
    return refusing(counted, F.col("_copies") > 1, text).drop("_copies")


def one_row_per_key(
    source: DataFrame, on: list[str], values: list[str], multi_match: str
) -> DataFrame:
    """Settle several source rows of one key: add them, take the least, or fail."""
    if multi_match == "sum":
        return source.groupBy(*on).agg(*[F.sum(v).alias(v) for v in values])
    least = F.min(F.struct(*values)).alias("least")
    if multi_match == "min":
        return source.groupBy(*on).agg(least).select(*on, "least.*")
    if multi_match == "error":
        return assert_unique(source, on, f"several source rows match one {tuple(on)}")
    raise ValueError(f"unknown multi_match {multi_match!r}")


def over_matches(value: Column, multi_match: str, group: WindowSpec) -> Column:
    """The same policies over a window; ``value`` is NULL on rows that do not match.

    With ``error`` the caller has refused groups with several matches.
    """
    return F.sum(value).over(group) if multi_match == "sum" else F.min(value).over(group)


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: list[str],
    assign: dict[str, str] | None = None,
    add: dict[str, str] | None = None,
    multi_match: str | None = "error",
    spread: Column | None = None,
    checks: Checks = NO_CHECKS,
    name: str = "updated",
) -> DataFrame:
    """Change columns of matching target rows; keep the others, never insert.

    ``assign`` replaces target columns by source columns, ``add`` increments
    them.  ``multi_match=None`` states that ``source`` has one row per key.
    ``spread`` deals the target rows of a key that has very many of them.  ``checks`` counts the
    source rows and the target rows changed, under ``name``.
    """
    assign, add = assign or {}, add or {}
    values = list(dict.fromkeys([*assign.values(), *add.values()]))
    if multi_match is not None:
        source = one_row_per_key(source, on, values, multi_match)
    source = source.select(*on, F.struct(*values).alias("_from"))
    source = checks.count(source, **{f"{name}_sources": F.lit(True)})
    matched = F.col("_from").isNotNull()
    types = {f.name: f.dataType for f in target.schema.fields}
    changed = {
        name: F.when(matched, F.col(f"_from.{value}")).otherwise(F.col(name))
        for name, value in assign.items()
    } | {
        name: F.when(matched, F.col(name) + F.col(f"_from.{value}")).otherwise(F.col(name))
        for name, value in add.items()
    }
    if spread is None:
        joined = target.join(source, on, "left")
    else:
        joined = spread_join(target, source, on, spread)
    joined = checks.count(joined, **{f"{name}_rows": matched})
    return joined.select(
        [
            changed[c].cast(types[c]).alias(c) if c in changed else F.col(c)
            for c in target.columns
        ]
    )
