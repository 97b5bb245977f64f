"""Joins whose strategy depends on a measured size or a measured key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cohort import LONGEST_YEAR_TEXT

BROADCAST_BYTES = 64 << 20
#: Parts that an average partition's share of a hot key is cut into.  Parts are dealt by hash;
#: with so many, no task gets twice the mean.
PARTS = 16


def requirements_are_small(reqs: DataFrame, years: Sequence[str] | None = None) -> bool:
    """Whether every table derived from the requirements may be broadcast.

    Bounds the bytes of the largest derived table, the one with a row per
    requirement and year text, of ``years`` if given, by one aggregate over the requirements.
    """
    texts = F.coalesce(F.length("gradYear"), F.lit(0)) * LONGEST_YEAR_TEXT
    if years is not None:
        texts = F.least(texts, F.lit(len(years)))
    texts = 1 + texts
    width = F.lit(64) + F.coalesce(F.octet_length("subject"), F.lit(0)) * 2
    bound = reqs.agg(F.sum((texts * width).cast("bigint"))).first()[0]
    return (bound or 0) <= BROADCAST_BYTES


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(facts: DataFrame, on: list[str]) -> DataFrame:
    """Keys with more rows than an average partition, and into how many parts they go.

    All of them: as each has more than one partition's share of the rows, there
    are fewer than partitions, which bounds the table.  Null keys are keys too.
    """
    n = partitions(facts)
    counts = facts.groupBy(*on).agg(F.count(F.lit(1)).alias("rows"))
    total = counts.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).scalar()
    parts = F.ceil(F.col("rows") * n * PARTS / total).cast("int")
    return counts.filter(F.col("rows") * n > total).select(
        F.struct(*on).alias("_hot"), parts.alias("_parts")
    )


def split_join(facts: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    """Left join with a lookup of one row a key, in place but for the rows of hot keys.

    There are fewer hot keys than partitions, and the lookup has a row for each at most, so the
    rows of hot keys meet theirs by broadcast, wherever they are; all others are hashed on the
    key, and a lookup that is hashed on it already, as a bucketed table is, does not move.  Rows
    without a key match nothing and go the first way.
    """
    hot = F.broadcast(hot_keys(facts, on))
    is_hot = F.struct(*on).eqNullSafe(F.col("_hot"))
    known = lookup.dropna(subset=on)
    some_null = F.lit(False)
    for c in on:
        some_null = some_null | F.col(c).isNull()
    marked = facts.join(hot.withColumn("_is_hot", F.lit(True)), is_hot, "left")
    # One expression over both sides of the join: no part of it reaches ``facts``, whose shuffles
    # stay the same plan for hot and other rows and are run once.
    warm = F.coalesce(F.col("_is_hot"), some_null)
    own = facts.columns
    of_hot = known.join(hot, is_hot, "left_semi")
    cold = marked.filter(~warm).select(*own).join(known, on, "left")
    met = marked.filter(warm).select(*own).join(F.broadcast(of_hot), on, "left")
    return cold.unionByName(met)


def spread_join(
    facts: DataFrame, lookup: DataFrame, on: list[str], spread: Column, how: str = "left"
) -> DataFrame:
    """Join on ``on`` that splits the fact rows of every hot key over several tasks.

    For lookups that may have many rows a key; with one row a key ``split_join`` moves less.
    ``lookup`` is repeated for hot keys only, once for each part.  ``spread``
    deals the rows of a key: a hash of columns that tell its rows apart, or the
    input partition where rows may be plain copies; both are the same again when
    a lost task is repeated.  The salted key is one struct, so that a side
    already hashed on the key alone does not count as co-partitioned.  A null in
    the key matches nothing, but its rows are spread like others.
    """
    hot = F.broadcast(hot_keys(facts, on))

    def salted(rows: DataFrame, salt: Column) -> DataFrame:
        own = F.struct(*on)
        parts = F.coalesce("_parts", F.lit(1))
        marked = rows.join(hot, own.eqNullSafe(F.col("_hot")), "left").withColumn("_parts", parts)
        placed = marked.withColumn("_salt", salt)
        slot = F.struct(*[F.col(c) for c in on], F.col("_salt").cast("int").alias("salt"))
        return placed.withColumn("_slot", slot).drop("_hot", "_parts", "_salt")

    known = lookup.dropna(subset=on)
    left = salted(facts, F.pmod(spread, F.col("_parts")))
    every = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    return left.join(salted(known, every).drop(*on), "_slot", how).drop("_slot")


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: list[str],
    small: bool,
    spread_by: list[str],
    how: str = "inner",
) -> DataFrame:
    """Join on few distinct keys (grade, year, semester, subject).

    A small lookup is broadcast.  A large one cannot be, and hashing on so few
    keys would leave most tasks idle, so fact rows are spread.
    """
    if small:
        return facts.join(F.broadcast(lookup), on, how)
    joined = spread_join(facts, lookup, on, F.xxhash64(*spread_by), how)
    return joined.select(*on, *[c for c in joined.columns if c not in on])
