"""Mixing sources to target weights: cut every source at its budget of words.

Sources, in code point order with null last, weigh 5, 2, 1, repeating, and share the words of
all documents by weight; a target stops at three times its source's words, and the excess goes
to the others by weight until none is above.  Each document gets a hash-random key.  Within a
source the documents are ordered by key, a prefix sum of words gives each its place, and the
budget, the target rounded down, is filled in that order: whole epochs first, then the part of
the next epoch that is left, where the last document may be taken in part.

The order is cut into ranges of the key, as many for a source as its rows ask for, so that a
source with a third of all rows is many ranges.  Running sums are taken inside a range, and
the sums of the ranges before it are added: no source meets in one task.  The table of ranges
has one row for each source and about four for each shuffle partition.

Built-in expressions only: no UDF, no pandas, no RDD.  Rows that are equal in id and text have
the same key and meet in one range.

Defined results: a null or empty text has size 0 and takes nothing; a null source is a source
of its own; null ids are ordered by their text; an empty table gives an empty table.  Other
columns are left alone; working columns are named ``_mix...``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, n_words_of, read, tasks

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
RANGES_PER_TASK = 4


def random_key(seed: int, id_column: Column, text: Column) -> Column:
    """A hash of id and text as hexadecimal digits, evenly spread and equal on every run."""
    parts = [F.lit(str(seed)), F.coalesce(id_column.cast("string"), F.lit(""))]
    return F.md5(F.concat_ws(":", *parts, F.coalesce(text, F.lit(""))))


def ranked(sources: DataFrame, key: str) -> DataFrame:
    """``sources`` with ``_mix_rank`` from 0 in the order of ``key``, null last.

    Range-partitioned, ranked inside each partition, and raised by the rows before it.
    """
    order = F.col(key).asc_nulls_last()
    ranged = cut(
        sources.repartitionByRange(tasks(sources.sparkSession), order).withColumn(
            "_mix_part", F.spark_partition_id()
        )
    )
    rows = ranged.groupBy("_mix_part").agg(F.count(F.lit(1)).alias("_mix_rows"))
    earlier = Window.orderBy("_mix_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_mix_rows").over(earlier), F.lit(0))
    offsets = rows.select("_mix_part", before.alias("_mix_before"))
    inside = F.row_number().over(Window.partitionBy("_mix_part").orderBy(order)) - 1
    placed = ranged.withColumn("_mix_inside", inside).join(offsets, "_mix_part")
    rank = F.col("_mix_inside") + F.col("_mix_before")
    return placed.withColumn("_mix_rank", rank).drop("_mix_part", "_mix_inside", "_mix_before")


def targets(sources: DataFrame, source: str, weights=WEIGHTS) -> DataFrame:
    """``sources`` (``source``, ``_mix_words``, ...) with ``_mix_target``.

    A target is the least of the source's cap and weight times a common share.  The share grows
    from round to round as capped sources leave their excess to the others; each round is one
    aggregate that returns two numbers, and sources once capped stay so.
    """
    choices = F.array(*[F.lit(float(w)) for w in weights])
    place = F.pmod(F.col("_mix_rank"), F.lit(len(weights))).cast("int")
    weighed = ranked(sources, source).withColumn("_mix_weight", F.get(choices, place))
    weighed = cut(weighed.withColumn("_mix_cap", F.col("_mix_words").cast("double") * MOST_EPOCHS))
    total = weighed.agg(F.sum("_mix_words")).first()[0] or 0
    share = None
    while True:
        capped = F.lit(False) if share is None else F.col("_mix_cap") < F.col("_mix_weight") * share
        used, weight = weighed.agg(
            F.sum(F.when(capped, F.col("_mix_cap")).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("_mix_weight"))),
        ).first()
        new = (total - used) / weight if weight else share or 0.0
        if new == share:
            break
        share = new
    target = F.least("_mix_cap", F.col("_mix_weight") * F.lit(share))
    return weighed.withColumn("_mix_target", target).drop("_mix_rank", "_mix_weight", "_mix_cap")


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 0,
    narrow: bool = False,
) -> DataFrame:
    """``docs`` with a struct ``_mix``: ``size``, ``source_size``, ``target``, ``taken``.

    With ``narrow`` only the id, the source and ``_mix`` come back, and the texts are read once.
    """
    sized = docs.withColumns(
        {
            "_mix_size": n_words_of(F.col(text)),
            "_mix_key": random_key(seed, F.col(id_column), F.col(text)),
        }
    )
    rows = cut(sized.select(id_column, source, "_mix_size", "_mix_key"))
    sources = rows.groupBy(source).agg(
        F.sum("_mix_size").alias("_mix_words"), F.count(F.lit(1)).alias("_mix_docs")
    )
    aimed = targets(sources, source)
    all_docs = aimed.agg(F.sum("_mix_docs")).first()[0] or 0
    range_rows = max(1, -(-all_docs // (RANGES_PER_TASK * tasks(docs.sparkSession))))
    ranges = F.ceil(F.col("_mix_docs") / F.lit(range_rows))
    aimed = cut(aimed.withColumn("_mix_ranges", ranges).withColumnRenamed(source, "_mix_source"))

    fraction = F.conv(F.substring("_mix_key", 1, 8), 16, 10).cast("double") / F.lit(2.0**32)
    same_source = F.col(source).eqNullSafe(F.col("_mix_source"))

    def in_ranges(df: DataFrame) -> DataFrame:
        at = F.floor(fraction * F.col("_mix_ranges")).alias("_mix_range")
        return df.join(aimed, same_source).withColumn("_mix_range", at)

    sums = in_ranges(rows).groupBy("_mix_source", "_mix_range").agg(F.sum("_mix_size").alias("n"))
    earlier = (
        Window.partitionBy("_mix_source")
        .orderBy("_mix_range")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = cut(
        sums.select(
            F.col("_mix_source").alias("_mix_s"),
            F.col("_mix_range").alias("_mix_r"),
            F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_mix_before"),
        )
    )
    inside = (
        Window.partitionBy("_mix_source", "_mix_range")
        .orderBy("_mix_key", "_mix_size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    size = F.col("_mix_size")
    placed = in_ranges(rows if narrow else sized).withColumn("_mix_to", F.sum(size).over(inside))
    same_range = F.col("_mix_source").eqNullSafe(F.col("_mix_s")) & (
        F.col("_mix_range") == F.col("_mix_r")
    )
    placed = placed.join(offsets, same_range)
    start = F.col("_mix_before") + F.col("_mix_to") - size
    words, budget = F.col("_mix_words"), F.floor("_mix_target")
    epochs = F.when(words > 0, F.floor(budget / words)).otherwise(F.lit(0))
    left = budget - epochs * words
    last = F.least(size, F.greatest(left - start, F.lit(0).cast("bigint")))
    result = F.struct(
        size.alias("size"),
        words.alias("source_size"),
        F.col("_mix_target").alias("target"),
        (epochs * size + last).cast("bigint").alias("taken"),
    )
    keep = [id_column, source] if narrow else docs.columns
    return placed.withColumn("_mix", result).select(*keep, "_mix")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(read(spark, sf_dir, "documents"), narrow=True)
    return mixed.select("doc_id", "_mix.*")


OP6_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS k
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS words,
         row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM sized GROUP BY source
), weighed AS (
  SELECT source, words, words * 3.0::DOUBLE AS cap,
         [5, 2, 1][1 + place % 3]::DOUBLE AS weight
  FROM sources
), levels AS (
  SELECT cap / weight AS level,
         (sum(words) OVER () - coalesce(sum(cap) OVER before, 0))
           / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS share
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), aimed AS (
  SELECT source, words,
         least(cap, weight * (SELECT arg_min(share, level) FROM levels WHERE level >= share)) AS target
  FROM weighed
), placed AS (
  SELECT doc_id, size, words, target,
         sum(size) OVER (PARTITION BY s.source ORDER BY k, size
                         ROWS UNBOUNDED PRECEDING) - size AS start,
         floor(target) AS budget
  FROM sized s JOIN aimed a ON s.source IS NOT DISTINCT FROM a.source
)
SELECT doc_id, size, words AS source_size, target,
       CASE WHEN words = 0 THEN 0 ELSE
         floor(budget / words) * size
         + least(size, greatest(budget - floor(budget / words) * words - start, 0))
       END::BIGINT AS taken
FROM placed
"""
