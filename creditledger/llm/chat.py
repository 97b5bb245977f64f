"""Chat formatting: collapse cumulative snapshots of conversations, then render the rest.

A service that logs a conversation after each exchange leaves many logs that are beginnings of
longer ones.  Every turn of a log gets the hash of the turns up to it, a running exclusive-or
of 128-bit turn hashes, each of which covers the turn's number, role and text.  A log whose
whole hash is the hash of a proper beginning of another log is dropped by an anti-join; of
logs with equal turns that of the smallest id stays.

Running hashes are taken inside ranges of the sorted rows, and the ranges before are added, so
that a log with a third of all rows is many tasks, whatever its turn numbers are.  The joined
tables hold one row for each different beginning, however many logs share it.  Rendering takes
different rows only, and at most ``BLOCK`` of them at once: a log of up to ``BLOCK`` turns is one
text, the turns of a longer one are numbered in sorted ranges as well, and every ``BLOCK`` of
them are a text, whatever their turn numbers are.  Ranges are drawn by number and the beginnings
of role and text; rows that agree in these are sorted in one task, with spilling.  The rows of
very long logs meet the list of kept logs by broadcast.

Built-in expressions only: no UDF, no pandas, no RDD.

Defined results: repeated rows of a log count once; rows with the same number are ordered by
role and text; a null number comes first; a null role or text is rendered as empty; all rows
with a null id are one log; an empty table gives an empty table.  Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.joins import split_join
from .common import cut, read, tasks

BLOCK = 1024
HASH = ("a", "b")
#: Characters of role and text that ranges are drawn by, so that the driver's sample stays small.
DRAWN = 64
TURN = ("conv_id", "turn", "role", "text")


def ranged(turns: DataFrame) -> DataFrame:
    """The hashes of the different turns, ``block`` being their place among even sorted ranges."""
    first = F.xxhash64("turn", "role", "text", F.isnull("role"), F.isnull("text"))
    second = F.xxhash64(F.lit("second"), "text", "role", "turn", F.isnull("turn"))
    hashed = turns.select("conv_id", "turn", first.alias("a"), second.alias("b")).distinct()
    hashed = hashed.repartitionByRange(tasks(turns.sparkSession), "conv_id", "turn", *HASH)
    return cut(hashed.withColumn("block", F.spark_partition_id()))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) to one row per turn: ``conv_id``, ``n``, ``a``, ``b``, ``all``.

    ``n`` turns have the hash (``a``, ``b``); ``all`` is the number of turns of the log.
    """
    hashed = ranged(turns)
    blocks = hashed.groupBy("conv_id", "block").agg(
        F.count(F.lit(1)).alias("rows"), *[F.bit_xor(h).alias(h) for h in HASH]
    )
    log = Window.partitionBy("conv_id")
    before = log.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    offsets = blocks.select(
        F.col("conv_id").alias("log"),
        F.col("block").alias("log_block"),
        F.coalesce(F.sum("rows").over(before), zero).alias("n0"),
        F.sum("rows").over(log).alias("all"),
        *[F.coalesce(F.bit_xor(h).over(before), zero).alias(f"{h}0") for h in HASH],
    )
    inside = (
        Window.partitionBy("conv_id", "block")
        .orderBy("turn", *HASH)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    running = hashed.select(
        "conv_id",
        "block",
        F.count(F.lit(1)).over(inside).alias("n1"),
        *[F.bit_xor(h).over(inside).alias(f"{h}1") for h in HASH],
    )
    same = F.col("conv_id").eqNullSafe(F.col("log")) & (F.col("block") == F.col("log_block"))
    return running.join(offsets, same).select(
        "conv_id",
        (F.col("n0") + F.col("n1")).alias("n"),
        *[F.col(f"{h}0").bitwiseXOR(F.col(f"{h}1")).alias(h) for h in HASH],
        "all",
    )


def maximal(turns: DataFrame) -> DataFrame:
    """The logs that are no beginning of another, and no copy of one with a smaller id.

    ``conv_id`` and ``all``, the number of the log's turns.
    """
    prefixes = cut(prefix_hashes(turns))
    key = ["n", *HASH]
    whole = prefixes.filter(F.col("n") == F.col("all"))
    whole = whole.groupBy(*key).agg(F.min("conv_id").alias("conv_id"))
    beginnings = prefixes.filter(F.col("n") < F.col("all")).select(*key).distinct()
    return whole.join(beginnings, key, "left_anti").select("conv_id", F.col("n").alias("all"))


def numbered(turns: DataFrame) -> DataFrame:
    """The different ``turns`` with ``part``, their place in the log divided by ``BLOCK``."""
    drawn = [F.substring(c, 1, DRAWN) for c in ("role", "text")]
    ranges = turns.distinct().repartitionByRange(tasks(turns.sparkSession), "conv_id", "turn", *drawn)
    rows = cut(ranges.withColumn("block", F.spark_partition_id()))
    counts = rows.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("rows"))
    earlier = (
        Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(
        F.col("conv_id").alias("log"),
        F.col("block").alias("log_block"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("before"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    same = F.col("conv_id").eqNullSafe(F.col("log")) & (F.col("block") == F.col("log_block"))
    placed = rows.withColumn("place", F.row_number().over(inside) - 1).join(offsets, same)
    part = F.floor((F.col("before") + F.col("place")) / BLOCK)
    return placed.select(*TURN, part.alias("part"))


def render(turns: DataFrame) -> DataFrame:
    """One text for each log and ``part``: ``conv_id``, ``part``, ``n_turns``, ``rendered``.

    Without a column ``part`` each log is one text.
    """
    empty = F.lit("")
    part = F.col("part") if "part" in turns.columns else F.lit(0)
    role, text = (F.coalesce(F.col(c), empty) for c in ("role", "text"))
    turn = F.concat(F.lit("<|im_start|>"), role, F.lit("\n"), text, F.lit("<|im_end|>\n"))
    row = F.struct("turn", "role", "text", turn.alias("rendered"))
    # A set, in every task before the shuffle: a row that was logged many times is held once.
    rows = F.array_distinct(F.sort_array(F.collect_set(row)))
    return (
        turns.groupBy("conv_id", part.cast("bigint").alias("part"))
        .agg(rows.alias("rows"))
        .select(
            "conv_id",
            "part",
            F.size("rows").cast("bigint").alias("n_turns"),
            F.concat_ws("", F.col("rows.rendered")).alias("rendered"),
        )
    )


def collapse_and_render(turns: DataFrame) -> DataFrame:
    """Render the maximal logs; ``turns`` has conv_id, turn, role and text."""
    turns = turns.select(*TURN)
    # A struct is never null: the rows without an id are a log like others.
    log = F.struct("conv_id").alias("log")
    kept = cut(maximal(turns).select(log, "all"))
    rows = split_join(turns.select(log, *TURN), kept, ["log"])
    short = rows.filter(F.col("all") <= BLOCK).select(*TURN, F.lit(0).cast("bigint").alias("part"))
    long = numbered(rows.filter(F.col("all") > BLOCK).select(*TURN))
    return render(short.unionByName(long))


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapse_and_render(read(spark, sf_dir, "conversations"))


OP1_SQL = r"""
WITH different AS (
  SELECT DISTINCT conv_id, turn, role, text FROM conversations
), turns AS (
  SELECT *, (row_number() OVER (
               PARTITION BY conv_id
               ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) - 1) // 1024 AS part
  FROM different
), logs AS (
  SELECT conv_id, count(*) AS n,
         list({'turn': turn, 'role': role, 'text': text}
              ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS body
  FROM turns GROUP BY conv_id
), beginnings AS (
  SELECT DISTINCT k AS n, body[1:k] AS body
  FROM (SELECT body, unnest(range(1, n)) AS k FROM logs)
), kept AS (
  SELECT min(conv_id) AS conv_id
  FROM (SELECT n, body, conv_id FROM logs) AS l ANTI JOIN beginnings USING (n, body)
  GROUP BY n, body
)
SELECT conv_id, part, count(*) AS n_turns,
       string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '')
                  || '<|im_end|>' || chr(10), ''
                  ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS rendered
FROM turns SEMI JOIN kept USING (conv_id)
GROUP BY conv_id, part
"""
