"""Merkle manifest of a dataset: a hash tree of each source, a tree of their roots, and proofs.

A row is a leaf, the hash of its fields.  The leaves of a source, in the order of their ids, are
numbered from 0; runs of ``ARITY`` consecutive nodes become the hash of their digests, level by
level, until one node, the subroot, remains.  The subroots, in the order of their sources, are
the leaves of one more tree, which leads to the root.

Each level is one self-join on equal keys: a node computes the numbers of the nodes of its run,
``index XOR 1`` in a binary tree and its run's first number plus ``(slot + offset) mod arity``
otherwise, and finds each by its number.  Rows of slot zero then emit the parent.  What stands
left and right of a node is kept for its proof.  Nodes are hashed on their run once, joined and
grouped where they are; a run holds at most ``arity`` nodes, so no key is large whatever the
sizes of the sources are.

Numbers come from range-sorted rows: the place within a sorted partition, plus the rows of the
source in the partitions before.  The table of those sums has a row for each partition and one
for each source.  Every level, and the paths above it, are written to the shared folder.  On the way back down every node
appends the path of its parent, one join a level on the number of the run.  So a leaf meets its
path without a key that many leaves share, and nothing is gathered on the driver but the number
of nodes of the largest tree.

Defined results: a null field enters a leaf as ``-``; rows with equal ids, or without one (they
come first), are ordered by leaf, and repeated rows are leaves of their own; a null source is a
source of its own and the first; a null id is not tampered with; an empty table gives an empty
table.  Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut, read, tasks

ARITY = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Of so many ids by CRC one is tampered with.
TAMPER_EVERY = 5
#: ``monotonically_increasing_id`` keeps the place within the partition in its lower bits.
PLACE_BITS = 33
NO_BYTES = b""


def digest(*parts: Column) -> Column:
    """SHA-256 of texts, one after the other, as 32 bytes."""
    return F.unhex(F.sha2(F.concat(*parts), 256))


def as_text(value: Column) -> Column:
    return F.lower(F.hex(value))


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: each field as its length in bytes and its text, ``-`` if null."""
    texts = [f.cast("string") for f in fields]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return digest(*[F.coalesce(s, F.lit("-")) for s in sized])


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tampered(id_column: Column) -> Column:
    """Whether the row of an id is tampered with in the test of the manifest."""
    return F.coalesce(F.crc32(id_column.cast("string")) % TAMPER_EVERY == 0, F.lit(False))


@contextmanager
def hashed_in_place(spark: SparkSession) -> Iterator[None]:
    """Rows hashed on a run may be joined on run and index without moving again."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def numbered(rows: DataFrame, group: str | None, order: list[str]) -> DataFrame:
    """``rows`` with ``idx``, from 0 in each group, and ``n``, the rows of the group.

    Nulls come first, in the group as in the order.
    """
    n_parts = tasks(rows.sparkSession)
    keys = [F.col(c).asc_nulls_first() for c in ([group] if group else []) + order]
    ranged = rows.repartitionByRange(n_parts, *keys).sortWithinPartitions(*keys)
    placed = cut(ranged.withColumn("_place", F.monotonically_increasing_id()))
    place = F.col("_place")
    placed = placed.withColumns(
        {
            "_part": F.shiftright(place, PLACE_BITS),
            "_place": place.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)),
        }
    )
    own = [F.col(group)] if group else []
    sums = placed.groupBy(*own, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first")
    )
    whole = Window.partitionBy(*own)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        *[c.alias("_group") for c in own],
        F.col("_part").alias("_at"),
        (F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")).alias("_start"),
        F.sum("_rows").over(whole).alias("n"),
    )
    same = F.col("_part") == F.col("_at")
    if group:
        same = same & F.col(group).eqNullSafe(F.col("_group"))
    found = placed.join(starts, same)
    return found.select(*rows.columns, (F.col("_place") + F.col("_start")).alias("idx"), "n")


def sibling(arity: int, offset: Column) -> Column:
    """The number of the node that stands ``offset`` slots on in the node's run."""
    idx = F.col("idx")
    if arity == 2:
        return idx.bitwiseXOR(offset)
    return idx - idx % arity + (idx + offset) % arity


def with_siblings(nodes: DataFrame, arity: int) -> DataFrame:
    """``nodes`` (``tree``, ``n``, ``idx``, ``node``, ...) with ``left`` and ``right``, bytes.

    A node also finds itself, at offset zero, so that one that is alone in its run stays.
    """
    run = F.expr(f"idx div {arity}")
    placed = nodes.withColumn("run", run).repartition("tree", "run")
    offsets = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(arity - 1).cast("bigint")))
    asking = placed.withColumn("_offset", offsets)
    asking = asking.withColumn("_idx", sibling(arity, F.col("_offset"))).filter("_idx < n")
    asked = placed.select(
        "tree", "run", F.col("idx").alias("_idx"), F.struct("idx", "node").alias("_found")
    )
    own = placed.columns
    met = asking.join(asked, ["tree", "run", "_idx"]).groupBy(*own)
    rows = met.agg(F.sort_array(F.collect_list("_found")).alias("_run"))

    def joined(keep: Column) -> Column:
        return F.aggregate(
            F.filter("_run", lambda x: keep(x["idx"])),
            F.lit(NO_BYTES),
            lambda acc, x: F.concat(acc, x["node"]),
        )

    idx = F.col("idx")
    return rows.select(
        *own,
        joined(lambda i: i < idx).alias("left"),
        joined(lambda i: i > idx).alias("right"),
    )


def folded(node: Column, left: Column, right: Column) -> Column:
    """The digest of a run as text, from a node of it as text and what stands beside it."""
    return F.sha2(F.concat(as_text(left), node, as_text(right)), 256)


def climb(nodes: DataFrame, arity: int) -> tuple[list[DataFrame], DataFrame]:
    """All levels of a forest, and (``tree``, ``node``), the node that remains of each tree.

    A level has the nodes of the trees that have several nodes there, with their siblings.
    """
    levels, tops = [], []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most:
        tops.append(nodes.filter("n = 1").select("tree", "node"))
        if most == 1:
            break
        with hashed_in_place(nodes.sparkSession):
            levels.append(cut(with_siblings(nodes.filter("n > 1"), arity)))
        parents = levels[-1].filter(F.col("idx") % arity == 0)
        text = folded(as_text(F.col("node")), F.col("left"), F.col("right"))
        nodes = parents.select(
            "tree",
            F.expr(f"(n + {arity - 1}) div {arity}").alias("n"),
            F.col("run").alias("idx"),
            F.unhex(text).alias("node"),
        )
        most = -(-most // arity)
    empty = nodes.select("tree", "node").filter("1 = 0")
    return levels, reduce(DataFrame.unionByName, tops, empty)


def descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The path of every node of the lowest level, given (``tree``, ``path``, ...) of the tops.

    A path lists, from the node up, what stands left and right of it; a node that is a top
    itself, in a tree of one, has its top's path.  Other columns of the tops come along.
    """
    carried = [c for c in tops.columns if c not in ("tree", "path")]
    above = tops.withColumn("_run", F.lit(0).cast("bigint"))
    for level in reversed(levels):
        own = F.array(F.struct("left", "right"))
        found = level.join(above.withColumnRenamed("_run", "run"), ["tree", "run"])
        here = found.withColumn("path", F.concat(own, "path"))
        if level is levels[0]:
            return here
        # Of trees that end at this height only the top is there, which keeps its path.
        high = here.select("tree", F.col("idx").alias("_run"), "path", *carried)
        ended = above.join(level.select("tree").filter("idx = 0"), "tree", "left_anti")
        above = cut(high.unionByName(ended.select(*high.columns)))
    return tops


def manifest(
    docs: DataFrame,
    id_column: str = "doc_id",
    source: str = "source",
    fields: tuple[str, ...] = FIELDS,
    changed: dict[str, Column] | None = None,
    where: Column | None = None,
    arity: int = ARITY,
) -> DataFrame:
    """One row for each row: ``id``, ``tree``, ``idx``, ``leaf``, ``subroot``, ``root``,
    ``path`` and ``other``, the leaf as it would be with ``changed`` columns ``where`` is true.

    ``path`` lists the digests left and right of the leaf and of each node above it.
    """
    changed = changed or {}
    own = [F.col(c) for c in fields]
    other = leaf([changed.get(c, F.col(c)) for c in fields])
    leaves = docs.select(
        F.col(source).alias("source"),
        F.col(id_column).alias("id"),
        leaf(own).alias("node"),
        F.when(F.lit(False) if where is None else where, other).alias("other"),
    )
    rows = cut(numbered(cut(leaves), "source", ["id", "node"]))
    sources = numbered(rows.filter("idx = 0").select("source"), None, ["source"])
    trees = cut(sources.select("source", F.col("idx").alias("tree")))
    same = F.col("source").eqNullSafe(F.col("_source"))
    named = trees.withColumnRenamed("source", "_source")
    nodes = cut(rows.join(named, same).drop("source", "_source"))

    levels, subroots = climb(nodes, arity)
    subroots = cut(subroots)
    count = subroots.count()
    top = subroots.select(
        F.lit(0).cast("bigint").alias("tree"),
        F.lit(count).cast("bigint").alias("n"),
        F.col("tree").alias("idx"),
        "node",
    )
    high, root = climb(top, arity)
    no_path = F.array().cast("array<struct<left: binary, right: binary>>")
    root = root.select("tree", no_path.alias("path"), F.col("node").alias("root"))
    paths = descend(high, root)
    if high:
        paths = paths.select(F.col("idx").alias("tree"), "path", "root")
    paths = cut(subroots.withColumnRenamed("node", "subroot").join(paths, "tree"))
    ends = ["subroot", "root", "path"]
    columns = ["id", "tree", "idx", F.col("node").alias("leaf"), "other", *ends]
    alone = nodes.filter("n = 1").join(paths, "tree").select(*columns)
    if not levels:
        return alone
    return descend(levels, paths).select(*columns).unionByName(alone)


def proof_digest(path: Column) -> Column:
    """SHA-256, as text, of all digests of a path as text."""
    texts = F.transform(path, lambda s: F.concat(as_text(s["left"]), as_text(s["right"])))
    return F.sha2(F.concat_ws("", texts), 256)


def recomputed_root(node: Column, path: Column) -> Column:
    """The root, as text, that a leaf and its path lead to."""
    return F.aggregate(path, as_text(node), lambda acc, s: folded(acc, s["left"], s["right"]))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    rows = manifest(
        docs, changed={"text": lowered(F.col("text"))}, where=tampered(F.col("doc_id"))
    )
    seen = recomputed_root(F.coalesce("other", "leaf"), F.col("path"))
    shown = rows.select(
        F.col("id").alias("doc_id"),
        *[as_text(F.col(c)).alias(c) for c in ("leaf", "subroot", "root")],
        proof_digest(F.col("path")).alias("proof_sha256"),
        seen.alias("folded_root"),
    )
    return shown.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _sql_leaf(text: str) -> str:
    named = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return f"sha256({' || '.join(map(_sql_field, named))})"


_BYTES = "list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP11_SQL = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, source, {_sql_leaf("text")} AS leaf,
         CASE WHEN xor(list_reduce(list_prepend(4294967295::BIGINT, {_BYTES}),
                lambda crc, byte: xor(crc >> 8, list_reduce(
                  list_prepend(xor(crc, byte) & 255, list_value(0::BIGINT, 0, 0, 0, 0, 0, 0, 0)),
                  lambda c, bit: xor(c >> 1, (c & 1) * 3988292384)))), 4294967295)
              % {TAMPER_EVERY} = 0
              THEN {_sql_leaf(_LOWER)}
         END AS other
  FROM documents
), leaves AS (
  SELECT row_number() OVER () AS row, doc_id, leaf, other,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
         count(*) OVER (PARTITION BY source) AS n
  FROM hashed
), up AS (
  SELECT 0 AS level, tree, idx, n, leaf AS node FROM leaves
  UNION ALL
  SELECT level + 1, tree, idx // {ARITY}, (n + {ARITY - 1}) // {ARITY},
         sha256(string_agg(node, '' ORDER BY idx))
  FROM up WHERE n > 1 GROUP BY level, tree, idx // {ARITY}, n
), top AS (
  SELECT 0 AS level, tree AS idx, count(*) OVER () AS n, node FROM up WHERE n = 1
  UNION ALL
  SELECT level + 1, idx // {ARITY}, (n + {ARITY - 1}) // {ARITY},
         sha256(string_agg(node, '' ORDER BY idx))
  FROM top WHERE n > 1 GROUP BY level, idx // {ARITY}, n
), nodes AS (
  SELECT 0 AS part, level, tree, idx, n, node FROM up
  UNION ALL SELECT 1, level, 0, idx, n, node FROM top
), beside AS (
  SELECT part, level, tree, a.idx,
         coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
         coalesce(string_agg(b.node, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
  FROM (SELECT *, idx // {ARITY} AS run FROM nodes WHERE n > 1) a
  JOIN (SELECT *, idx // {ARITY} AS run FROM nodes WHERE n > 1) b USING (part, level, tree, run)
  GROUP BY part, level, tree, a.idx
), below AS (
  SELECT row, 0 AS level, tree, idx, n, coalesce(other, leaf) AS node, '' AS proof FROM leaves
  UNION ALL
  SELECT row, f.level + 1, f.tree, f.idx // {ARITY}, (f.n + {ARITY - 1}) // {ARITY},
         sha256(l || node || r), proof || l || r
  FROM below f JOIN beside s
    ON s.part = 0 AND s.level = f.level AND s.tree = f.tree AND s.idx = f.idx
  WHERE f.n > 1
), above AS (
  SELECT row, 0 AS level, tree AS idx, (SELECT count(*) FROM up WHERE n = 1) AS n, node, proof
  FROM below WHERE n = 1
  UNION ALL
  SELECT row, f.level + 1, f.idx // {ARITY}, (f.n + {ARITY - 1}) // {ARITY},
         sha256(l || node || r), proof || l || r
  FROM above f JOIN beside s ON s.part = 1 AND s.level = f.level AND s.idx = f.idx
  WHERE f.n > 1
)
SELECT d.doc_id, d.leaf, s.node AS subroot, t.node AS root, sha256(proof) AS proof_sha256,
       a.node AS folded_root, a.node = t.node AS verified
FROM leaves d
JOIN above a ON a.row = d.row AND a.n = 1
JOIN up s ON s.tree = d.tree AND s.n = 1
JOIN top t ON t.n = 1
"""
