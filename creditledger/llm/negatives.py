"""Hard negatives: rows of another label in a window of scores below a positive's.

An anchor's positives are the other rows of its label with the highest scores, its negatives, for
each positive, the highest-scored rows of other labels whose score lies between two shares of the
positive's.  A score is the inner product of the components times 256, rounded down.

The search tree is a multiway hyperplane tree: a node has up to ``DEGREE`` split points, far from
each other, and every row belongs to the child of its nearest one.  Split points and rows get one
more component that gives all the same length, so a score window is a ring around the anchor.
Each split point stores, for every sibling subtree, the range of distances from itself to the
rows there.  A subtree is left out when for some split point that range does not meet the ring as seen from
it: ring and range are annuli around two centres whose distance is known.  What remains is
scored exactly, in whole numbers, in the leaves.

The tree's split points come from a sample of at most ``SAMPLE_ROWS`` rows, those with the
smallest hashes of their ids; ranges and leaves cover all rows.  The sample also bounds the
search: the k-th best score an anchor has there raises its window's lower end.  Leaves go to
tiles of bounded size, several small ones to one, a large one to several.  An anchor is sent to
the tiles that have a leaf it cannot leave out; a task holds one tile, reads the anchors one
batch after the other, and returns the best of each window.  With vectors that have no structure
hardly any leaf is left out, and the work is that of all anchors and all rows.

Of rows with equal vectors and labels only the ``COPIES`` with the smallest ids can be among the
first, so no more of them are stored, however many there are; each is still an anchor.

Defined results: rows without an id take no part; of rows with the same id the least in label and
vector does; a missing component of a shorter vector counts as 0; vectors so long that scores
would not fit 62 bits (a length of 8 million) take no part.  Equal scores are ordered by id.  An
empty table gives an empty table.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_rows, cut, read, tasks

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LEAST_SHARE, MOST_SHARE = 3, 9  # tenths of the positive's score
ANCHOR_EVERY = 100
COPIES = max(POSITIVES + 1, NEGATIVES)
DEGREE = 16
LEAF_ROWS = 256
MOST_LEVELS = 3
SAMPLE_ROWS = 8192
SAMPLE_VALUES = 1 << 22
TILE_ROWS = 1 << 16
LEAST_TILE = 1024
BATCH = 256
LONGEST = float(1 << 62)
EXACT = float(1 << 53)
FAR = 1 << 62
WINDOW = "array<struct<key: bigint, base: bigint, lo: bigint, hi: bigint>>"


# --- rows -------------------------------------------------------------------------------


def length_bound(vector: Column) -> Column:
    """At least the squared length of the scaled vector."""

    def square(total: Column, x: Column) -> Column:
        one = F.abs(x.cast("double")) * SCALE + 1.0
        return total + one * one

    return F.aggregate(vector, F.lit(0.0), square)


def usable(rows: DataFrame, id_column: str, label: str, vector: str) -> DataFrame:
    """(``id``, ``label``, ``vector``): rows that take part, one for each id."""
    own = rows.select(
        F.col(id_column).cast("bigint").alias("id"),
        F.col(label).cast("bigint").alias("label"),
        F.col(vector).alias("vector"),
    )
    odd = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = own.dropna().filter(~odd).filter(length_bound(F.col("vector")) < LONGEST)
    least = known.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("own"))
    return least.select("id", "own.*")


def stored_rows(rows: DataFrame) -> DataFrame:
    """Of rows with equal vectors and labels the first; tasks drop the others before the shuffle."""
    same = Window.partitionBy("vector", "label").orderBy("id")
    first = rows.withColumn("_place", F.row_number().over(same)).filter(F.col("_place") <= COPIES)
    return first.drop("_place")


def scaled(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as whole numbers, in doubles, shorter ones filled up with zeros."""
    out = np.zeros((len(column), dims))
    values = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(float) * SCALE)
    sizes = np.diff(column.offsets.to_numpy()) if len(column) else np.zeros(0, int)
    out[np.arange(dims)[None, :] < sizes[:, None]] = values
    return out


def scores(asking: np.ndarray, rows: np.ndarray, longest: float) -> np.ndarray:
    """Exact inner products: in doubles while all sums are below 2^53, else in 64-bit integers."""
    if longest < EXACT:
        return (asking @ rows.T).astype(np.int64)
    return asking.astype(np.int64) @ rows.astype(np.int64).T


def firsts(own: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` allowed columns of each row by score; of equal ones those further left."""
    if own.shape[1] <= k:
        return allowed
    least = np.iinfo(np.int64).min
    seen = np.where(allowed, own, least)
    edge = np.partition(seen, own.shape[1] - k, axis=1)[:, own.shape[1] - k, None]
    above = seen > edge
    ties = allowed & (seen == edge)
    room = k - above.sum(axis=1, keepdims=True)
    return above | (ties & (np.cumsum(ties, axis=1) <= room))


# --- the tree ---------------------------------------------------------------------------


def lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """Vectors with one more component, so that all are as long as the longest."""
    rest = np.sqrt(np.maximum(0.0, longest - (rows * rows).sum(axis=1)))
    return np.concatenate([rows, rest[:, None]], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(0.0, square))


@dataclass
class Node:
    points: np.ndarray
    #: Numbers of the children: nodes, or leaves as ``-1 - leaf``.
    children: list[int] = field(default_factory=list)
    #: ``low[i, j]``, ``high[i, j]``: from split point i to the rows of child j.
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def far_apart(rows: np.ndarray, k: int) -> np.ndarray:
    """Places of up to ``k`` different rows, each the furthest from those before."""
    places = [0]
    away = distances(rows, rows[:1])[:, 0]
    while len(places) < k and away.max() > 0:
        places.append(int(away.argmax()))
        away = np.minimum(away, distances(rows, rows[places[-1:]])[:, 0])
    return np.array(places)


class Tree:
    """Nodes from the root, ``nodes[0]``, down; a tree without nodes has one leaf."""

    def __init__(self, sample: np.ndarray, levels: int, longest: float) -> None:
        self.longest, self.nodes, self.leaves = longest, [], 0
        self.root = self._grow(lifted(sample, longest), levels)

    def _grow(self, rows: np.ndarray, levels: int) -> int:
        if not levels or len(rows) < 2 * DEGREE:
            self.leaves += 1
            return -self.leaves
        node = Node(rows[far_apart(rows, DEGREE)])
        k = len(node.points)
        node.low, node.high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        number = len(self.nodes)
        self.nodes.append(node)
        nearest = distances(rows, node.points).argmin(axis=1)
        for j in range(k):
            node.children.append(self._grow(rows[nearest == j], levels - 1 if k > 1 else 0))
        return number

    def place(self, rows: np.ndarray, see=None) -> np.ndarray:
        """The leaf of each row; ``see(node, distances, children)`` is told of each node."""
        own = lifted(rows, self.longest)
        leaf = np.zeros(len(own), np.int64)

        def down(number: int, at: np.ndarray) -> None:
            if number < 0:
                leaf[at] = -1 - number
                return
            node = self.nodes[number]
            away = distances(own[at], node.points)
            nearest = away.argmin(axis=1)
            if see:
                see(number, away, nearest)
            for j in np.unique(nearest):
                down(node.children[j], at[nearest == j])

        if len(own):
            down(self.root, np.arange(len(own)))
        return leaf

    def alive(self, asking: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Which leaves (columns) can hold a row whose score with the asking one is in its window."""
        flat = np.concatenate([asking, np.zeros((len(asking), 1))], axis=1)
        both = (asking * asking).sum(axis=1) + self.longest
        near = np.sqrt(np.maximum(0.0, both - 2.0 * hi))
        far = np.sqrt(np.maximum(0.0, both - 2.0 * lo))
        slack = 1e-5 * np.sqrt(self.longest) + 1e-9
        found = np.zeros((len(asking), self.leaves), bool)

        def down(number: int, at: np.ndarray) -> None:
            if not len(at):
                return
            if number < 0:
                found[at, -1 - number] = True
                return
            node = self.nodes[number]
            away = distances(flat[at], node.points)[:, :, None]
            inner = np.maximum(near[at, None, None] - away, away - far[at, None, None]) - slack
            outer = away + far[at, None, None] + slack
            meets = ((node.high[None] >= inner) & (node.low[None] <= outer)).all(axis=1)
            for j, child in enumerate(node.children):
                down(child, at[meets[:, j]])

        # No row has a score beyond the product of the lengths, nor one in an empty window.
        most = np.sqrt((asking * asking).sum(axis=1) * self.longest) * (1 + 1e-9) + 1
        real = (lo <= hi) & (lo <= most) & (hi >= -most)
        down(self.root, np.flatnonzero(real))
        return found


def grown(rows: DataFrame, dims: int, count: int, longest: float):
    """The tree, with ranges of all ``rows``, the rows with their ``leaf``, and the sample."""
    limit = min(SAMPLE_ROWS, max(2 * DEGREE, SAMPLE_VALUES // max(1, dims)))
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(limit).toArrow().combine_chunks()
    batch = picked.to_batches()[0] if picked.num_rows else None
    vectors = scaled(batch.column("vector"), dims) if batch else np.zeros((0, dims))
    levels = 0
    while levels < MOST_LEVELS and count > LEAF_ROWS * DEGREE**levels:
        levels += 1
    tree = Tree(vectors, levels, longest)
    kind = rows.schema["vector"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in batches:
            leaf = tree.place(scaled(own.column("vector"), dims))
            columns = [*own.columns, pa.array(leaf)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "vector", "leaf"])

    schema = f"id bigint, label bigint, vector {kind}, leaf bigint"
    placed = cut(rows.select("id", "label", "vector").mapInArrow(place, schema))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """For each node the nearest and furthest row of each child from each split point."""
        low = [np.full_like(n.low, np.inf) for n in tree.nodes]
        high = [np.full_like(n.high, -np.inf) for n in tree.nodes]

        def see(number: int, away: np.ndarray, nearest: np.ndarray) -> None:
            for j in np.unique(nearest):
                part = away[nearest == j]
                low[number][:, j] = np.minimum(low[number][:, j], part.min(axis=0))
                high[number][:, j] = np.maximum(high[number][:, j], part.max(axis=0))

        for own in batches:
            tree.place(scaled(own.column("vector"), dims), see)
        for number, (a, b) in enumerate(zip(low, high, strict=True)):
            i, j = np.nonzero(a <= b)
            yield pa.RecordBatch.from_pydict(
                {"node": pa.array(np.full(len(i), number)), "i": pa.array(i), "j": pa.array(j),
                 "low": pa.array(a[i, j]), "high": pa.array(b[i, j])}
            )

    if tree.nodes:
        seen = placed.mapInArrow(ranges, "node bigint, i bigint, j bigint, low double, high double")
        ends = seen.groupBy("node", "i", "j").agg(F.min("low").alias("low"), F.max("high").alias("high"))
        for r in ends.collect():  # at most DEGREE ** (MOST_LEVELS + 1) rows or so
            tree.nodes[r.node].low[r.i, r.j], tree.nodes[r.node].high[r.i, r.j] = r.low, r.high
    sample = (
        np.array(batch.column("id").to_pylist() if batch else [], np.int64),
        np.array(batch.column("label").to_pylist() if batch else [], np.int64),
        vectors,
    )
    return tree, placed, sample


# --- the search -------------------------------------------------------------------------


@dataclass
class Index:
    """A tree over all rows, and the rows in tiles."""

    tree: Tree
    rows: DataFrame
    sample: tuple[np.ndarray, np.ndarray, np.ndarray]
    dims: int
    #: The first tile of each leaf, and how many it has.
    first: np.ndarray
    parts: np.ndarray


def indexed(rows: DataFrame) -> Index:
    """Index ``rows`` (``id``, ``label``, ``vector``)."""
    facts = rows.agg(
        F.count(F.lit(1)), F.max(F.size("vector")), F.max(length_bound(F.col("vector")))
    ).first()
    count, dims, longest = facts[0], max(1, facts[1] or 1), facts[2] or 1.0
    tree, placed, sample = grown(rows, dims, count, longest)
    sizes = np.zeros(tree.leaves, np.int64)
    for row in placed.groupBy("leaf").count().collect():  # one row for each leaf
        sizes[row.leaf] = row["count"]
    room = max(LEAST_TILE, min(TILE_ROWS, -(-count // tasks(rows.sparkSession))))
    first, parts = np.zeros(tree.leaves, np.int64), np.ones(tree.leaves, np.int64)
    tile, used = 0, 0
    for leaf, size in enumerate(sizes):
        if used and used + size > room:
            tile, used = tile + 1, 0
        first[leaf], parts[leaf] = tile, max(1, -(-size // room))
        used += size
        if parts[leaf] > 1:
            tile, used = tile + parts[leaf], 0
    return Index(tree, placed, sample, dims, first, parts)


def raised(index_sample, asking, ids, labels, windows, same: bool, k: int, longest: float):
    """Lower ends of the windows, raised to the k-th best score that the sample has in them."""
    own_ids, own_labels, vectors = index_sample
    if len(own_ids) < k:
        return windows
    for at in range(0, len(asking), BATCH):
        part = slice(at, at + BATCH)
        seen = scores(asking[part], vectors, longest)
        fits = (own_labels[None, :] == labels[part, None]) == same
        fits &= own_ids[None, :] != ids[part, None]
        for i, own in enumerate(windows[part]):
            for w in own:
                met = seen[i][fits[i] & (seen[i] >= w["lo"]) & (seen[i] <= w["hi"])]
                if len(met) >= k:
                    w["lo"] = int(np.partition(met, len(met) - k)[len(met) - k])
    return windows


def hull(windows: list[list[dict]]) -> tuple[np.ndarray, np.ndarray]:
    lo = np.array([min((w["lo"] for w in own), default=1) for own in windows], float)
    hi = np.array([max((w["hi"] for w in own), default=0) for own in windows], float)
    return lo, hi


def search(index: Index, asks: DataFrame, same: bool, k: int) -> DataFrame:
    """The ``k`` first rows of each window of ``asks`` (``id``, ``label``, ``vector``, ``windows``).

    Rows of the same label or, without ``same``, of others; never the asking row itself.  Returns
    ``id``, ``key``, ``base``, ``other``, ``score`` and ``rank``, from 1.
    """
    tree, dims, sample, longest = index.tree, index.dims, index.sample, index.tree.longest
    first, parts = index.first, index.parts
    n_tiles = int((first + parts).max()) if len(first) else 1
    kind = index.rows.schema["vector"].dataType.simpleString()
    names = ["tile", "stored", "leaf", "id", "label", "vector", "windows"]
    window_type = pa.list_(pa.struct([(f, pa.int64()) for f in ("key", "base", "lo", "hi")]))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """To every tile that has a leaf which cannot be left out."""
        for batch in batches:
            asking = scaled(batch.column("vector"), dims)
            ids, labels = (
                np.array(batch.column(c).to_pylist(), np.int64) for c in ("id", "label")
            )
            windows = batch.column("windows").to_pylist()
            windows = raised(sample, asking, ids, labels, windows, same, k, longest)
            leaves = tree.alive(asking, *hull(windows))
            to = np.zeros((len(asking), n_tiles), bool)
            for leaf in range(tree.leaves):
                to[:, first[leaf] : first[leaf] + parts[leaf]] |= leaves[:, leaf : leaf + 1]
            at, tile = np.nonzero(to)
            for cut_at in range(0, len(at), 4 * BATCH):
                rows, own = at[cut_at : cut_at + 4 * BATCH], tile[cut_at : cut_at + 4 * BATCH]
                picked = batch.take(pa.array(rows))
                shown = pa.array([windows[i] for i in rows], window_type)
                columns = [
                    pa.array(own), pa.array(np.zeros(len(rows), bool)), pa.array(np.zeros(len(rows), int)),
                    *(picked.column(c) for c in ("id", "label", "vector")), shown,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    tiles = F.array([F.lit(int(t)) for t in first]), F.array([F.lit(int(p)) for p in parts])
    leaf = F.col("leaf").cast("int")
    spread = F.pmod(F.xxhash64("id"), F.get(tiles[1], leaf))
    kept = index.rows.select(
        (F.get(tiles[0], leaf) + spread).cast("bigint").alias("tile"),
        F.lit(True).alias("stored"),
        "leaf",
        "id",
        "label",
        "vector",
        F.lit(None).cast(WINDOW).alias("windows"),
    )
    schema = f"tile bigint, stored boolean, leaf bigint, id bigint, label bigint, vector {kind}, windows {WINDOW}"
    sent = asks.select("id", "label", "vector", "windows").mapInArrow(send, schema)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by (``tile``, stored ones first, ``leaf``, ``id``) to the first of each window."""
        key, held, block = None, [], None
        for batch in batches:
            tile = batch.column("tile").to_numpy(zero_copy_only=False)
            stored = batch.column("stored").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((tile[1:] != tile[:-1]) | (stored[1:] != stored[:-1])) + 1
            for a, b in zip([0, *edges], [*edges, len(tile)], strict=True):
                if a == b:
                    continue
                if tile[a] != key:
                    key, held, block = tile[a], [], None
                own = batch.slice(a, b - a)
                ids, labels = (
                    own.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label")
                )
                vectors = scaled(own.column("vector"), dims)
                if stored[a]:
                    leaf = own.column("leaf").to_numpy(zero_copy_only=False)
                    held.append((leaf, ids, labels, vectors))
                elif held:
                    block = block or [np.concatenate(x) for x in zip(*held, strict=True)]
                    windows = own.column("windows").to_pylist()
                    for at in range(0, len(ids), BATCH):
                        s = slice(at, at + BATCH)
                        yield asked(block, ids[s], labels[s], vectors[s], windows[s])

    def asked(block, ids, labels, vectors, windows) -> pa.RecordBatch:
        leaf, own_ids, own_labels, rows = block
        alive = tree.alive(vectors, *hull(windows))
        most = max((len(w) for w in windows), default=0)
        ends = np.zeros((2, len(ids), most), np.int64)
        ends[0] = 1
        for i, own in enumerate(windows):
            for j, w in enumerate(own):
                ends[:, i, j] = w["lo"], w["hi"]
        found = [np.zeros((0, 4), np.int64)]
        edges = np.flatnonzero(leaf[1:] != leaf[:-1]) + 1
        for a, b in zip([0, *edges], [*edges, len(leaf)], strict=True):
            at = np.flatnonzero(alive[:, leaf[a]])
            if not len(at):
                continue
            seen = scores(vectors[at], rows[a:b], longest)
            fits = (own_labels[None, a:b] == labels[at, None]) == same
            fits &= own_ids[None, a:b] != ids[at, None]
            for j in range(most):
                lo, hi = ends[0, at, j, None], ends[1, at, j, None]
                i, c = np.nonzero(firsts(seen, fits & (seen >= lo) & (seen <= hi), k))
                found.append(np.stack([at[i], np.full(len(i), j), -seen[i, c], own_ids[a:b][c]], axis=1))
        rows_found = np.concatenate(found)
        rows_found = rows_found[np.lexsort(rows_found.T[::-1])]
        # The first k of each window among the leaves of the tile.
        new = np.r_[True, (rows_found[1:, :2] != rows_found[:-1, :2]).any(axis=1)] if len(rows_found) else []
        starts = np.maximum.accumulate(np.where(new, np.arange(len(rows_found)), 0)) if len(rows_found) else 0
        rows_found = rows_found[np.arange(len(rows_found)) - starts < k]
        picked = [windows[i][j] for i, j in rows_found[:, :2]]
        return pa.RecordBatch.from_pydict(
            {
                "id": pa.array(ids[rows_found[:, 0]], pa.int64()),
                "key": pa.array([w["key"] for w in picked], pa.int64()),
                "base": pa.array([w["base"] for w in picked], pa.int64()),
                "other": pa.array(rows_found[:, 3], pa.int64()),
                "score": pa.array(-rows_found[:, 2], pa.int64()),
            }
        )

    dealt = kept.unionByName(sent).repartition(max(n_tiles, tasks(asks.sparkSession)), "tile")
    ordered = dealt.sortWithinPartitions("tile", F.desc("stored"), "leaf", "id")
    best = ordered.mapInArrow(meet, "id bigint, key bigint, base bigint, other bigint, score bigint")
    order = Window.partitionBy("id", "key").orderBy(F.desc("score"), "other")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mined(
    rows: DataFrame,
    id_column: str = "id",
    label: str = "label",
    vector: str = "vector",
    anchors: Column | None = None,
) -> DataFrame:
    """(``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``).

    ``anchors``, a condition on ``id``, tells which rows are asked for; all are by default.
    """
    arrow_rows(rows.sparkSession, 4096)
    known = cut(usable(rows, id_column, label, vector))
    index = indexed(cut(stored_rows(known)))
    asking = known if anchors is None else known.filter(anchors)

    def windows(*values: Column) -> Column:
        named = [v.cast("bigint").alias(n) for v, n in zip(values, ("key", "base", "lo", "hi"), strict=True)]
        return F.struct(*named)

    everything = F.array(windows(F.lit(0), F.lit(0), F.lit(-FAR), F.lit(FAR)))
    positives = search(index, asking.withColumn("windows", everything), True, POSITIVES)
    tens = F.expr("score div 10")
    lo = tens * LEAST_SHARE + F.expr(f"((score % 10) * {LEAST_SHARE} + 9) div 10")
    hi = tens * MOST_SHARE + F.expr(f"((score % 10) * {MOST_SHARE}) div 10")
    # Below zero the window's ends change places, and nothing is in it.
    own = positives.filter("score >= 0").groupBy("id").agg(
        F.collect_list(windows(F.col("other"), F.col("score"), lo, hi)).alias("windows")
    )
    negatives = search(index, asking.join(cut(own), "id"), False, NEGATIVES)
    return negatives.select(
        F.col("id").alias("anchor_id"),
        F.col("key").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("other").alias("negative_id"),
        F.col("base").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    shifted = (F.col("label").cast("bigint") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, shifted).otherwise(F.col("label"))
    own = rows.select(F.col("vec_id").alias("id"), label.alias("label"), F.col("embedding").alias("vector"))
    return mined(own, anchors=F.col("id") % ANCHOR_EVERY == 0)


OP12_SQL = f"""
WITH own AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_dot_product(a.v, b.v)::BIGINT AS score
  FROM own a JOIN own b ON a.vec_id % {ANCHOR_EVERY} = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY anchor_id, positive_id
                          ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= {NEGATIVES}
"""
