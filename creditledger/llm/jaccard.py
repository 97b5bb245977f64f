"""N-gram Jaccard join: documents whose sets of word shingles overlap, and what links join.

A document's set has a 64-bit hash of each different shingle.  Two sets are linked when
``PERCENT`` of their union is shared.  Documents with equal sets are one node, named by a
128-bit hash of the set, so that copies are compared once.

The comparison is by size-banded tiles.  Bands are sizes between which no link is possible but
to the next; a tile holds a bounded number of nodes and shingles of one band, and is compared
with itself, with the other tiles of its band and with those of the next band.  A task holds the
sorted hashes of one tile and a bitmap of each set, in which every shingle flips one bit; the
nodes that ask it come one batch after the other.  The bits in which two bitmaps differ bound
the overlap from above; pairs that pass are intersected exactly.  Sets already known to be
joined are not compared again, so a task gives a forest of links, never all pairs.

Which nodes can meet at all follows from parts of the sets.  Sets of a class of sizes are cut
into ``K`` parts by the range of the hash.  Linked sets of the class differ in ``D`` shingles at
most, so ``K - D`` parts are equal in both, all their shingles together, and whatever parts are
left out but ``D + 1``, an equal one remains: the fullest are kept, the same for all by their
number of shingles and name.  Nodes with such a part in common are joined into groups, every node
is sent to the tiles of its group, and nodes of groups of one nowhere.  As a part that is kept
holds two shingles or more in all but the smallest sets, a phrase that two texts share hardly
ever makes one equal.

Parts of one batch that several nodes have leave it as one row for each part and links between
those nodes, so no part is a large key, however many nodes have it.

Defined results: a null or empty text, or one without words, has an empty set, linked with
nothing, not even with another; a text of fewer words than a shingle is one shingle.
``component_id`` is the smallest id that links reach, null ids apart, and null if there is none.
Repeated rows are kept.  An empty table gives an empty table.  Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_rows, cut, read
from .simhash import components

SHINGLE = 5
PERCENT = 80
#: The largest size of a class, as a multiple of its least one.
CLASS = 1.5
#: How many times the shingles that may differ there are parts; the emptiest are left out.
SPARE = 1.2
#: Slots of the table that tells which texts are worth sending.
MARKS = 1 << 25
CHUNK = 1 << 16
TILE_NODES = 1024
TILE_SHINGLES = 1 << 22
#: Bytes of a text whose words are hashed at once, and of a word that is hashed with the others.
PIECE = 1 << 20
LONG_WORD = 256
BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Hashes of the shingles of texts.

    The hash of a word is that of its bytes as the digits of a number to an odd base, taken from
    running sums over the text; A to Z have the digits of a to z.  Very long words, for which
    such hashes are weak, are hashed one by one.
    """

    def __init__(self, n: int) -> None:
        self.n = n
        self.space = np.zeros(256, bool)
        self.space[[32, 9, 10, 11, 12, 13]] = True
        self.lowered = np.arange(256, dtype=np.uint8)
        self.lowered[65:91] += 32
        self.digit = mixed(self.lowered.astype(np.uint64) + np.uint64(BASE))
        self.digit[self.space] = 0
        self.factors = mixed(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
        self.up = self.down = np.ones(0, np.uint64)

    def powers(self, size: int) -> None:
        if size > len(self.up):
            size = 1 << size.bit_length()
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps))

    def piece(self, data: np.ndarray) -> np.ndarray:
        """Hashes of the words of ``data``."""
        self.powers(len(data))
        space = np.ones(len(data) + 2, bool)
        space[1:-1] = self.space[data]
        turns = np.flatnonzero(space[1:] != space[:-1])
        starts, ends = turns[::2], turns[1::2]
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.digit[data] * self.up[: len(data)], out=sums[1:])
        own = (sums[ends] - sums[starts]) * self.down[starts]
        sizes = ends - starts
        for k in np.flatnonzero(sizes > LONG_WORD):
            import xxhash

            word = self.lowered[data[starts[k] : ends[k]]]
            own[k] = xxhash.xxh3_64_intdigest(word.tobytes())
        return mixed(own + sizes.astype(np.uint64))

    def words(self, data: np.ndarray) -> np.ndarray:
        found, at = [np.empty(0, np.uint64)], 0
        while at < len(data):
            end = min(at + PIECE, len(data))
            while end < len(data) and not self.space[data[end]]:
                rest = np.flatnonzero(self.space[data[end : end + PIECE]])
                end = end + int(rest[0]) if len(rest) else min(end + PIECE, len(data))
            found.append(self.piece(data[at:end]))
            at = end
        return np.concatenate(found)

    def of(self, text: pa.StringScalar) -> np.ndarray:
        """The different shingles of a text, sorted."""
        if not text.is_valid:
            return np.empty(0, np.uint64)
        words = self.words(np.frombuffer(text.as_buffer(), np.uint8))
        width = min(self.n, len(words))
        if not width:
            return words
        total = np.full(len(words) - width + 1, width, np.uint64)
        for k in range(width):
            total += words[k : len(words) - width + 1 + k] * self.factors[k]
        return np.unique(mixed(total))


def shingles(text: str | None, n: int = SHINGLE) -> np.ndarray:
    return Shingler(n).of(pa.scalar(text, pa.string()))


def node_of(own: np.ndarray) -> bytes:
    """The name of a set."""
    import xxhash

    return xxhash.xxh3_128_digest(own.tobytes())


def short_name(node: bytes) -> int:
    return int.from_bytes(node[:8], "little", signed=True)


def linked(shared: int, one: int, other: int, percent: int) -> bool:
    return 100 * shared >= percent * (one + other - shared)


def bands(most: int, percent: int) -> np.ndarray:
    """The least size of each band: sets that are linked are in one band or in neighbours."""
    edges = [1]
    while edges[-1] <= most:
        edges.append(edges[-1] * 100 // percent + 1)
    return np.array(edges, np.int64)


def _table(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


# --- who can meet: nodes with an equal part ---------------------------------------------


def class_of(size: int) -> int:
    """The class of a size: 0 has size 1 only, and each class begins above the one before."""
    number, least = 0, 1
    while (after := int(least * CLASS) + 1) <= size:
        number, least = number + 1, after
    return number


def least_of(number: int) -> int:
    least = 1
    for _ in range(number):
        least = int(least * CLASS) + 1
    return least


def most_apart(one: int, other: int, percent: int) -> int:
    """In how many shingles two linked sets can differ."""
    return (one + other) * (100 - percent) // (100 + percent)


def most_of(number: int) -> int:
    return int(least_of(number) * CLASS)


def parts_of(number: int, percent: int) -> int:
    """Into how many parts the sets of a class are cut, and larger ones that can be linked to them."""
    most = most_of(number)
    return int(SPARE * most_apart(most, most * 100 // percent, percent)) + 2


def parts(own: np.ndarray, number: int, percent: int) -> np.ndarray:
    """Names of the parts of a set in a class of which any set linked to it there has one."""
    n = parts_of(number, percent)
    at = (((own >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    names = np.arange(n, dtype=np.uint64) + np.uint64(number << 40)
    names[at[starts]] += mixed(np.add.reduceat(own, starts))
    names = mixed(names)
    # What it can be linked to here: sets of the class, and larger ones if it is of the class.
    size, most = len(own), most_of(number)
    other = size * 100 // percent if size <= most else most
    fullest = np.lexsort((names, -np.bincount(at, minlength=n)))
    return names[fullest[: most_apart(size, other, percent) + 1]]


def all_parts(own: np.ndarray, percent: int) -> np.ndarray:
    """The parts of a set in its class, and in those of the smaller sets that it can be linked to."""
    least = class_of(-(-len(own) * percent // 100))
    numbers = range(least, class_of(len(own)) + 1)
    return np.concatenate([parts(own, number, percent) for number in numbers])


def meetings(n: int, percent: int):
    """Batches of ``text`` to (part, u, v): a node of a part (v is null), or a link of nodes."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        shingler = Shingler(n)
        for batch in batches:
            names, nodes = [], []
            for text in batch.column("text"):
                own = shingler.of(text)
                name = short_name(node_of(own))
                if len(own) and name not in done:
                    done.add(name)
                    names.append(all_parts(own, percent))
                    nodes.append(np.full(len(names[-1]), name, np.int64))
            if not names:
                continue
            part, node = np.concatenate(names).view(np.int64), np.concatenate(nodes)
            each, at, which = np.unique(part, return_index=True, return_inverse=True)
            first = node[at]
            met = np.unique(np.stack([node, first[which]], axis=1)[node != first[which]], axis=0)
            alone = np.arange(len(each) + len(met)) < len(each)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([each, met[:, 0]])),
                    pa.array(np.concatenate([first, met[:, 0]])),
                    pa.array(np.concatenate([first, met[:, 1]]), mask=alone),
                ],
                names=["part", "u", "v"],
            )

    return rows


def groups(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """(``node``, ``root``), short names: nodes that may be linked have one root.

    The rows are shuffled once; a link's row has its node for a part, to be dealt out evenly.
    """
    found = meetings(n, percent)
    rows = texts.select("text").mapInArrow(found, "part bigint, u bigint, v bigint")
    least = F.min("u").over(Window.partitionBy("part"))
    links = rows.withColumn("v", F.coalesce("v", least)).filter("u <> v").select("u", "v")
    own = components(links.distinct())
    roots = own.select(F.col("root").alias("node"), "root").distinct()
    return own.unionByName(roots)


# --- tiles ------------------------------------------------------------------------------


class Tile:
    """Nodes of a tile, in sets of those known to be joined."""

    def __init__(self, nodes: list[bytes], sets: list[np.ndarray], percent: int) -> None:
        self.nodes, self.sets, self.percent = nodes, sets, percent
        self.sizes = np.array([len(s) for s in sets], np.int64)
        # About four bits for each shingle of the largest set, in whole words.
        self.words = max(4, 1 << int(max(1, self.sizes.max() * 4 // 64)).bit_length())
        self.bits = np.stack([self.bitmap(s) for s in sets])
        self.label = np.arange(len(sets))
        self.links: list[tuple[bytes, bytes]] = []

    def bitmap(self, own: np.ndarray) -> np.ndarray:
        """Every shingle flips a bit."""
        odd = np.bincount((own % np.uint64(self.words * 64)).astype(np.int64)) & 1
        whole = np.zeros(self.words * 64, np.uint8)
        whole[: len(odd)] = odd
        return np.packbits(whole, bitorder="little").view(np.uint64)

    def possible(self, size: int, bits: np.ndarray, upto: int) -> np.ndarray:
        """Places below ``upto`` that sizes and bitmaps do not rule out."""
        sizes, part = self.sizes[:upto], self.percent
        small, large = np.minimum(sizes, size), np.maximum(sizes, size)
        at = np.flatnonzero(100 * small >= part * large)
        if not len(at):
            return at
        apart = np.bitwise_count(self.bits[at] ^ bits).sum(axis=1, dtype=np.int64)
        both = sizes[at] + size
        most = (both - apart) // 2
        return at[100 * most >= part * (both - most)]

    def meet(self, node: bytes, own: np.ndarray, place: int | None = None) -> None:
        """Link a set to one node of every set of joined nodes that it is linked to.

        ``place`` says that it is a node of this tile, and compares it with those before.
        """
        upto = len(self.sets) if place is None else place
        bits = self.bitmap(own) if place is None else self.bits[place]
        at = self.possible(len(own), bits, upto)
        joined = []
        for label in np.unique(self.label[at]):
            for k in at[self.label[at] == label]:
                if self.nodes[k] == node:
                    joined.append(label)
                    break
                shared = len(np.intersect1d(own, self.sets[k], assume_unique=True))
                if linked(shared, len(own), len(self.sets[k]), self.percent):
                    self.links.append((node, self.nodes[k]))
                    joined.append(label)
                    break
        if place is not None:
            joined.append(self.label[place])
        if len(joined) > 1:
            self.label[np.isin(self.label, joined)] = joined[0]

    def take(self) -> pa.RecordBatch:
        found, self.links = self.links, []
        u, v = zip(*found, strict=True) if found else ((), ())
        return _table(u=pa.array(u, pa.binary()), v=pa.array(v, pa.binary()))


def compared(n: int, percent: int):
    """Rows sorted by (``root``, ``band``, ``tile``), stored ones first, to links (u, v)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        key, nodes, sets, tile = None, [], [], None

        def opened() -> Tile | None:
            if not sets:
                return None
            made = Tile(nodes, sets, percent)
            for k in range(len(sets)):
                made.meet(nodes[k], sets[k], k)
            return made

        for batch in batches:
            for root, band, number, stored, node, text in zip(
                *(batch.column(c) for c in ("root", "band", "tile", "stored", "node", "text")),
                strict=True,
            ):
                if (own_key := (root.as_py(), band.as_py(), number.as_py())) != key:
                    if tile is None and sets:
                        tile = opened()
                    if tile is not None:
                        yield tile.take()
                    key, nodes, sets, tile = own_key, [], [], None
                name, own = node.as_py(), shingler.of(text)
                if stored.as_py():
                    nodes.append(name)
                    sets.append(own)
                else:
                    tile = tile or opened()
                    if tile is not None:
                        tile.meet(name, own)
                        if len(tile.links) > CHUNK:
                            yield tile.take()
        tile = tile or opened()
        if tile is not None:
            yield tile.take()

    return rows


def tiled(members: DataFrame, edges: np.ndarray) -> DataFrame:
    """``members`` (``root``, ``node``, ``n``, ``text``) with the tiles that each is sent to.

    A group that one tile can hold is one.  In others a node is stored in a tile of its band,
    and asks the later tiles of its band and all tiles of the band before.
    """
    band = F.size(F.filter(F.array([F.lit(int(e)) for e in edges]), lambda e: e <= F.col("n")))

    def pieces(nodes: str, size: str):
        return F.greatest(F.ceil(F.col(nodes) / TILE_NODES), F.ceil(F.col(size) / TILE_SHINGLES))

    placed = members.withColumn("band", band)
    sizes = placed.groupBy("root", "band").agg(
        F.count(F.lit(1)).alias("_nodes"), F.sum("n").alias("_size")
    )
    whole = sizes.groupBy("root").agg(
        F.sum("_nodes").alias("_nodes"), F.sum("_size").alias("_size"),
        F.map_from_entries(F.collect_list(F.struct("band", pieces("_nodes", "_size")))).alias("tiles"),
    )
    large = whole.filter(pieces("_nodes", "_size") > 1).select("root", "tiles")
    found = placed.join(large, "root", "left")
    own = F.coalesce(F.element_at("tiles", F.col("band")), F.lit(1))
    mine = F.pmod(F.xxhash64("node"), own).cast("bigint")

    def slot(band, tile, stored: bool):
        return F.struct(
            band.cast("int").alias("band"), tile.cast("bigint").alias("tile"),
            F.lit(stored).alias("stored"),
        )

    def upto(first, last):
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))

    before = F.coalesce(F.try_element_at("tiles", F.col("band") - 1), F.lit(0)).cast("bigint")
    one = F.lit(1).cast("bigint")
    slots = F.concat(
        F.array(slot(F.col("band"), mine, True)),
        F.transform(upto(mine + one, own.cast("bigint") - one), lambda t: slot(F.col("band"), t, False)),
        F.transform(
            upto(F.lit(0).cast("bigint"), before - one), lambda t: slot(F.col("band") - 1, t, False)
        ),
    )
    alone = F.array(slot(F.lit(0), F.lit(0), True))
    sent = F.explode(F.when(F.col("tiles").isNull(), alone).otherwise(slots)).alias("_slot")
    return found.select("root", "node", "text", sent).select("root", "node", "text", "_slot.*")


def marks_of(nodes: DataFrame) -> np.ndarray:
    """A table of ``MARKS`` bits, packed, in which every ``node`` has set one.

    Each task sends the bits it has set by chunk, and each chunk is put together in one task, so
    that the driver gets every bit once.
    """

    def chunks(bits: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for chunk, own in bits.items():
            yield _table(chunk=pa.array([chunk], pa.int32()), bits=[own.tobytes()])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(MARKS, bool)
        for batch in batches:
            seen[batch.column("node").to_numpy(zero_copy_only=False).view(np.uint64) % MARKS] = True
        packed = np.packbits(seen).reshape(-1, min(CHUNK, MARKS) // 8)
        yield from chunks({k: packed[k] for k in np.flatnonzero(packed.any(axis=1)).tolist()})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(part, np.uint8)
                bits[chunk] = bits[chunk] | own if chunk in bits else own
        yield from chunks(bits)

    schema = "chunk int, bits binary"
    dealt = nodes.select("node").mapInArrow(mark, schema).repartition(16, "chunk")
    table = np.zeros((max(1, MARKS // CHUNK), min(CHUNK, MARKS) // 8), np.uint8)
    for row in dealt.mapInArrow(add, schema).collect():
        table[row.chunk] = np.frombuffer(row.bits, np.uint8)
    return table.ravel()


def links(texts: DataFrame, n: int, percent: int) -> DataFrame:
    """Links (``u``, ``v``) of nodes that join all nodes that are linked.

    Of the texts only those that a table of ``MARKS`` bits does not rule out are sent; it is of
    fixed size, so that with very many groups more texts go than need to.
    """
    roots = cut(groups(texts, n, percent))
    marks = marks_of(roots)

    def worth_sending(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, done, shingler = np.unpackbits(marks), set(), Shingler(n)
        for batch in batches:
            kept, nodes, names, sizes = [], [], [], []
            for k, value in enumerate(batch.column("text")):
                own = shingler.of(value)
                node = node_of(own)
                name = short_name(node)
                if len(own) and node not in done and known[name % MARKS]:
                    done.add(node)
                    kept.append(k)
                    nodes.append(node)
                    names.append(name)
                    sizes.append(len(own))
            yield _table(
                short=pa.array(names, pa.int64()), node=pa.array(nodes, pa.binary()),
                n=pa.array(sizes, pa.int64()),
                text=batch.column("text").take(pa.array(kept, pa.int64())).cast(pa.string()),
            )

    sent = texts.mapInArrow(worth_sending, "short bigint, node binary, n bigint, text string")
    known = roots.withColumnRenamed("node", "short")
    once = sent.join(known, "short").dropDuplicates(["root", "node"]).drop("short")
    members = cut(once)
    most = members.agg(F.max("n")).first()[0] or 0
    dealt = tiled(members, bands(most, percent)).repartition("root", "band", "tile")
    ordered = dealt.sortWithinPartitions("root", "band", "tile", F.desc("stored"))
    return ordered.mapInArrow(compared(n, percent), "u binary, v binary")


def named(n: int):
    """Batches of (doc_id, text) to (doc_id, node, n)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            sets = [shingler.of(t) for t in batch.column("text")]
            yield _table(
                doc_id=batch.column("doc_id"),
                node=pa.array(map(node_of, sets), pa.binary()),
                n=pa.array(map(len, sets), pa.int64()),
            )

    return rows


def joined(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    n: int = SHINGLE,
    percent: int = PERCENT,
) -> DataFrame:
    """One row for each document: ``doc_id``, ``n_shingles``, ``component_id``."""
    arrow_rows(docs.sparkSession)
    asked = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    own = cut(asked.mapInArrow(named(n), "doc_id bigint, node binary, n bigint"))
    found = components(links(asked.select("text"), n, percent))
    full = own.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    rooted = full.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = cut(rooted)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    ends = rooted.join(least, "root").select("node", "component_id")
    empty = F.when(F.col("n") == 0, F.col("doc_id"))
    component = F.coalesce("component_id", empty).alias("component_id")
    return own.join(ends, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), component)


def op13_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return joined(read(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT row, doc_id,
         CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(
           range(1, greatest(len(w) - 5 + 1, 1) + 1),
           lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) END AS s
  FROM words
), nodes AS (
  SELECT list_sort(s) AS s, min(row) AS node FROM sets WHERE len(s) > 0 GROUP BY 1
), tokens AS (
  SELECT node, len(s) AS n, hash(t) AS t FROM (SELECT node, s, unnest(s) AS t FROM nodes)
), pairs AS (
  SELECT a.node AS u, b.node AS v
  FROM tokens a JOIN tokens b ON a.t = b.t AND a.node < b.node
   AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.node, b.node, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS (
  SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs
), reach AS (
  SELECT node, node AS other FROM nodes
  UNION
  SELECT r.node, l.v FROM reach r JOIN links l ON l.u = r.other
), own AS (
  SELECT x.doc_id, x.row, n.node, len(x.s) AS n
  FROM sets x LEFT JOIN nodes n ON n.s = list_sort(x.s) AND len(x.s) > 0
), least AS (
  SELECT r.node, min(o.doc_id) AS component_id
  FROM reach r JOIN own o ON o.node = r.other GROUP BY r.node
)
SELECT doc_id, o.n::BIGINT AS n_shingles,
       CASE WHEN o.n = 0 THEN doc_id ELSE component_id END AS component_id
FROM own o LEFT JOIN least l ON l.node = o.node
"""
