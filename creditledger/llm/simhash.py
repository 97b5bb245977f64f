"""SimHash near-duplicates: fingerprints, exact pairs by vantage-point trees, components.

A document's fingerprint has a bit where more than half of its shingles' XXH64 hashes have it.
Documents whose fingerprints differ in at most ``BITS`` bits are linked, and what links join is
a component.  Equal fingerprints are one node, however many documents have it.

The tree splits fingerprints by Hamming distance to vantage points.  Level by level, a vantage
point is looked at through another block of bits, and the distance within the block, a ring
number, picks the branch.  The triangle inequality bounds the distance of two fingerprints from
below by the difference of their ring numbers, and since blocks do not overlap the bounds of
all levels add up.  A fingerprint is stored in the shard its rings lead to, and asks each other
shard whose rings differ from its own by ``BITS`` in total at most, as all others are pruned.
Of two shards the later one asks the earlier one, so that each pair meets once.  More levels
prune more and ask more shards; their number follows from the number of fingerprints.

A shard with more than ``TILE`` fingerprints is cut into tiles that are compared pairwise, in
tasks of their own.  A task holds one tile, reads the fingerprints that ask it one batch after
the other, and returns a spanning forest of the links it found, never all pairs.
Components come from alternating large-star and small-star steps over tables in the shared
folder until nothing changes.  The rows of a fingerprint, hub or component with more than a
partition's share of them meet its row by broadcast; there are fewer of these than partitions.

Defined results: a null text has no words and fingerprint zero, linked like any other; a text
of fewer words than a shingle is one shingle.  ``component_id`` is the smallest id reachable,
null ids apart, and null if there is none.  Repeated rows are kept.  An empty table gives an
empty table.  Other columns are left alone; working columns are named ``_sim...``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import split_join
from .common import arrow_rows, cut, drop_cut, read, tasks

SHINGLE = 3
BITS = 3
SEED = 42
TILE = 8192
#: Fingerprints from which on eight levels of rings cost less than four.
DEEP_FROM = 50_000_000
#: The vantage point of each level, in the bits of its block.
VANTAGE = 0x9E3779B97F4A7C15
LOWERED = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SPACE = re.compile(rb"[ \t\n\x0b\x0c\r]")
#: Bytes of a text whose shingles are held at once.
PIECE_BYTES = 1 << 20
BLOCK_ROWS = 1 << 16


def pieces(data: bytes) -> Iterator[bytes]:
    """Cut long data behind white space, so that words of a piece at a time are held."""
    at = 0
    while len(data) - at > PIECE_BYTES:
        found = SPACE.search(data, at + PIECE_BYTES)
        if not found:
            break
        yield data[at : found.end()]
        at = found.end()
    yield data[at:]


def fingerprint(text: str | None, shingle: int) -> int:
    """The fingerprint of a text, as an unsigned 64-bit number."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    ones, n, words = np.zeros(64, np.int64), 0, []
    for piece in pieces((text or "").encode("utf-8", "replace")):
        # The last words of the piece before begin shingles that end in this one.
        words = words[max(0, len(words) - shingle + 1) :] if n else words
        words += piece.translate(LOWERED).split()
        if len(words) < shingle:
            continue
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        spans = zip(starts, ends[shingle - 1 :].tolist(), strict=False)
        hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        n += len(hashes)
    if not n:
        return digest(b" ".join(words), SEED) if words else 0
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, shingle: int = SHINGLE) -> Column:
    """The fingerprint of a text as a long with the same 64 bits."""

    @F.pandas_udf("bigint")
    def computed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            own = np.array([fingerprint(t, shingle) for t in batch], np.uint64)
            yield pd.Series(own.view(np.int64))

    return computed(text)


def ring_numbers(own: np.ndarray, levels: int) -> np.ndarray:
    """For each fingerprint the distance to the vantage point in each block: levels columns."""
    width = 64 // levels
    away = own ^ np.uint64(VANTAGE)
    mask = np.uint64((1 << width) - 1)
    blocks = [(away >> np.uint64(width * k)) & mask for k in range(levels)]
    return np.stack([np.bitwise_count(b) for b in blocks], axis=1).astype(np.int64)


def shard_numbers(rings: np.ndarray, levels: int) -> np.ndarray:
    base = 64 // levels + 1
    return rings @ (base ** np.arange(levels, dtype=np.int64))


def steps_to_earlier(levels: int, bits: int) -> np.ndarray:
    """Ring differences of at most ``bits`` in total that lead to a smaller shard number."""
    ball = [()]
    for _ in range(levels):
        ball = [
            (*s, d)
            for s, d in product(ball, range(-bits, bits + 1))
            if sum(map(abs, s)) + abs(d) <= bits
        ]
    base = 64 // levels + 1
    places = base ** np.arange(levels, dtype=np.int64)
    steps = np.array(ball, np.int64)
    return steps[steps @ places < 0]


class Tile:
    """Stored fingerprints, in sets of those that links are known to join.

    ``linked`` compares fingerprints with the stored ones and gives, for each, one link to
    every set it touches, which thereby become one set.  Only the stored ones are held, however
    many ask; and of the links within a set no more than a tree is given.
    """

    def __init__(self, stored: np.ndarray, bits: int) -> None:
        self.stored, self.bits = stored, bits
        self.label = np.arange(len(stored))

    def linked(self, asking: np.ndarray, first: int | None = None) -> Iterator[tuple[int, int]]:
        """Links as (place among ``asking``, place among the stored).

        ``first`` says that the asking ones are stored, from that place on.
        """
        near = np.bitwise_count(asking[:, None] ^ self.stored[None, :]) <= self.bits
        for i in np.flatnonzero(near.any(axis=1)):
            met = np.flatnonzero(near[i])
            labels, at = np.unique(self.label[met], return_index=True)
            own = labels[0] if first is None else self.label[first + i]
            if len(labels) > 1:
                self.label[np.isin(self.label, labels)] = own
            for label, k in zip(labels, at, strict=True):
                if first is None or label != own:
                    yield int(i), int(met[k])


def rows_at_once(stored: np.ndarray) -> int:
    return max(1, (1 << 22) // max(1, len(stored)))


def links_of(tile: Tile, asking: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links among the stored fingerprints of a tile, or of ``asking`` to them."""
    own = tile.stored if asking is None else asking
    step = rows_at_once(tile.stored)
    u, v = [], []
    for at in range(0, len(own), step) if len(tile.stored) else ():
        for i, j in tile.linked(own[at : at + step], at if asking is None else None):
            u.append(own[at + i])
            v.append(tile.stored[j])
    return np.array(u, np.uint64), np.array(v, np.uint64)


def placed(levels: int, bits: int):
    """Arrow batches of ``fp`` to rows (``shard``, ``home``, ``fp``): its own shard, and those it asks."""
    steps = steps_to_earlier(levels, bits)
    base = 64 // levels + 1

    def rows(shards: np.ndarray, home: bool, own: np.ndarray) -> pa.RecordBatch:
        columns = [shards, np.full(len(own), home), own.view(np.int64)]
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in columns], names=["shard", "home", "fp"]
        )

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            for k in range(0, len(whole), BLOCK_ROWS):
                own = whole[k : k + BLOCK_ROWS]
                rings = ring_numbers(own, levels)
                yield rows(shard_numbers(rings, levels), True, own)
                for step in steps:
                    there = rings + step
                    real = ((there >= 0) & (there < base)).all(axis=1)
                    if real.any():
                        yield rows(shard_numbers(there[real], levels), False, own[real])

    return spread


def tiled(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """Rows of ``placed`` dealt to tiles: ``shard``, ``tile``, ``stored``, ``fp``.

    A fingerprint is stored in one tile of its own shard, asks the later ones, and asks all
    tiles of other shards.  ``crowded`` has the shards of several ``tiles``; Spark broadcasts it
    if its file is small enough.
    """
    n = F.coalesce("tiles", F.lit(1).cast("bigint"))
    own = F.pmod("fp", n)

    def asked(first: Column) -> Column:
        each = F.transform(F.sequence(first, n - 1), lambda t: _place(t, False))
        return F.when(first < n, each).otherwise(F.array().cast("array<struct<tile:bigint,stored:boolean>>"))

    stored = F.array(_place(own, True))
    places = F.when(F.col("home"), F.concat(stored, asked(own + 1))).otherwise(
        asked(F.lit(0).cast("bigint"))
    )
    dealt = rows.join(crowded, "shard", "left").select("shard", "fp", F.explode(places).alias("at"))
    return dealt.select("shard", "at.tile", "at.stored", "fp")


def _place(tile: Column, stored: bool) -> Column:
    return F.struct(tile.alias("tile"), F.lit(stored).alias("stored"))


def searched(bits: int):
    """Rows sorted by (``shard``, ``tile``), stored ones first, to links (``u``, ``v``)."""

    def batch_of(links: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        columns = [pa.array(x.view(np.int64)) for x in links]
        return pa.RecordBatch.from_arrays(columns, names=["u", "v"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, tile = None, [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            shard, number, stored, fp = (
                batch.column(c).to_numpy(zero_copy_only=False) for c in batch.schema.names
            )
            fp = fp.view(np.uint64)
            changes = (np.diff(shard) != 0) | (np.diff(number) != 0) | (np.diff(stored) != 0)
            cuts = np.flatnonzero(changes) + 1
            for a, b in zip([0, *cuts], [*cuts, len(fp)], strict=True):
                if (shard[a], number[a]) != key:
                    if parts and tile is None:
                        yield batch_of(links_of(Tile(np.concatenate(parts), bits)))
                    key, parts, tile = (shard[a], number[a]), [], None
                if stored[a]:
                    parts.append(fp[a:b])
                elif parts:
                    if tile is None:
                        tile = Tile(np.concatenate(parts), bits)
                        yield batch_of(links_of(tile))
                    yield batch_of(links_of(tile, fp[a:b]))
        if parts and tile is None:
            yield batch_of(links_of(Tile(np.concatenate(parts), bits)))

    return search


def near_links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """Links (``u``, ``v``) that join all fingerprints of ``distinct`` within ``bits``."""
    n = distinct.count()
    levels = 8 if n >= DEEP_FROM else 4

    @F.pandas_udf("bigint")
    def home(fp: pd.Series) -> pd.Series:
        own = fp.to_numpy().view(np.uint64)
        return pd.Series(shard_numbers(ring_numbers(own, levels), levels))

    sizes = distinct.groupBy(home("fp").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    tiles = F.ceil(F.col("n") / TILE).alias("tiles")
    crowded = cut(sizes.filter(F.col("n") > TILE).select("shard", tiles))
    schema = "shard bigint, home boolean, fp bigint"
    rows = tiled(distinct.select("fp").mapInArrow(placed(levels, bits), schema), crowded)
    # Shards that nothing is stored in have no rows but asking ones, which meet nothing.
    dealt = rows.repartition(4 * tasks(distinct.sparkSession), "shard", "tile")
    ordered = dealt.sortWithinPartitions("shard", "tile", F.desc("stored"))
    return ordered.mapInArrow(searched(bits), "u bigint, v bigint")


def components(links: DataFrame) -> DataFrame:
    """Links (``u``, ``v``) to (``node``, ``root``): the smallest node that links reach.

    Only nodes other than their root are listed.  Each round is written to the shared folder
    and the one before removed; a round works on one row for each node and link left.
    """

    def distinct_links(df: DataFrame) -> DataFrame:
        high, low = F.greatest("u", "v"), F.least("u", "v")
        return df.filter("u <> v").select(high.alias("u"), low.alias("v")).distinct()

    def large_star(edges: DataFrame) -> DataFrame:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        named = split_join(both.filter("v > u"), least, ["u"])
        return named.select(F.col("v").alias("u"), "m")

    def small_star(edges: DataFrame) -> DataFrame:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        named = split_join(edges, least, ["u"])
        others = named.filter("v <> m").select(F.col("v").alias("u"), "m")
        return others.unionByName(least)

    def state(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges = cut(distinct_links(links))
    before, now = None, state(edges)
    while now != before:
        wide = cut(distinct_links(large_star(edges).withColumnRenamed("m", "v")))
        after = cut(distinct_links(small_star(wide).withColumnRenamed("m", "v")))
        drop_cut(edges)
        drop_cut(wide)
        edges, before, now = after, now, state(after)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def grouped(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    bits: int = BITS,
) -> DataFrame:
    """One row per document: id, ``fp``, ``text_hash``, ``component_id``, ``keeper_hash``.

    (``component_id``, ``keeper_hash``) names the row that stays for the component.
    """
    arrow_rows(docs.sparkSession)
    own = docs.select(
        F.col(id_column).alias("doc_id"),
        F.xxhash64(text).alias("text_hash"),
        fingerprints(F.col(text), shingle).alias("fp"),
    )
    own = cut(own)
    first = F.struct(F.isnull("doc_id").alias("no_id"), "doc_id", "text_hash")
    nodes = cut(own.groupBy("fp").agg(F.min(first).alias("first")))
    found = components(near_links(nodes.select("fp"), bits))
    rooted = nodes.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = cut(rooted)
    least = rooted.groupBy("root").agg(F.min("first").alias("least"))
    named = split_join(rooted, least, ["root"]).select(
        "fp",
        F.col("least.doc_id").alias("component_id"),
        F.col("least.text_hash").alias("keeper_hash"),
    )
    return split_join(own, cut(named), ["fp"])


def keep_one(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    bits: int = BITS,
) -> DataFrame:
    """One row of each component: that with the smallest id, and of repeated rows one."""
    groups = grouped(docs, id_column, text, shingle, bits)
    stay = groups.select(
        F.col("component_id").alias("_sim_id"), F.col("keeper_hash").alias("_sim_hash")
    ).distinct()
    hashed = docs.withColumn("_sim_own", F.xxhash64(text))
    same = F.col(id_column).eqNullSafe(F.col("_sim_id")) & (
        F.col("_sim_own") == F.col("_sim_hash")
    )
    kept = hashed.join(stay, same, "left_semi")
    return kept.dropDuplicates([id_column, "_sim_own"]).drop("_sim_own")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = grouped(read(spark, sf_dir, "documents"))
    shown = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return groups.select("doc_id", shown, "component_id")
