"""Fingerprints and components against comparing all pairs, and odd inputs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from creditledger.llm import simhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(text, k=3):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: dict, bits=3):
    root = {i: i for i in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in prints:
        for b in prints:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= bits:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in prints}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints(odd_docs):
    rows = odd_docs.select("text", simhash.fingerprints(F.col("text")).alias("fp")).collect()
    for r in rows:
        assert r.fp == signed(brute_fingerprint(r.text)), r.text


def test_spark_hash_is_the_same(spark):
    row = spark.createDataFrame([("a b c",)], "t string").select(F.xxhash64("t")).first()
    assert row[0] == signed(xxhash.xxh64_intdigest(b"a b c", 42))


@pytest.mark.parametrize("levels_from", [10**9, 0])
@pytest.mark.parametrize("tile", [8192, 16])
def test_components_like_all_pairs(spark, monkeypatch, levels_from, tile):
    monkeypatch.setattr(simhash, "DEEP_FROM", levels_from)
    monkeypatch.setattr(simhash, "TILE", tile)
    rng = random.Random(levels_from + tile)
    prints = []
    for _ in range(12):
        own = rng.getrandbits(64)
        for _ in range(25):
            prints.append(own)
            # Chains: each differs a little from the one before.
            for _ in range(rng.choice([1, 2, 3, 4])):
                own ^= 1 << rng.randrange(64)
    prints += [0, (1 << 64) - 1, 1, 3]
    unique = sorted(set(prints))
    df = spark.createDataFrame([(signed(p),) for p in unique], "fp long")
    found = simhash.components(simhash.near_links(df))
    got = {r.node: r.root for r in found.collect()}
    want = brute_components({signed(p): p for p in unique})
    assert {i: got.get(i, i) for i in want} == want


def test_no_pairs_within_a_dense_group():
    rng = np.random.default_rng(1)
    center = np.uint64(rng.integers(1 << 63))
    near = np.unique(center ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)))
    tile = simhash.Tile(near, 3)
    u, v = simhash.links_of(tile)
    assert len(u) == len(near) - 1
    u, v = simhash.links_of(tile, np.array([center, ~center]))
    assert u.tolist() == [center]


def test_pieces_of_long_texts(monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choices(["a", "B ", "\n", "ccc", " d"], k=rng.randrange(200))) for _ in range(60)]
    monkeypatch.setattr(simhash, "PIECE_BYTES", 11)
    for k in (1, 2, 3, 5):
        assert [simhash.fingerprint(t, k) for t in texts] == [brute_fingerprint(t, k) for t in texts]


def test_long_chain_is_one_component(spark):
    fps = [(signed((1 << i) - 1),) for i in range(64)]
    links = [(fps[i][0], fps[i + 1][0]) for i in range(63)]
    found = simhash.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.root for r in found} == {min(f[0] for f in fps)}
    assert len(found) == 63


def test_hubs_and_common_fingerprints(spark):
    """Nodes with thousands of links, and a fingerprint that a third of all documents have."""
    links = [(5000, k) for k in range(2000)] + [(-7, k) for k in range(6000, 9000)] + [(1999, 6000)]
    found = simhash.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.root for r in found} == {-7} and len(found) == 5001
    rows = [(k, "" if k % 3 == 0 else f"{k} {k * k} x{k}") for k in range(600)]
    got = {r.doc_id: r for r in simhash.grouped(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    prints = {i: brute_fingerprint(t) for i, t in rows}
    assert {i: r.component_id for i, r in got.items()} == brute_components(prints)


def test_odd_rows(odd_docs, no_docs):
    rows = simhash.grouped(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = {r.doc_id: r.component_id for r in rows}
    assert of[1] == of[2] == of[3] == 1
    assert of[4] == of[5] == 4
    assert of[6] == of[7] == 6
    assert of[None] is None
    kept = simhash.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 4, None, 6, 8, 9]))
    assert simhash.grouped(no_docs).count() == 0
    assert simhash.keep_one(no_docs).count() == 0
    more = odd_docs.withColumn("fp", F.lit("x")).withColumn("text_hash", F.lit(1))
    assert simhash.keep_one(more).columns == more.columns


def test_given_documents(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    prints = {r.doc_id: brute_fingerprint(r.text) for r in docs.collect()}
    got = {r.doc_id: r for r in simhash.op7_simhash(spark, folder).collect()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == prints
    assert {i: r.component_id for i, r in got.items()} == brute_components(prints)
