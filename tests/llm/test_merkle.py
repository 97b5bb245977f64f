"""The manifest against a tree built node by node."""

from __future__ import annotations

import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from creditledger.llm import merkle
from creditledger.llm.common import cut

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def h(text: str) -> str:
    return sha256(text.encode("utf-8")).hexdigest()


def leaf(row) -> str:
    values = [None if row[c] is None else str(row[c]) for c in FIELDS]
    return h("".join("-" if v is None else f"{len(v.encode('utf-8'))}:{v}" for v in values))


def climb(nodes: list[str], arity: int):
    """The top of a tree, and for each leaf the runs it is in: (place in the run, run)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for k, path in enumerate(paths):
            path.append((at[k] % arity, runs[at[k] // arity]))
        at = [i // arity for i in at]
        nodes = [h("".join(run)) for run in runs]
    return nodes[0], paths


def expected(rows: list, arity: int) -> list[tuple]:
    sources = defaultdict(list)
    for row in rows:
        sources[row["source"]].append(row)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode("utf-8")))
    trees = {}
    for name in names:
        own = sorted(sources[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        trees[name] = (own, *climb([leaf(r) for r in own], arity))
    root, tops = climb([trees[name][1] for name in names], arity)
    found = []
    for name, top in zip(names, tops, strict=True):
        own, subroot, paths = trees[name]
        for row, path in zip(own, paths, strict=True):
            whole = path + top
            beside = "".join("".join(run[:i] + run[i + 1 :]) for i, run in whole)
            id_ = row["doc_id"]
            changed = dict(zip(FIELDS, (row[c] for c in FIELDS), strict=True))
            if id_ is not None and zlib.crc32(str(id_).encode()) % 5 == 0 and row["text"] is not None:
                changed["text"] = row["text"].translate(LOWERED)
            node = leaf(changed)
            for i, run in whole:
                node = h("".join([*run[:i], node, *run[i + 1 :]]))
            found.append((id_, leaf(row), subroot, root, h(beside), node, node == root))
    return found


def shown(docs, arity: int) -> list[tuple]:
    rows = merkle.manifest(
        docs,
        changed={"text": merkle.lowered(F.col("text"))},
        where=merkle.tampered(F.col("doc_id")),
        arity=arity,
    )
    seen = merkle.recomputed_root(F.coalesce("other", "leaf"), F.col("path"))
    texts = [merkle.as_text(F.col(c)) for c in ("leaf", "subroot", "root")]
    rows = rows.select("id", *texts, merkle.proof_digest(F.col("path")), seen.alias("seen"), "root")
    return [(*r[:6], r[5] == r[6].hex()) for r in rows.collect()]


def same(got: list[tuple], want: list[tuple]) -> None:
    assert sorted(map(str, got)) == sorted(map(str, want))


@pytest.mark.parametrize("arity", [2, 3, 16])
def test_odd_rows(odd_docs, arity):
    same(shown(odd_docs, arity), expected(odd_docs.collect(), arity))


@pytest.mark.parametrize(("arity", "sizes"), [(2, (1, 2, 3, 8, 9)), (16, (1, 16, 17, 256, 257))])
def test_trees_of_every_height(spark, arity, sizes):
    """Full and uneven runs, last runs of one node, and trees that end at different levels."""
    rows = [
        (1000 * k + (i * 7) % n, f"Text {i} É", "en", f"s{k}", i)
        for k, n in enumerate(sizes)
        for i in range(n)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    same(shown(docs, arity), expected(docs.collect(), arity))


def test_many_sources_make_a_tree_of_roots(spark):
    docs = spark.range(300).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("s"), F.col("id") % 37).alias("source"),
        F.lit(None).cast("string").alias("lang"),
        F.lit(1).alias("n_chars"),
        F.concat(F.lit("A"), "id").alias("text"),
    )
    got = shown(docs, 4)
    same(got, expected(docs.collect(), 4))
    assert len({row[3] for row in got}) == 1


def test_one_row_and_none(odd_docs, no_docs):
    one = odd_docs.filter("doc_id = 6")
    same(shown(one, 16), expected(one.collect(), 16))
    assert shown(no_docs, 16) == []


def test_other_columns_do_not_matter(odd_docs):
    names = ("idx", "n", "tree", "run", "node", "left", "path", "root", "_place", "id")
    more = odd_docs.withColumns({c: F.lit(1) for c in names})
    same(shown(more, 16), expected(odd_docs.collect(), 16))


def test_only_changed_texts_fail(spark):
    docs = spark.range(400).select(
        F.col("id").alias("doc_id"),
        F.lit("s").alias("source"),
        F.lit("en").alias("lang"),
        F.lit(1).alias("n_chars"),
        F.when(F.col("id") % 2 == 0, F.lit("Upper")).otherwise(F.lit("lower")).alias("text"),
    )
    got = {row[0]: row[6] for row in shown(docs, 16)}
    tampered = {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0 and i % 2 == 0}
    assert tampered and {i for i, ok in got.items() if not ok} == tampered


def test_a_level_moves_its_nodes_once(spark):
    """Nodes hashed on their run are joined and grouped where they are."""
    nodes = cut(
        spark.range(1000).select(
            F.lit(0).cast("bigint").alias("tree"),
            F.lit(1000).cast("bigint").alias("n"),
            F.col("id").alias("idx"),
            F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("node"),
        )
    )
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")
    try:
        with merkle.hashed_in_place(spark):
            plan = merkle.with_siblings(nodes, 16)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(threshold, before)
    assert plan.count("Exchange hashpartitioning(tree") == 2, plan  # the two sides of the self-join
    assert plan.count("Exchange") == 2
