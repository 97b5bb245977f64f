"""Mixing against a walk through each source, and its odd inputs."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from creditledger.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """doc_id, source, text to (doc_id, size, source_size, target, taken)."""
    sized = [(i, s, t or "", len(WORD.findall(t or ""))) for i, s, t in rows]
    sources = sorted({s for _, s, _, _ in sized}, key=lambda s: (s is None, s or ""))
    words = {s: sum(n for _, own, _, n in sized if own == s) for s in sources}
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sources)}
    target, open_sources, left = {}, set(sources), float(sum(words.values()))
    while open_sources:
        share = left / sum(weight[s] for s in open_sources)
        over = {s for s in open_sources if 3 * words[s] < share * weight[s]}
        if not over:
            target |= {s: share * weight[s] for s in open_sources}
            break
        for s in over:
            target[s] = 3.0 * words[s]
            left -= target[s]
        open_sources -= over
    out = []
    for s in sources:
        own = [(i, t, n) for i, o, t, n in sized if o == s]

        def key(row):
            text = f"0:{'' if row[0] is None else row[0]}:{row[1]}"
            return hashlib.md5(text.encode()).hexdigest(), row[2]

        own.sort(key=key)
        taken = [0] * len(own)
        budget = int(target[s] // 1)
        while budget > 0 and words[s]:
            for k, (_, _, n) in enumerate(own):
                step = min(n, budget)
                taken[k] += step
                budget -= step
        out += [(i, n, words[s], target[s], k) for (i, _, n), k in zip(own, taken, strict=True)]
    return out


def mixed(spark, rows, narrow):
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = mixing.mix(df, narrow=narrow).select("doc_id", "_mix.*").collect()
    return [tuple(r) for r in out]


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("narrow", [True, False])
def test_like_a_walk_through_each_source(spark, narrow):
    rng = random.Random(5)
    rows = [
        (i, rng.choice(["a", "a", "a", "a", "b", "é", "Z", None]), "w " * rng.randrange(40))
        for i in range(300)
    ]
    want = brute(rows)
    got = mixed(spark, rows, narrow)
    assert [r[:3] + r[4:] for r in ordered(got)] == [r[:3] + r[4:] for r in ordered(want)]
    for g, w in zip(ordered(got), ordered(want), strict=True):
        assert g[3] == pytest.approx(w[3])


def test_budgets_are_met_and_reruns_agree(spark, odd_docs):
    first = ordered(tuple(r) for r in mixing.mix(odd_docs).select("doc_id", "source", "_mix.*").collect())
    again = ordered(tuple(r) for r in mixing.mix(odd_docs).select("doc_id", "source", "_mix.*").collect())
    assert first == again
    for source in {r[1] for r in first}:
        own = [r for r in first if r[1] == source]
        assert sum(r[5] for r in own) == int(own[0][4])
        assert all(r[5] <= 3 * r[2] for r in own)


def test_empty_and_clashing(spark, odd_docs, no_docs):
    assert mixing.mix(no_docs).count() == 0
    from pyspark.sql import functions as F

    more = odd_docs.withColumn("size", F.lit("x")).withColumn("taken", F.lit(1))
    assert mixing.mix(more).columns == [*more.columns, "_mix"]
    assert mixing.mix(more).count() == odd_docs.count()


def test_texts_of_no_words_take_nothing(spark):
    rows = [(1, "a", None), (2, "a", ""), (3, None, " ")]
    assert {r[1:] for r in mixed(spark, rows, False)} == {(0, 0, 0.0, 0)}


def test_plan_is_native_and_splits_sources(spark, odd_docs):
    plan = mixing.mix(odd_docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval"))
