"""Scores against dictionaries of counts, and odd inputs."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditledger.llm import lm_scoring as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    texts = [(i, WORD.findall(t or "")) for i, t in rows]
    one = Counter(w for _, ws in texts for w in ws)
    two = Counter(p for _, ws in texts for p in zip(ws, ws[1:], strict=False))
    total = sum(one.values())
    out = []
    for i, ws in texts:
        score, backed = 0.0, 0
        for k, w in enumerate(ws):
            if k and two[ws[k - 1], w] >= lm.MIN_COUNT:
                score += math.log(two[ws[k - 1], w] / one[ws[k - 1]])
            else:
                score += math.log(one[w] / total) + (math.log(lm.BACKOFF) if k else 0)
                backed += bool(k)
        out.append((i, len(ws), backed, score if ws else None))
    return out


def same(got, want):
    key = lambda r: (str(r[0]), r[1], r[2], r[3] or 0)
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    for g, w in zip(got, want, strict=True):
        assert (g[3] is None) == (w[3] is None)
        if w[3] is not None:
            assert g[3] == pytest.approx(w[3])


@pytest.mark.parametrize("frequent", [0.0005, 0.03, 2.0])
def test_like_dictionaries(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    monkeypatch.setattr(lm, "BATCH_WORDS", 200)
    monkeypatch.setattr(lm, "PARTITION_PAIRS", 100)
    rng = random.Random(6)
    vocabulary = [f"w{int(rng.paretovariate(0.8))}" for _ in range(400)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=rng.randrange(60)))) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    same(lm.score(df).collect(), brute(rows))


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    same(lm.score(odd_docs).collect(), brute(rows))
    assert lm.score(no_docs).count() == 0
    more = odd_docs.withColumn("score", F.lit("x")).withColumn("n_words", F.lit(1))
    assert lm.score(more).count() == odd_docs.count()
    blank = spark.createDataFrame([(1, None), (None, "")], "doc_id long, text string")
    same(lm.score(blank).collect(), brute([(1, None), (None, "")]))


def test_a_frequent_pair_is_not_one_group(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 0.02)
    monkeypatch.setattr(lm, "PARTITION_PAIRS", 500)
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(3000)}" for _ in range(40))) for i in range(150)]
    rows += [(1000 + i, "the " * 100) for i in range(30)] + [(2000, "long " * 2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    frequent = lm.frequent_words(docs)
    assert sorted(frequent.counts) == [2000, 3000]
    assert sorted(frequent.pair_counts) == [1999, 2970]
    parts = lm.rare_pairs(docs, frequent).groupBy("part").agg(F.sum("n_pairs").alias("n")).collect()
    assert max(r.n for r in parts) <= 2 * 500 and sum(r.n for r in parts) == 150 * 40
    same(lm.score(docs).collect(), brute(rows))


def test_words_of_a_single_document_are_found(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 0.01)
    rows = [(i, f"a{i} b{i}") for i in range(9000)]
    rows += [(9000 + i, f"own{i} " * 1000) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    frequent = lm.frequent_words(docs)
    assert frequent.counts.tolist() == [1000] * 8 and frequent.pair_counts.tolist() == [999] * 8


def test_counters_lose_no_more_than_they_say():
    rng = np.random.default_rng(2)
    counters, seen = lm.Counters(20), []
    for _ in range(30):
        keys = rng.zipf(1.3, 500).astype(np.uint64)
        seen.append(keys)
        counters.add(keys)
    keys, n = np.unique(np.concatenate(seen), return_counts=True)
    kept = dict(zip(counters.keys.tolist(), counters.n.tolist(), strict=True))
    assert len(kept) <= 20 and counters.lost <= 15000 / 21
    for key, count in zip(keys.tolist(), n.tolist(), strict=True):
        assert kept.get(key, 0) <= count <= kept.get(key, 0) + counters.lost
