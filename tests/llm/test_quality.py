"""Counts against Python, the label model against Python, odd inputs."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from creditledger.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    n = Counter(windows)
    covered = {i + d for i, w in enumerate(windows) if n[w] > 1 for d in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_counts(spark, odd_docs):
    rng = random.Random(2)
    texts = [
        "".join(rng.choice(["a ", "b ", "c\n", "d# ", "é* ", "x\x0b", "y z "]) for _ in range(rng.randrange(120)))
        for _ in range(200)
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: tuple(r)[1:6] for r in quality.rate(df).select("doc_id", *quality.COUNTS).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    own = Counter(tuple(r) for r in quality.rate(odd_docs).select("doc_id", *quality.COUNTS).collect())
    assert own == Counter((r.doc_id, *brute(r.text)) for r in odd_docs.collect())


def model_by_hand(patterns, n_rules):
    prior = quality.START_PRIOR
    good, bad = quality.START_RATES_GOOD * n_rules, quality.START_RATES_BAD * n_rules

    def posterior(votes):
        odds = math.log(prior / (1 - prior)) + sum(math.log(good[k] / bad[k]) for k in votes)
        return 1 / (1 + math.exp(-odds))

    s = quality.START_DOCS
    starts = [[s * x for x in r] * n_rules for r in (quality.START_RATES_GOOD, quality.START_RATES_BAD)]
    for _ in range(quality.ITERATIONS):
        share = [(votes, n, posterior(votes)) for votes, n in patterns]
        g = sum(n * q for _, n, q in share)
        b = sum(n * (1 - q) for _, n, q in share)
        places = range(3 * n_rules)
        sums = [(sum(n * q for v, n, q in share if k in v) + starts[0][k]) for k in places]
        new_good = [x / (g + s) for x in sums]
        sums = [(sum(n * (1 - q) for v, n, q in share if k in v) + starts[1][k]) for k in places]
        new_bad = [x / (b + s) for x in sums]
        prior, good, bad = (g + quality.START_PRIOR * s) / (g + b + s), new_good, new_bad
    return prior, good, bad


def test_label_model(spark):
    rng = random.Random(4)
    patterns = Counter()
    for _ in range(3000):
        fine = rng.random() < 0.85
        right = [0.9, 0.8, 0.95]
        votes = tuple(
            3 * j + (1 if rng.random() < 0.3 else 2 if (rng.random() < p) == fine else 0)
            for j, p in enumerate(right)
        )
        patterns[votes] += 1
    rows = [(list(v), n) for v, n in patterns.items()]
    df = spark.createDataFrame(rows, "votes array<int>, n long")
    model = quality.label_model(df, 3).select("model.*").first()
    prior, good, bad = model_by_hand(rows, 3)
    assert model.prior == pytest.approx(prior)
    assert list(model.good) == pytest.approx(good)
    assert list(model.bad) == pytest.approx(bad)
    assert 0.7 < prior < 0.97


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    rated = quality.rate(spark.read.parquet(f"{folder}/documents.parquet"))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = rated.join(labels, "doc_id").groupBy("quality", "base_failed", "kept").count().collect()
    n = {(r.quality, r.base_failed, r.kept): r["count"] for r in rows}
    judged_good = n.get((1, False, True), 0)
    assert n.get((1, False, False), 0) <= 0.01 * judged_good
    bad = n.get((0, False, False), 0) + n.get((0, True, False), 0)
    assert n.get((0, False, True), 0) <= 0.05 * bad


def test_odd_rows(spark, odd_docs, no_docs):
    kept = quality.keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert quality.keep_good(no_docs).count() == 0
    assert quality.rate(no_docs).count() == 0
    assert quality.rate(odd_docs).count() == odd_docs.count()
    more = odd_docs.withColumn("kept", F.lit("x")).withColumn("model", F.lit(1))
    assert quality.keep_good(more).columns == more.columns


def test_plan_is_native(spark, odd_docs):
    plan = quality.keep_good(odd_docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "ArrowEval"))
