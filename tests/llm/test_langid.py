"""Held-out accuracy, the forward-backward pass against all labellings, odd inputs."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditledger.llm import langid

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    return langid.train(langid.labelled_sample(docs, "doc_id", "text", "lang"))


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang")
    rows = langid.op9_language_id(spark, FOLDER).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held)


def test_posteriors_like_all_labellings():
    rng = np.random.default_rng(0)
    k, sizes = 3, [1, 4, 2, 5]
    scores, step = rng.normal(size=(sum(sizes), k)), rng.normal(size=(k, k))
    line = np.repeat(np.arange(len(sizes)) * 2, sizes)
    got, pairs = langid.posteriors(scores, step, line)
    want, want_pairs, at = [], np.zeros((k, k)), 0
    for n in sizes:
        own = scores[at : at + n]
        at += n
        total, marginal = 0.0, np.zeros((n, k))
        own_pairs = np.zeros((k, k))
        for labels in itertools.product(range(k), repeat=n):
            score = sum(own[i, y] for i, y in enumerate(labels))
            score += sum(step[a, b] for a, b in itertools.pairwise(labels))
            weight = np.exp(score)
            total += weight
            for i, y in enumerate(labels):
                marginal[i, y] += weight
            for a, b in itertools.pairwise(labels):
                own_pairs[a, b] += weight
        want.append(marginal / total)
        want_pairs += own_pairs / total
    assert np.allclose(got, np.concatenate(want))
    assert np.allclose(pairs, want_pairs)


def test_words_of_a_switched_line_get_their_languages(spark, model):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = docs.filter(langid.held_out("doc_id") & (F.length("text") > 500))
    english, french = (held.filter(F.col("lang") == x).first().text.split()[:40] for x in ("en", "fr"))
    line = " ".join(english[:30] + french[:30])
    codes, starts, lengths, lines = langid.words_of([line])
    marginal, _ = langid.posteriors(
        langid.emissions(model, codes, starts, lengths), model.transitions, lines
    )
    best = [model.languages[i] for i in marginal.argmax(axis=1)]
    right = sum(x == "en" for x in best[:30]) + sum(x == "fr" for x in best[-30:])
    assert right >= 54
    assert (np.diag(model.transitions) > np.median(model.transitions)).all()


def test_pieces_of_long_texts(spark, model, monkeypatch):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).collect()
    texts = [r.text for r in docs] + ["", "12", "x" * 900]
    want = langid.shares(model, texts)
    assert ["".join(langid.pieces(t)) for t in texts] == texts
    monkeypatch.setattr(langid, "BATCH_CHARS", 300)
    got = langid.shares(model, texts)
    got, want = got[:-1, :-1], want[:-1, :-1]
    assert (got.argmax(axis=1) == want.argmax(axis=1)).mean() > 0.95
    assert np.abs(got - want).max() < 0.1


def test_learns_from_text_and_allowed_languages_only(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    spoiled = docs.withColumn("lang", F.when(langid.held_out("doc_id"), "xx").otherwise(F.col("lang")))
    spoiled = spoiled.withColumn("source", F.lit(None).cast("string"))
    want = langid.identify(docs).select("doc_id", "_lang.*").collect()
    got = langid.identify(spoiled).select("doc_id", "_lang.*").collect()
    assert sorted(got) == sorted(want)


def test_odd_rows(odd_docs, no_docs):
    rows = langid.identify(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if not r.text or not any(c.isalpha() for c in r.text):
            assert (r._lang.lang_pred, r._lang.score) == ("und", 0.0)
    assert langid.identify(no_docs).count() == 0
    unknown = odd_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r._lang.lang_pred for r in langid.identify(unknown).collect()} == {"und"}
    more = odd_docs.withColumn("lang_pred", F.lit("x")).withColumn("score", F.lit(1))
    assert langid.keep_known(more).columns == more.columns


def made_languages(spark, n, docs_each):
    """Documents in made languages, each with some words of its own."""
    rng = np.random.default_rng(5)
    letters = [chr(c) for c in range(0x61, 0x7B)]
    rows = []
    for j in range(n):
        words = ["".join(rng.choice(letters, rng.integers(3, 9))) for _ in range(40)]
        for _ in range(docs_each if j else 40 * docs_each):
            rows.append((len(rows), " ".join(rng.choice(words, 30)), f"l{j:03d}"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_every_language_is_learned(spark):
    docs = made_languages(spark, 100, 15)
    rows = langid.identify(docs).select(langid.held_out("doc_id").alias("held"), "lang", "_lang.lang_pred").collect()
    assert len({r.lang_pred for r in rows}) == 100
    held = [r for r in rows if r.held]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.95 * len(held)


def test_the_size_of_a_model_is_bounded():
    samples = [(f"l{j:04d}", f"word{chr(97 + j % 26)} {chr(97 + j // 26 % 26) * 3}") for j in range(300)]
    model = langid.train(samples)
    assert len(model.languages) == 300 and model.weights.size <= langid.MOST_WEIGHTS


def test_unlearned_languages_are_rejected_and_learned_ones_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    strange = [
        "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему",
        "幸福的家庭都是相似的，不幸的家庭各有各的不幸",
        "Wszystkie szczęśliwe rodziny są do siebie podobne, każda nieszczęśliwa rodzina jest nieszczęśliwa",
        "xkcd bvrt qwrt zxcv bnmk lpdf ghjk trwq pldk mnbv ghtr",
    ]
    known = "All happy families are alike; each unhappy family is unhappy in its own way"
    rows = [(-1 - i, t) for i, t in enumerate([*strange, known])]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in langid.keep_known(docs.unionByName(more, allowMissingColumns=True)).collect()}
    assert kept == {r.doc_id for r in docs.collect()} | {-5}


def test_copies_do_not_push_languages_out_of_the_sample(spark):
    docs = made_languages(spark, 5, 10)
    copies = docs.filter("lang = 'l000'").limit(1).crossJoin(spark.range(3000).select(F.lit(1).alias("_"))).drop("_")
    sample = langid.labelled_sample(docs.union(copies), "doc_id", "text", "lang")
    assert {lang for lang, _ in sample} == {f"l{j:03d}" for j in range(5)}
