"""The pipeline against its stages' brute-force decisions, and odd inputs."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import functions as F

from creditledger.llm import common, langid
from test_mixing import brute as brute_mix
from test_simhash import brute_components, brute_fingerprint

FOLDER = "/root/testdata/sf0.001"


def test_stages_are_the_dealt_ones():
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality_rules", "simhash_near_dedup", "benchmark_decontamination", "mixing"]


def test_each_stage_on_what_the_one_before_kept(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    own = {r.doc_id: r for r in docs.collect()}
    language = corpus_pipeline.known_language(spark, docs, FOLDER)
    assert language.columns == docs.columns
    rated = {r.doc_id: r._lang for r in langid.identify(docs).collect()}
    want = {i for i, r in rated.items() if r.lang_pred != "und" and r.score >= langid.MIN_SHARE}
    assert {r.doc_id for r in language.collect()} == want

    quality = corpus_pipeline.good_quality(spark, docs, FOLDER)
    kept = {r.doc_id for r in quality.collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    long_enough = {i for i in kept | set(labels) if len(own[i].text.split()) >= 50}
    assert not [i for i in kept if labels.get(i) == 0]
    assert not [i for i in long_enough if labels.get(i) == 1 and i not in kept]

    once = corpus_pipeline.one_of_each(spark, docs, FOLDER)
    roots = brute_components({i: brute_fingerprint(r.text) for i, r in own.items()})
    assert sorted(r.doc_id for r in once.collect()) == sorted(set(roots.values()))

    items = [r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    clean = corpus_pipeline.without_benchmarks(spark, docs, FOLDER)
    want = {i for i, r in own.items() if not any(t in r.text for t in items)}
    assert {r.doc_id for r in clean.collect()} == want

    mixed = corpus_pipeline.mixed(spark, docs, FOLDER)
    want = {r[0]: r[4] for r in brute_mix([(i, r.source, r.text) for i, r in own.items()]) if r[4]}
    assert {r.doc_id: r.taken for r in mixed.collect()} == want


def test_run_is_the_stages_in_order(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, FOLDER).collect(), docs.schema)
    want = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).select("doc_id", "taken").collect()
    got = corpus_pipeline.run(spark, FOLDER).select("doc_id", "taken").collect()
    assert sorted(got) == sorted(want) and got


def test_odd_rows(spark, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, FOLDER).count() == 0, name
        stage(spark, odd_docs, FOLDER).collect()
        more = odd_docs.withColumn("score", F.lit("x")).withColumn("size", F.lit(1))
        if name != "mixing":
            assert stage(spark, more, FOLDER).columns == more.columns, name


def test_tables_between_steps_are_removed_when_asked(spark):
    from pathlib import Path

    folder = Path(common.session_folder(spark).removeprefix("file:"))
    corpus_pipeline.run(spark, FOLDER).count()
    assert any(folder.iterdir())
    common.clean(spark)
    assert not folder.exists()
