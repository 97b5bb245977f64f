"""Counts are those of the library on the whole text."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from creditledger.llm import tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_whole_table(spark, processor):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = tokens.op3_token_counts(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n = len(processor.encode(texts[r.doc_id]))
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 4096)


def test_split_texts_count_as_whole(processor, monkeypatch):
    monkeypatch.setattr(tokens, "PIECE_BYTES", 20)
    monkeypatch.setattr(tokens, "BATCH_BYTES", 100)
    lengths, may_split = tokens.loader(MODEL)()
    assert may_split
    rng = random.Random(1)
    pieces = ["ab", " ", "  ", "\n", " c", "é", "▁", "中文", "<s>", "</s>", "\t", "x" * 30, ". ", "𝔘", " "]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(80))) for _ in range(500)]
    assert tokens.count(texts, lengths, may_split) == [len(processor.encode(t)) for t in texts]


def test_batches_and_pieces_hold_bytes(monkeypatch):
    """Characters of four bytes fill a batch, and end a piece, four times as early."""
    monkeypatch.setattr(tokens, "PIECE_BYTES", 200)
    monkeypatch.setattr(tokens, "BATCH_BYTES", 1000)
    calls = []

    def lengths(texts):
        calls.append([len(t.encode()) for t in texts])
        return [len(t.split(" ")) for t in texts]

    word = "𝔘" * 10
    texts = [" ".join([word] * 100), word, " ".join(["x" * 40] * 100), "", word]
    assert tokens.count(texts, lengths, True) == [100, 1, 100, 1, 1]
    assert max(map(sum, calls)) < 1000 + 200 + 41
    assert max(map(max, calls)) <= 200 + 41


def test_json_tokenizers(spark):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(JSON)
    texts = ["a b", "", None, "<|endoftext|> x", "é\n\n"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, text string")
    got = {r.i: r.n for r in df.select("i", tokens.n_tokens(F.col("text"), JSON).alias("n")).collect()}
    assert got == {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_odd_rows(odd_docs, no_docs, processor):
    rows = tokens.count_tokens(odd_docs, MODEL).select("text", "_tokens.*").collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.n_tokens == len(processor.encode(r.text or ""))
        assert r.n_bytes == len((r.text or "").encode())
    assert tokens.count_tokens(no_docs, MODEL).count() == 0
    more = odd_docs.withColumn("n_tokens", F.lit("x"))
    assert tokens.count_tokens(more, MODEL).columns == [*more.columns, "_tokens"]
