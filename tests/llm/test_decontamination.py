"""Leaks against aligning every window with every place, and odd inputs."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditledger.llm import decontamination as d


def least_edits(window, text):
    """Least edits between a window and any part of a text, by the plain recurrence."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(window, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def brute(items, text):
    """Items of which a window is met, the windows cut here from the stated rule."""
    own = d.normal(text or "")[0].tolist()
    met = set()
    for item, passage in items:
        whole = d.normal(passage)[0].tolist()
        for size, stride, rate in ((100, 50, 0.08), (50, 8, 0.04)):
            if len(whole) < 10 or (size == 50 and len(whole) <= 50):
                continue
            last = max(0, len(whole) - size)
            for s in {*range(0, last, stride), last}:
                window = whole[s : s + size]
                if least_edits(window, own) <= min(int(rate * len(window)), (len(window) - 10) // 10):
                    met.add(item)
    return met


@pytest.mark.parametrize("edits", [0, 2])
def test_every_fragment_of_the_least_length_is_found(edits):
    """Wherever it begins, in an item of any length; nothing of this is taken from the index."""
    rng = random.Random(17 + edits)
    for n in (12, 14, 20, 40, 90):
        passage = " ".join(words(rng, n))
        whole = "".join(map(chr, d.normal(passage)[0]))
        index = d.build([(1, " ".join(words(rng, 30))), (7, passage), (9, " ".join(words(rng, 60)))])
        for size in (d.LEAST, d.LEAST + 5, 80, 92, 110, 130):
            for at in range(0, len(whole) - size + 1, 1 if size == d.LEAST else 7):
                fragment = whole[at : at + size].strip()
                if len(fragment) < d.LEAST:
                    continue
                text = f"{' '.join(words(rng, 6))}. {edited(rng, fragment, edits)}; {' '.join(words(rng, 6))}"
                assert 7 in {m[0] for m in d.matches_of(index, text)}, (at, size)


def test_thirteen_shared_words_are_found_and_five_are_not():
    rng = random.Random(23)
    found = missed = 0
    for _ in range(60):
        passage = words(rng, 60)
        index = d.build([(1, " ".join(passage))])
        at = rng.randrange(47)
        shared = passage[at : at + 13]
        if len(" ".join(shared)) >= d.LEAST:
            found += [m[0] for m in d.matches_of(index, " ".join([*words(rng, 30), *shared, *words(rng, 30)]))] == [1]
            missed += 1
        few = [*words(rng, 30), *passage[at : at + 5], *words(rng, 30)]
        assert d.matches_of(index, " ".join(few)) == []
    assert found == missed > 10


def test_an_index_of_a_full_block_is_small():
    """What it holds, and the most held while it is built."""
    import tracemalloc

    rng = np.random.default_rng(1)
    letters = np.array(list("abcdefghijklmnopqrst "))
    items = [(i, "".join(letters[rng.integers(0, 21, 4000)])) for i in range(d.BLOCK_CHARS // 4000)]
    tracemalloc.start()
    index = d.build(items)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert most < 500 << 20
    assert sum(a.nbytes for a in index.__dict__.values() if isinstance(a, np.ndarray)) < 250 << 20


def words(rng, n):
    return [
        "".join(rng.choice(["th", "er", "on", "a", "ing", "qu"]) for _ in range(rng.randrange(1, 4)))
        for _ in range(n)
    ]


def edited(rng, text, n):
    chars = list(text)
    for _ in range(n):
        at = rng.randrange(len(chars))
        rng.choice([lambda: chars.pop(at), lambda: chars.insert(at, "z"), lambda: chars.__setitem__(at, "y")])()
    return "".join(chars)


@pytest.mark.parametrize("seed", range(4))
def test_like_aligning_everything(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(words(rng, rng.randrange(3, 45)))) for i in range(8)]
    index = d.build(items)
    for _ in range(12):
        _, passage = rng.choice(items)
        n = rng.choice([0, 1, 3, len(passage) // 14, len(passage) // 10, len(passage) // 6])
        text = " ".join([*words(rng, 25), edited(rng, passage, n).upper(), *words(rng, 25)])
        found = {m[0] for m in d.matches_of(index, text)}
        assert found == brute(items, text)


def test_spans_and_punctuation():
    items = [(7, "The quick brown fox jumps over the lazy dog and runs away again")]
    text = "Before.\n\nThe -- QUICK, brown fox;  jumps over\nthe lazy dog (and runs) away again! After"
    ((item, regions, start, end, edits),) = d.matches_of(d.build(items), text)
    assert (item, edits) == (7, 0) and regions >= 1
    assert text[start:end] == "The -- QUICK, brown fox;  jumps over\nthe lazy dog (and runs) away again"


def test_pieces_of_long_texts(monkeypatch):
    monkeypatch.setattr(d, "PIECE_CHARS", 700)
    rng = random.Random(9)
    passage = " ".join(words(rng, 40))
    index = d.build([(1, passage)])
    assert len(passage) > 2 * d.LEAST
    for at in range(100, 400, 7):
        text = " ".join([*words(rng, at), passage, *words(rng, 400 - at)])
        assert [m[0] for m in d.matches_of(index, text)] == [1]
    assert d.matches_of(index, " ".join(words(rng, 800))) == []


def test_hashes_of_grams():
    codes = np.array([ord(c) for c in "abcdefghijklmnopabcdefghijklmnop"], np.uint32)
    for q in (1, 2, 3, 7, 10, 12):
        hashes = d.gram_hashes(codes, q)
        assert len(hashes) == len(codes) - q + 1
        grams = [tuple(codes[i : i + q]) for i in range(len(hashes))]
        assert len(set(zip(hashes.tolist(), grams, strict=True))) == len(set(grams)) == len(set(hashes.tolist()))


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    planted = {
        (r.doc_id, b.item_id) for r in docs.collect() for b in bench if b.text in r.text
    }
    found = {(r.doc_id, r.item_id) for r in d.op4_decontamination(spark, folder).collect()}
    assert planted and planted == found


def test_blocks_give_the_same(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    whole = sorted(d.op4_decontamination(spark, folder).collect())
    monkeypatch.setattr(d, "BLOCK_CHARS", 3000)
    assert sorted(d.op4_decontamination(spark, folder).collect()) == whole


def test_odd_rows(spark, odd_docs, no_docs):
    items = [(1, None), (2, ""), (3, "one"), (4, "the long and winding road of words"), (None, "İstanbul ΑΣ 中文 𝔘nicode")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = d.leaks(odd_docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(6, 4), (7, 4), (8, None)}
    kept = d.keep_clean(odd_docs, bench)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 5, 5, None, None, 9]))
    none = bench.filter("1 = 0")
    assert d.leaks(odd_docs, none).count() == 0 and d.leaks(no_docs, bench).count() == 0
    assert d.keep_clean(odd_docs, none).count() == odd_docs.count()
    more = odd_docs.withColumn("item_id", F.lit("x")).withColumn("start", F.lit(1))
    assert d.keep_clean(more, bench).columns == more.columns
    assert d.leaks(more, bench).count() == 3
