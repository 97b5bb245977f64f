"""The n-gram join against all pairs."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditledger.llm import jaccard

LOWERED = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string"


def own_set(text: str | None, n: int = 5) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWERED))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1)))


def expected(rows: list[tuple], percent: int = 80) -> Counter:
    sets = [own_set(text) for _, text in rows]
    root = list(range(len(rows)))

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if a and sets[j] and 100 * shared >= percent * (len(a) + len(sets[j]) - shared):
                root[find(i)] = find(j)
    least = {}
    for i, (id_, _) in enumerate(rows):
        if id_ is not None:
            least[find(i)] = min(least.get(find(i), id_), id_)
    return Counter((rows[i][0], len(sets[i]), least.get(find(i))) for i in range(len(rows)))


def found(docs, **how) -> Counter:
    return Counter(tuple(r) for r in jaccard.joined(docs, **how).collect())


def near_copies(rng: random.Random, n: int, words: int, changes: int) -> list[str]:
    base = [f"w{rng.randrange(10_000)}" for _ in range(words)]
    texts = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(changes + 1)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10_000)}"
        texts.append(" ".join(own[: len(own) - rng.randrange(3)]))
    return texts


def world(seed: int) -> list[tuple]:
    """Copies, near copies around the limit, a passage that half of all texts have."""
    rng = random.Random(seed)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = near_copies(rng, 60, 80, 6) + near_copies(rng, 30, 300, 12) + near_copies(rng, 20, 7, 1)
    texts += [" ".join(f"v{rng.randrange(400)}" for _ in range(rng.randrange(60))) for _ in range(60)]
    texts = [f"{t} {passage}" if i % 2 else t for i, t in enumerate(texts)]
    texts += [texts[0]] * 30 + [texts[3].upper()] * 5
    rng.shuffle(texts)
    return [(rng.randrange(10_000), t) for t in texts]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_all_pairs(spark, seed):
    rows = world(seed)
    want = expected(rows)
    assert len({c for _, _, c in want}) < len(rows) - 60
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == want


def test_tiles_of_a_large_group(spark, monkeypatch):
    """Many tiles in several bands give the links of one."""
    monkeypatch.setattr(jaccard, "TILE_NODES", 7)
    rows = world(3)
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_marks_that_rule_nothing_out(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "MARKS", 64)
    rows = world(4)
    assert found(spark.createDataFrame(rows, SCHEMA)) == expected(rows)


def test_odd_rows(odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    more = odd_docs.withColumns({c: F.lit(1) for c in ("node", "n", "root", "u", "v", "token")})
    assert found(odd_docs) == found(more) == expected(rows)


def test_no_rows(no_docs):
    assert found(no_docs) == Counter()


def test_sets_of_exactly_the_limit(spark):
    """Eight of ten and four of five shingles shared are links, a little less is not."""
    def text(*parts):
        return " ".join(f"k{i}" for part in parts for i in part)

    rows = [
        (1, text(range(12))), (2, text(range(14))),
        (3, text(range(100, 113))), (4, text(range(100, 110))),
        (5, text(range(200, 208))), (6, text(range(200, 209))),
    ]
    want = expected(rows)
    assert {c for _, _, c in want} == {1, 3, 4, 5}
    assert found(spark.createDataFrame(rows, SCHEMA)) == want


def test_bands_hold_every_possible_pair():
    for percent in (50, 80, 95):
        edges = jaccard.bands(3000, percent)
        band = np.searchsorted(edges, np.arange(1, 3001), side="right")
        for size in range(1, 3001):
            largest = min(3000, size * 100 // percent)
            assert band[largest - 1] - band[size - 1] <= 1


@pytest.mark.parametrize("percent", [60, 80, 90])
def test_linked_sets_have_an_equal_part(percent):
    """Also small sets, whose parts are often empty, and sets of different classes."""
    rng = np.random.default_rng(percent)
    met = 0
    for k in range(6000):
        size = int(rng.integers(1, 12 if k % 2 else 200))
        a = rng.integers(0, 1 << 63, size).astype(np.uint64) * np.uint64(2)
        less = int(rng.integers(0, max(1, size * (100 - percent) // 100) + 1))
        more = int(rng.integers(0, max(1, size * (100 - percent) // percent) + 1))
        b = np.r_[a[less:], rng.integers(0, 1 << 63, more).astype(np.uint64) * np.uint64(2) + np.uint64(1)]
        a, b = np.unique(a), np.unique(b)
        if len(b) and jaccard.linked(len(np.intersect1d(a, b)), len(a), len(b), percent):
            met += len(a) != len(b)
            assert len(np.intersect1d(*(jaccard.all_parts(x, percent) for x in (a, b))))
    assert met > 1000


def test_a_shared_passage_makes_no_part_equal():
    rng = np.random.default_rng(9)
    passage = rng.integers(0, 1 << 63, 60).astype(np.uint64) * np.uint64(2)
    sets = [
        np.unique(np.r_[passage, rng.integers(0, 1 << 63, 500).astype(np.uint64) * np.uint64(2)])
        for _ in range(40)
    ]
    own = [jaccard.all_parts(s, 80) for s in sets]
    pairs = [(i, j) for i in range(40) for j in range(i) if len(np.intersect1d(own[i], own[j]))]
    assert len(pairs) < 40


def test_words_of_every_length(monkeypatch):
    """Long words, and texts in pieces cut between words, have the shingles of the whole."""
    text = " ".join("x" * k + "Y" for k in (1, 5, 300, 255, 256, 257, 3, 2000, 9, 1))
    whole = jaccard.shingles(text)
    assert len(whole) == 6
    for piece in (1, 7, 400):
        monkeypatch.setattr(jaccard, "PIECE", piece)
        assert (jaccard.shingles(text) == whole).all()
    assert (jaccard.shingles(text.lower()) == whole).all()


def test_shingles_do_not_depend_on_the_pieces():
    words = [f"a{i}" for i in range(50)]
    whole = jaccard.shingles(" ".join(words))
    assert len(whole) == 46
    for k in range(46):
        assert np.isin(jaccard.shingles(" ".join(words[k : k + 5])), whole).all()
    assert not np.isin(jaccard.shingles("a1 a2 a3 a5 a4"), whole).any()
    assert not np.isin(jaccard.shingles("a1 a2 a3 a4"), whole).any()
