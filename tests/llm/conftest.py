from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

#: Odd rows: null and empty texts, repeated rows, a null id, a long text, a null source.
LONG = "the long and winding road of words. " * 4000


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [
        (1, None, "en", "a", 0),
        (2, "", "en", "a", 0),
        (3, " \t\n", None, None, 3),
        (4, "one", "en", "b", 3),
        (5, "one", "en", "b", 3),
        (5, "one", "en", "b", 3),
        (None, "one two", None, None, 7),
        (None, "one two", None, None, 7),
        (6, LONG, "en", "a", len(LONG)),
        (7, LONG, "en", "c", len(LONG)),
        (8, "İstanbul ΑΣ 中文 𝔘nicode   x y", "tr", "c", 10),
        (9, "12 34 --- !!", None, "c", 12),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("1 = 0")
