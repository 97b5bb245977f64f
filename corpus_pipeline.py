"""A training corpus from raw documents: one operator after the other, each table written.

``STAGES`` lists the stages; each function takes (spark, docs, sf_dir) and returns a
DataFrame.  All but the last return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from creditledger.llm import decontamination, langid, mixing, quality, simhash
from creditledger.llm.common import cut, read


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with letters, unless no language has a fair share of the words."""
    return langid.keep_known(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what passes the base test and what the label model holds for good."""
    return quality.keep_good(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near copies, the one with the smallest id."""
    return simhash.keep_one(docs)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in which no benchmark passage is met."""
    return decontamination.keep_clean(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes: the documents' columns and how many words of each are taken.

    The columns of the mix replace columns of the same names.
    """
    rows = mixing.mix(docs).filter("_mix.taken > 0")
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    return rows.select(*own, "_mix.*")


STAGES = [
    ("language_id", known_language),
    ("quality_rules", good_quality),
    ("simhash_near_dedup", one_of_each),
    ("benchmark_decontamination", without_benchmarks),
    ("mixing", mixed),
]

#: Language identification learns a model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
