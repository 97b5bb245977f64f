"""Token counts: batches of texts are encoded in Arrow functions that return lengths only.

Texts are grouped into batches of about ``BATCH_BYTES``, so that a few long texts do not share
a call with thousands of others, and texts over ``PIECE_BYTES`` are split where no token can
cross and the counts of the parts add up to that of the whole.  For a sentencepiece model that
writes a space as a mark at the start of a piece, this is a single space between two other
characters: no piece has the mark after another character, and the mark the model puts before
each text stands for the space that was cut out.  Both are tested when the model is loaded;
a model that fails, or a text without such a place, is encoded whole.

The tokenizer's file is read on the driver and its content, under a few megabytes, goes to the
tasks, so that executors need not have the file.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens; special strings in a
text are treated as the library does by default; no begin, end or added tokens are counted.
Rows are kept as they are, repeated ones and null ids included.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, read

BATCH_BYTES = 1 << 20
PIECE_BYTES = 1 << 16
TOKEN_LIMIT = 4096
#: What a sentencepiece model writes for a space.
MARK = "▁".encode()


def splits_at_spaces(processor) -> bool:
    """Whether counts add up when a text is cut at a single space and the space left out."""
    mark = "▁"
    pieces = map(processor.id_to_piece, range(processor.get_piece_size()))
    if any(mark in piece.lstrip(mark) for piece in pieces):
        return False
    probes = ("ab cd", "a. B", "x\n y", "é 1", "<s> <unk>", "中 文")

    def n(text: str) -> int:
        return len(processor.encode(text))

    return all(n(p) == sum(map(n, p.split(" "))) for p in probes if "\n" not in p)


def parts(text: bytes, size: int) -> Iterator[bytes]:
    """Cut UTF-8 at single spaces, at the first one after each ``size`` bytes."""
    place = re.compile(b"(?<=[^ \n])(?<!%b) (?=[^ \n])(?!%b)" % (MARK, MARK))
    start = 0
    while len(text) - start > size and (found := place.search(text, start + size)):
        yield text[start : found.start()]
        start = found.end()
    yield text[start:]


def loader(path: str) -> Callable[[], tuple[Callable[[list[str]], list[int]], bool]]:
    """A function for the tasks that loads the tokenizer of a ``.model`` or ``.json`` file."""
    content = Path(path).read_bytes()
    json_file = path.endswith(".json")

    def load():
        if json_file:
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_str(content.decode())

            def lengths(texts: list[str]) -> list[int]:
                return [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]

            return lengths, False
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_proto=content)
        if not splits_at_spaces(processor):
            return lambda texts: list(map(len, processor.encode(texts, num_threads=1))), False
        return lambda texts: list(map(len, processor.encode(texts, num_threads=1))), True

    return load


def count(texts: list[str], lengths: Callable[[list[str]], list[int]], may_split: bool):
    """The number of tokens of each text, encoded in batches balanced by bytes."""
    totals = [0] * len(texts)
    owners: list[int] = []
    batch: list[str] = []
    waiting = 0
    for row, text in enumerate(texts):
        data = text.encode()
        long = may_split and len(data) > PIECE_BYTES
        for part in parts(data, PIECE_BYTES) if long else (data,):
            owners.append(row)
            batch.append(part.decode() if long else text)
            waiting += len(part)
            if waiting >= BATCH_BYTES:
                for owner, n in zip(owners, lengths(batch), strict=True):
                    totals[owner] += n
                owners, batch, waiting = [], [], 0
    for owner, n in zip(owners, lengths(batch) if batch else [], strict=True):
        totals[owner] += n
    return totals


def n_tokens(text: Column, path: str) -> Column:
    """The number of tokens of a text, as a long."""
    load = loader(path)

    @F.pandas_udf("bigint")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lengths, may_split = load()
        for batch in batches:
            yield pd.Series(count(batch.fillna("").tolist(), lengths, may_split), dtype="int64")

    return counted(text)


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", limit: int = TOKEN_LIMIT
) -> DataFrame:
    """``docs`` with a struct ``_tokens``: ``n_bytes``, ``n_tokens``, ``over_limit``."""
    arrow_rows(docs.sparkSession)
    bytes_of = F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("bigint")
    counted = docs.withColumn("_tokens_n", n_tokens(F.col(text), path))
    n = F.col("_tokens_n")
    result = F.struct(
        bytes_of.alias("n_bytes"), n.alias("n_tokens"), (n > limit).alias("over_limit")
    )
    return counted.withColumn("_tokens", result).drop("_tokens_n")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "_tokens.*")
