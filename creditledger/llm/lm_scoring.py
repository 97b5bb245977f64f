"""LM scoring: stupid-backoff scores from n-gram counts over all documents, by hash partition.

The score of a word after its predecessor is the share of the predecessor's occurrences that
go on with the word, if the pair is in the count table, that is, was seen ``MIN_COUNT`` times;
else ``BACKOFF`` times the word's share of all words.  A document's first word has its share of
all words.  Counts cover all documents, a document's score is the sum of the logarithms.

Words and pairs with a share of at least ``FREQUENT`` of all words, at most 1 / ``FREQUENT`` of
each, are found exactly: every task sums up its words with counters that may lose a bounded
number of each (Misra and Gries), and whatever may be frequent by these is counted in full.
Their counts are sent to every task, so that a frequent pair, or a frequent word that begins a
document, is scored where the text is and added up by document; it is never shuffled.

The other pairs are partitioned by hash: to the partition of the second word, to that of the
first word if only that one is rare, and to one of its own if both are frequent.  A partition
thus has all occurrences of its rare words, and so the count table of its pairs and words.  One
word or pair has less than ``FREQUENT`` of all rows, which is less than a mean partition up to
``PARTITION_PAIRS / FREQUENT`` words, 2.5e11 of them.  A partition joins the pairs to these
counts and sums by document.  What is left are pairs of two rare words, whose first word is
counted elsewhere: these rows are joined to the table of word counts, and all partial sums of a
document are added up.  Between the steps pairs travel in packed arrays, one row for each batch
of documents and partition, that list a word once however often the batch has it.

Words and pairs are known by 64-bit hashes.

Defined results: a text without words, null or empty, has 0 words and a null score.  Rows are
scored one by one, repeated ones and null ids included; ids are taken as longs.  An empty table
gives an empty table.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, cut, read

BACKOFF = 0.4
MIN_COUNT = 2
#: Pairs that a partition holds on average, and words that are packed at once.
PARTITION_PAIRS = 2_500_000
BATCH_WORDS = 700_000
#: Bytes of text that a task sums up at least, so that it can leave out what is rare in many.
TASK_BYTES = 16 << 20
#: Words and pairs of at least this share of all words are frequent.
FREQUENT = 0.00001
#: Stands before the first word of a document; a word with this hash is no word of a text.
START = np.uint64(0)
MIX = np.uint64(0x9E3779B97F4A7C15)


#: White space between words, and a random number for each byte.
IS_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\x0b\x0c\r", np.uint8))
BYTE_KEYS = np.random.default_rng(1).integers(1, 1 << 63, 256, dtype=np.uint64)
#: Bytes that are hashed at once.
PIECE_BYTES = 1 << 20


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of some texts, and each text's number of words.

    A word's hash is the sum of its bytes' numbers times powers of an odd number, then mixed.
    It is taken over all words at once, text after text without a copy of any word.
    """
    texts = texts.fill_null("") if texts.null_count else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset :][: len(texts) + 1]
    if not len(texts) or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)
    hashes, sizes = [], []
    at = 0
    while at < len(texts):
        # As many whole texts as make a piece.
        stop = max(at + 1, int(np.searchsorted(offsets, offsets[at] + PIECE_BYTES, "right")) - 1)
        own = data[offsets[at] : offsets[stop]]
        bounds = (offsets[at : stop + 1] - offsets[at]).astype(np.int64)
        inside = ~IS_SPACE[own]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        first_bytes = bounds[:-1][bounds[:-1] < bounds[1:]]
        begins[first_bytes] = inside[first_bytes]
        starts = np.flatnonzero(begins)
        sizes.append(np.diff(np.searchsorted(starts, bounds)))
        if len(starts):
            places = np.flatnonzero(inside)
            first = np.searchsorted(places, starts)
            lengths = np.diff(np.concatenate([first, [len(places)]]))
            in_word = np.arange(len(places)) - np.repeat(first, lengths)
            powers = np.full(int(lengths.max()), MIX)
            powers = np.cumprod(powers, dtype=np.uint64)
            total = np.add.reduceat(BYTE_KEYS[own[places]] * powers[in_word], first)
            total = (total ^ (total >> np.uint64(32))) * MIX
            total ^= total >> np.uint64(29)
            hashes.append(np.where(total == START, MIX, total))
        at = stop
    none = [np.zeros(0, np.uint64)]
    return np.concatenate(hashes or none), np.concatenate(sizes).astype(np.int64)


def paired(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first ^ (second * MIX)) * MIX
    return mixed ^ (mixed >> np.uint64(29))


@dataclass
class Frequent:
    """Sorted hashes of the frequent words and pairs, and their exact counts."""

    words: np.ndarray
    counts: np.ndarray
    pairs: np.ndarray
    pair_counts: np.ndarray
    n_words: int


#: What is counted: words, pairs, all words together, and what counters may have lost.
WORDS, PAIRS, ALL, LOST = range(4)
COUNTED = "kind int, key bigint, n bigint"


def counted_rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    columns = [
        pa.array(np.full(len(n), kind, np.int32)),
        pa.array(keys.astype(np.uint64).view(np.int64)),
        pa.array(n.astype(np.int64)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["kind", "key", "n"])


def words_and_pairs(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The hashes of the words and of the pairs of some texts, ``BATCH_WORDS`` at once."""
    words, sizes = word_hashes(texts)
    begins = np.zeros(len(words), bool)
    begins[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    for a in range(0, len(words), BATCH_WORDS):
        stop = min(a + BATCH_WORDS, len(words))
        second = np.flatnonzero(~begins[a:stop]) + a
        yield words[a:stop], paired(words[second - 1], words[second])


class Counters:
    """Counts of at most ``size`` keys; no key lost more than ``lost`` of its occurrences."""

    def __init__(self, size: int):
        self.size, self.lost = size, 0
        self.keys, self.n = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, keys: np.ndarray) -> None:
        keys, n = np.unique(keys, return_counts=True)
        self.keys, at = np.unique(np.concatenate([self.keys, keys]), return_inverse=True)
        self.n = np.bincount(at, np.concatenate([self.n, n]), len(self.keys)).astype(np.int64)
        if len(self.keys) > self.size:
            # What is taken off is taken off more than ``size`` keys at once.
            off = np.partition(self.n, -self.size - 1)[-self.size - 1]
            self.lost += int(off)
            self.n -= off
            self.keys, self.n = self.keys[self.n > 0], self.n[self.n > 0]


def candidates(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Sorted hashes of words and pairs, all frequent ones among them; the number of all words."""
    share = FREQUENT

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {kind: Counters(max(1, int(4 / share))) for kind in (WORDS, PAIRS)}
        n_all = 0
        for batch in batches:
            for words, pairs in words_and_pairs(batch.column("text")):
                n_all += len(words)
                found[WORDS].add(words)
                found[PAIRS].add(pairs)
        yield counted_rows(ALL, np.zeros(1), np.array([n_all]))
        least = int(n_all * share / 4)
        for kind, own in found.items():
            kept = own.n > least
            yield counted_rows(kind, own.keys[kept], own.n[kept])
            yield counted_rows(LOST, np.array([kind]), np.array([own.lost + least]))

    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    texts = docs.select("text").coalesce(max(1, size // TASK_BYTES))
    sums = texts.mapInArrow(summed, COUNTED).groupBy("kind", "key")
    sums = cut(sums.agg(F.sum("n").alias("n")))
    totals = {(r.kind, r.key): r.n for r in sums.filter(F.col("kind") >= ALL).collect()}
    n_words = totals.get((ALL, 0), 0)
    found = []
    for kind in (WORDS, PAIRS):
        least = least_count(n_words, kind) - totals.get((LOST, kind), 0)
        own = sums.filter((F.col("kind") == kind) & (F.col("n") >= least)).select("key")
        found.append(np.sort(own.toArrow()["key"].to_numpy().view(np.uint64)))
    return *found, n_words


def least_count(n_words: int, kind: int) -> int:
    """How often a frequent word or pair is met; pairs below ``MIN_COUNT`` are not counted."""
    return max(MIN_COUNT if kind == PAIRS else 1, int(n_words * FREQUENT))


def frequent_words(docs: DataFrame) -> Frequent:
    """The frequent words and pairs with their counts over all texts."""
    *keys, n_words = candidates(docs)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(len(k), np.int64) for k in keys]
        for batch in batches:
            for both in words_and_pairs(batch.column("text")):
                for known, total, own in zip(keys, sums, both, strict=True):
                    at, met = places(known, own)
                    total += np.bincount(at[met], minlength=len(known))
        for kind, known, total in zip((WORDS, PAIRS), keys, sums, strict=True):
            yield counted_rows(kind, known[total > 0], total[total > 0])

    sums = docs.select("text").mapInArrow(counted, COUNTED).groupBy("kind", "key")
    table = sums.agg(F.sum("n").alias("n")).toArrow()
    kinds, found, n = (table[c].to_numpy() for c in ("kind", "key", "n"))
    exact = []
    for kind in (WORDS, PAIRS):
        own = (kinds == kind) & (n >= least_count(n_words, kind))
        hashes = found[own].view(np.uint64)
        order = np.argsort(hashes)
        exact += [hashes[order], n[own][order]]
    return Frequent(*exact, n_words)


def places(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The place of each key among sorted ones, and whether it is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


def lookup(sorted_words: np.ndarray, values: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The value of each word, 0 for words that are not listed."""
    if not len(sorted_words):
        return np.zeros(len(words), values.dtype)
    at, met = places(sorted_words, words)
    return np.where(met, values[at], values.dtype.type(0))


def small(values: np.ndarray) -> np.ndarray:
    """The values in two bytes each if they fit, else in four."""
    return values.astype(np.uint16 if not len(values) or values.max() < 1 << 16 else np.uint32)


def grown(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.uint16 if len(data) == 2 * n else np.uint32).astype(np.int64)


PACKED = (
    "part int, first_row bigint, n_pairs bigint, words binary, runs binary, firsts binary, "
    "first_at binary, doc_at binary, doc_ids binary, doc_words binary, doc_rows binary, "
    "doc_sums binary"
)


def packed(n_parts: int, frequent: Frequent):
    """Arrow batches of (doc_id, text) to rows of ``PACKED``.

    A row has, sorted by word, the different words with the lengths of their runs, and for each
    pair the place of its first word in ``firsts`` and of its document in the batch.  Each
    partition also gets its share of the batch's documents: row, id, number of words, and the
    sum of what is scored here, by the counts of frequent words and pairs.
    """
    # Two bytes are sorted in linear time.
    part_type = np.uint16 if n_parts < 1 << 16 else np.uint32

    def pack(doc_ids: pa.Array, texts: pa.Array, first_row: int) -> pa.RecordBatch:
        second, sizes = word_hashes(texts)
        doc = np.repeat(np.arange(len(texts)), sizes)
        first = np.concatenate([[START], second[:-1]]).astype(np.uint64)[: len(second)]
        starts = (np.cumsum(sizes) - sizes)[sizes > 0]
        at, hot = places(frequent.words, second)
        n_second = frequent.counts[at] if len(frequent.words) else at
        n_first = np.concatenate([[0], n_second[:-1]])[: len(second)]
        hot_before = np.concatenate([[True], hot[:-1]])[: len(second)]
        first[starts], hot_before[starts] = START, True
        begins = np.zeros(len(second), bool)
        begins[starts] = True
        own = np.flatnonzero(begins & hot)
        both = np.flatnonzero(hot & hot_before & ~begins)
        at, met = places(frequent.pairs, paired(first[both], second[both]))
        both, at = both[met], at[met]
        sums = np.bincount(doc[own], np.log(n_second[own] / frequent.n_words), len(texts))
        if len(both):
            value = np.log(frequent.pair_counts[at] / n_first[both])
            sums = sums + np.bincount(doc[both], value, len(texts))
        rest = np.ones(len(second), bool)
        rest[own], rest[both] = False, False
        second, first, doc = second[rest], first[rest], doc[rest]
        hot, hot_before = hot[rest], hot_before[rest]
        key = np.where(hot, np.where(hot_before, paired(first, second), first * MIX), second * MIX)
        part = ((key >> np.uint64(20)) % np.uint64(n_parts)).astype(part_type)
        order = np.argsort(second)
        order = order[np.argsort(part[order], kind="stable")]
        part, second, first, doc = part[order], second[order], first[order], doc[order]
        bounds = np.concatenate([[0], np.cumsum(np.bincount(part, minlength=n_parts))])
        known_id = ~np.asarray(doc_ids.is_null())
        id_values = doc_ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        row_part = (first_row + np.arange(len(texts))) % n_parts
        rows = []
        for p in range(n_parts):
            own = slice(bounds[p], bounds[p + 1])
            n = bounds[p + 1] - bounds[p]
            mine = np.flatnonzero(row_part == p)
            if not n and not len(mine):
                continue
            words = second[own]
            new = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])[:n])
            runs = np.diff(np.concatenate([new, [n]]))
            firsts, first_at = np.unique(first[own], return_inverse=True)
            # A null id is told apart by its number of words, written as its complement.
            counts = np.where(known_id[mine], sizes[mine], ~sizes[mine])
            rows.append(
                (
                    p,
                    first_row,
                    int(n),
                    words[new].tobytes(),
                    small(runs).tobytes(),
                    firsts.tobytes(),
                    small(first_at).tobytes(),
                    small(doc[own]).tobytes(),
                    id_values[mine].tobytes(),
                    counts.astype(np.int64).tobytes(),
                    small(mine).tobytes(),
                    sums[mine].astype(np.float64).tobytes(),
                )
            )
        kinds = [pa.int32(), pa.int64(), pa.int64(), *[pa.binary()] * 9]
        names = [f.split()[0] for f in PACKED.split(", ")]
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # Rows of a task are numbered from a start that no other task reaches.
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            # About six bytes make a word.
            filled = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False))
            group = filled // (6 * BATCH_WORDS)
            cuts = np.flatnonzero(np.diff(group)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(texts)], strict=True):
                if b > a:
                    yield pack(ids.slice(a, b - a), texts.slice(a, b - a), row)
                    row += int(b - a)

    return pieces


#: What a partition finds: sums of documents, requests for counts of first words, counts of
#: words, and documents.
FOUND = "kind string, key bigint, doc_row bigint, value double, n bigint"


def joined(frequent: np.ndarray, counts: np.ndarray, n_words: int):
    """All rows of a partition to rows of ``FOUND``; ``frequent`` words are counted already."""

    def rows(kind: str, key, doc_row, value, n) -> pa.Table:
        size = len(n)
        columns = [
            pa.DictionaryArray.from_arrays(np.zeros(size, np.int8), [kind]).cast(pa.string()),
            pa.array(np.zeros(size, np.int64) if key is None else key, pa.int64()),
            pa.array(np.zeros(size, np.int64) if doc_row is None else doc_row, pa.int64()),
            pa.array(np.zeros(size) if value is None else value, pa.float64()),
            pa.array(n, pa.int64()),
        ]
        return pa.table(columns, names=[f.split()[0] for f in FOUND.split(", ")])

    def join(table: pa.Table) -> pa.Table:
        # Words are kept as listed in the packed rows; pairs refer to their places.
        seconds, runs, firsts, first_at, doc_at, doc_rows = [], [], [], [], [], []
        ids, id_rows, own_sums, sizes = [], [], [], []
        n_firsts = n_docs = 0
        for r in table.to_pylist():
            own = np.frombuffer(r["words"], np.uint64)
            seconds.append(own)
            runs.append(grown(r["runs"], len(own)))
            own = np.frombuffer(r["firsts"], np.uint64)
            firsts.append(own)
            first_at.append((grown(r["first_at"], r["n_pairs"]) + n_firsts).astype(np.int32))
            n_firsts += len(own)
            at = grown(r["doc_at"], r["n_pairs"])
            here = int(at.max()) + 1 if len(at) else 0
            doc_at.append((at + n_docs).astype(np.int32))
            doc_rows.append(np.arange(here) + r["first_row"])
            n_docs += here
            own = np.frombuffer(r["doc_ids"], np.int64)
            ids.append(own)
            id_rows.append(grown(r["doc_rows"], len(own)) + r["first_row"])
            own_sums.append(np.frombuffer(r["doc_sums"], np.float64))
            sizes.append(np.frombuffer(r["doc_words"], np.int64))
        del table
        out = [rows("document", *map(np.concatenate, (ids, id_rows, own_sums, sizes)))]
        seconds, runs, firsts = map(np.concatenate, (seconds, runs, firsts))
        first_at, doc_at, doc_rows = map(np.concatenate, (first_at, doc_at, doc_rows))
        if not len(first_at):
            return out[0]
        words, at = np.unique(seconds, return_inverse=True)
        n = np.bincount(at, runs).astype(np.int64)
        hot_counts = lookup(frequent, counts, words)
        log_share = np.log(np.where(hot_counts > 0, hot_counts, n) / n_words)[at]
        words, n = words[hot_counts == 0], n[hot_counts == 0]
        out.append(rows("word", words.view(np.int64), None, None, n))
        # A rare first word is counted here if its own pairs are; else its count is 0 so far.
        n_first = lookup(frequent, counts, firsts)
        n_first = np.where(n_first > 0, n_first, lookup(words, n, firsts))
        second_at = np.repeat(np.arange(len(seconds), dtype=np.int32), runs)
        pairs = paired(firsts[first_at], seconds[second_at])
        order = np.argsort(pairs)
        new = np.flatnonzero(np.concatenate([[True], np.diff(pairs[order]) != 0]))
        del pairs
        lengths = np.diff(np.concatenate([new, [len(order)]]))
        n_pair = np.empty(len(order), np.int32)
        n_pair[order] = np.repeat(lengths, lengths)
        del order, new, lengths
        begins = (firsts == START)[first_at]
        found = (n_pair >= MIN_COUNT) & ~begins
        value = np.where(begins, 0.0, np.log(BACKOFF)) + log_share[second_at]
        del second_at
        history = np.log(np.maximum(n_first, 1))[first_at[found]]
        value[found] = np.log(n_pair[found]) - history
        del n_pair, history
        sums = np.bincount(doc_at, value, n_docs)
        backed_off = np.bincount(doc_at[~found & ~begins], minlength=n_docs)
        met = np.bincount(doc_at, minlength=n_docs) > 0
        out.append(rows("sum", None, doc_rows[met], sums[met], backed_off[met]))
        asked = np.flatnonzero(found & (n_first == 0)[first_at])
        key, doc = firsts[first_at[asked]].view(np.int64), doc_rows[doc_at[asked]]
        out.append(rows("ask", key, doc, None, np.ones(len(asked), np.int64)))
        return pa.concat_tables(out)

    return join


def rare_pairs(docs: DataFrame, frequent: Frequent) -> DataFrame:
    """Rows of ``PACKED``: what is not scored by the counts of frequent words and pairs."""
    n_parts = max(1, -(-frequent.n_words // PARTITION_PAIRS))
    return docs.mapInArrow(packed(n_parts, frequent), PACKED)


def score(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_backed_off``, ``score``.

    ``score`` is the sum of the natural logarithms of its words' scores.
    """
    # Words are listed once a batch, so that larger ones make fewer bytes.
    arrow_rows(docs.sparkSession, 10_000)
    own = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    frequent = frequent_words(own)
    join = joined(frequent.words, frequent.counts, frequent.n_words)
    found = cut(rare_pairs(own, frequent).groupBy("part").applyInArrow(join, FOUND))

    def of(kind: str) -> DataFrame:
        return found.filter(F.col("kind") == kind)

    words = of("word").select(F.col("key").alias("word"), F.col("n").alias("n_word"))
    asked = of("ask").groupBy("key", "doc_row").agg(F.sum("n").alias("times"))
    answers = asked.join(words, F.col("key") == F.col("word")).select(
        "doc_row",
        (-F.col("times") * F.log("n_word")).alias("value"),
        F.lit(0).cast("bigint").alias("n"),
    )
    sums = of("sum").select("doc_row", "value", "n").unionByName(answers)
    sums = sums.groupBy("doc_row").agg(F.sum("value").alias("score"), F.sum("n").alias("n_backed"))
    documents = of("document").select(
        F.when(F.col("n") >= 0, F.col("key")).alias("doc_id"),
        F.col("doc_row").alias("row"),
        F.when(F.col("n") < 0, F.bitwise_not("n")).otherwise(F.col("n")).alias("n_words"),
        F.col("value").alias("own"),
    )
    total = F.col("own") + F.coalesce("score", F.lit(0.0))
    return documents.join(sums, F.col("row") == F.col("doc_row"), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_backed", F.lit(0)).alias("n_backed_off"),
        F.when(F.col("n_words") > 0, total).alias("score"),
    )


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score(read(spark, sf_dir, "documents"))
    return scored.withColumn("score", F.round("score", 6))


OP2_SQL = r"""
WITH words AS (
  SELECT r, doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT row_number() OVER () AS r, doc_id,
               regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
        FROM documents)
), pairs AS (
  SELECT r, word, lag(word) OVER (PARTITION BY r ORDER BY i) AS before FROM words
), word_counts AS (
  SELECT word, count(*) AS n FROM words GROUP BY word
), pair_counts AS (
  SELECT before, word, count(*) AS n FROM pairs WHERE before IS NOT NULL
  GROUP BY before, word HAVING count(*) >= 2
), scored AS (
  SELECT r, p.before IS NOT NULL AND c.n IS NULL AS backed_off,
         CASE WHEN c.n IS NOT NULL THEN ln(c.n / f.n)
              ELSE ln(s.n / (SELECT count(*) FROM words))
                   + CASE WHEN p.before IS NULL THEN 0 ELSE ln(0.4::DOUBLE) END END AS value
  FROM pairs p JOIN word_counts s USING (word)
  LEFT JOIN pair_counts c ON c.before = p.before AND c.word = p.word
  LEFT JOIN word_counts f ON f.word = p.before
), sums AS (
  SELECT r, count(*) AS n_words, count(*) FILTER (WHERE backed_off) AS n_backed_off,
         round(sum(value), 6) AS score
  FROM scored GROUP BY r
)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_backed_off, 0) AS n_backed_off, score
FROM (SELECT row_number() OVER () AS r, doc_id FROM documents) LEFT JOIN sums USING (r)
"""
