"""Language identification: a linear-chain conditional random field labels the words of a text.

A line is a sequence of words, runs of letters.  A word's features are its affixes, its
character n-grams, the n-grams at its ends being affixes as well, and the word itself as a
lexicon entry; each is hashed to a row of learned weights, one column per language.  Learned
transitions join neighbouring words.  The forward-backward pass gives every word its
probability of each language, and their mean over the words of a text is the text's share of
each language: the largest is the prediction, its share the score.

Every language that a document to learn from has is learned.  The model is trained on the
driver, on windows of at most ``SAMPLE_CHARS`` characters from about ``SAMPLE_DOCS`` labelled
documents of each language, taken by the hash of the id; with many languages from fewer, about
``SAMPLE_ALL`` in all, but ``LEAST_DOCS`` of each.  It has at most ``MOST_WEIGHTS`` weights of
features, as many languages share fewer rows of them.  Training sequences are made
code-switched: segments of documents in different languages take turns, so that transitions
are learned too.  Everything else covers whole texts of all documents.

A text in a language that was not learned still gets the most similar one.  What tells it apart
is its share of character trigrams that the sample has: ``keep_known`` drops texts below a
threshold that is fitted on the sample, each half measured by the trigrams of the other.

Tasks work on whole batches of words with array operations; the words of many lines move
through the chain together, longest lines first.

Defined results: a null text, or one without letters, is ``und`` with score 0, as is every text
if there is nothing to learn from; ties go to the language first in code point order; repeated
rows get equal results; a null id counts as an empty one.  Other columns are left alone;
working columns are named ``_lang...``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, read

SAMPLE_DOCS = 200
SAMPLE_CHARS = 1000
SAMPLE_ALL, LEAST_DOCS = 1600, 8
HELD_OUT_OF = 5
FEATURE_BITS, FEWEST_BITS = 17, 10
MOST_WEIGHTS = 1 << 23
#: Trigrams of the sample are marked in a table of this many bits.
SEEN_BITS = 22
#: Words of one training sequence, and of the segments it is made of.
SEQUENCE, SEGMENTS = 48, (4, 24)
ROUNDS = 40
RATE = 0.5
DECAY = 1e-4
#: Characters that a task works on at once.
BATCH_CHARS = 1 << 19
SEED = 7
#: Odd multipliers that mix hashes.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
#: Texts in which no language has this share of the words are in none.
MIN_SHARE = 0.3
#: What a text may have fewer of known trigrams, in parts, than the least known of the sample.
SLACK = 0.5


@dataclass
class Model:
    languages: list[str]
    weights: np.ndarray
    bias: np.ndarray
    transitions: np.ndarray
    seen: np.ndarray
    least_known: float

    @property
    def bits(self) -> int:
        return len(self.weights).bit_length() - 1


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of lower-cased texts; start and length of each word; number of its line.

    Texts are joined by line ends, so that no line reaches over two texts.
    """
    codes = np.frombuffer("\n".join(texts).lower().encode("utf-32-le", "replace"), "<u4")
    seen = np.flatnonzero(np.bincount(codes, minlength=1))
    letter = np.zeros(int(seen[-1]) + 1 if len(seen) else 1, bool)
    letter[seen] = [chr(c).isalpha() for c in seen]
    inside = np.concatenate([[False], letter[codes], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    line = np.cumsum(codes == 10)
    return codes, starts, ends - starts, line[starts] if len(starts) else starts


def hashed(values: np.ndarray, kind: int, bits: int) -> np.ndarray:
    mixed = (values + np.uint64(kind)) * np.uint64(MIX[0])
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(MIX[1])
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


def marked_words(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """The characters of words between two marks each; their word, place, and whether they end it."""
    n = len(starts)
    width = lengths + 2
    first = np.cumsum(width) - width
    word = np.repeat(np.arange(n), width)
    place = np.arange(len(word)) - first[word]
    last = place == width[word] - 1
    marked = np.zeros(len(word), np.uint64)
    middle = (place > 0) & ~last
    marked[middle] = codes[np.repeat(starts, lengths) + place[middle] - 1]
    marked[last] = 1
    return marked, word, place, last


def features(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, bits: int):
    """Hashed features of words: for each feature its row and its word, words in order.

    A word stands between two marks; its n-grams of one to three characters count, those with a
    mark being affixes, then affixes of three letters, and the word as a whole.
    """
    n = len(starts)
    marked, word, place, last = marked_words(codes, starts, lengths)
    middle = (place > 0) & ~last
    base = np.uint64(MIX[2])
    two = marked[:-1] * base + marked[1:]
    three = two[:-1] * base + marked[2:]
    four = three[:-1] * base + marked[3:]
    in_two = ~last[:-1]
    in_three = in_two[:-1] & ~last[1:-1]
    in_four = in_three[:-1] & ~last[2:-1]
    affix = in_four & ((place[:-3] == 0) | last[3:])
    powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(lengths.max()) + 2, base)]))
    whole = np.add.reduceat(marked * powers[place], np.flatnonzero(place == 0))
    rows = [
        hashed(marked[middle], 1, bits),
        hashed(two[in_two], 2, bits),
        hashed(three[in_three], 3, bits),
        hashed(four[affix], 4, bits),
        hashed(whole, 5, bits),
    ]
    words = [
        word[middle],
        word[:-1][in_two],
        word[:-2][in_three],
        word[:-3][affix],
        np.arange(n),
    ]
    return rows, words


def trigrams(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """The trigrams of words between marks, as places in a table of ``SEEN_BITS``, and their words."""
    marked, word, _, last = marked_words(codes, starts, lengths)
    base = np.uint64(MIX[2])
    three = (marked[:-2] * base + marked[1:-1]) * base + marked[2:]
    inside = ~last[:-2] & ~last[1:-1]
    return hashed(three[inside], 6, SEEN_BITS), word[:-2][inside]


def word_keys(codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    own = codes[np.repeat(starts, lengths) + place] + np.uint64(1)
    powers = np.cumprod(np.full(int(lengths.max()), MIX[2], np.uint64))
    return np.add.reduceat(own * powers[place], first)


def emissions(model: Model, codes, starts, lengths) -> np.ndarray:
    """The log potential of each language for each word; equal words are looked at once."""
    first, at = different(codes, starts, lengths)
    return potentials(model, codes, starts[first], lengths[first])[at]


def different(codes, starts, lengths) -> tuple[np.ndarray, np.ndarray]:
    """One word of each spelling, and the spelling of each word."""
    keys = word_keys(codes, starts, lengths)
    _, first, at = np.unique(keys, return_index=True, return_inverse=True)
    return first, at


def known_trigrams(seen: np.ndarray, codes, starts, lengths) -> np.ndarray:
    """For each word how many of its trigrams are in ``seen``, and how many it has."""
    grams, words = trigrams(codes, starts, lengths)
    n = len(starts)
    return np.stack([np.bincount(words, seen[grams], n), np.bincount(words, minlength=n)], axis=1)


def potentials(model: Model, codes, starts, lengths) -> np.ndarray:
    total = np.repeat(model.bias[None, :], len(starts), axis=0)
    rows, words = features(codes, starts, lengths, model.bits)
    for row, word in zip(rows, words, strict=True):
        if not len(word):
            continue
        gathered = model.weights[row]
        begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        total[word[begin]] += np.add.reduceat(gathered, begin, axis=0)
    return total


def posteriors(scores: np.ndarray, transitions: np.ndarray, line: np.ndarray):
    """Forward-backward over lines: each word's probability of each language.

    Words are put in the order of their place in the line, and within a place longest lines
    first, so that one step moves all lines that are still going on.  Also gives the expected
    number of times each language follows each.
    """
    n, k = scores.shape
    new = np.concatenate([[True], line[1:] != line[:-1]])
    begin = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([begin, [n]]))
    order = np.argsort(-sizes, kind="stable")
    rank = np.empty(len(sizes), np.int64)
    rank[order] = np.arange(len(sizes))
    sequence = np.cumsum(new) - 1
    place = np.arange(n) - begin[sequence]
    going = np.bincount(place)
    offset = np.concatenate([[0], np.cumsum(going)])
    to = offset[place] + rank[sequence]
    local = np.empty((n, k))
    local[to] = np.exp(scores - scores.max(axis=1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    forward = np.empty((n, k))
    for t in range(len(going)):
        own = slice(offset[t], offset[t + 1])
        alpha = local[own]
        if t:
            alpha = alpha * (forward[offset[t - 1] : offset[t - 1] + going[t]] @ step)
        forward[own] = alpha / alpha.sum(axis=1, keepdims=True)
    both = forward.copy()
    pairs = np.zeros((k, k))
    back = np.ones((0, k))
    for t in range(len(going) - 1, -1, -1):
        own = slice(offset[t], offset[t + 1])
        beta = np.ones((going[t], k))
        if len(back):
            ahead = back * local[offset[t + 1] : offset[t + 2]]
            beta[: len(back)] = ahead @ step.T
            alpha = forward[offset[t] : offset[t] + len(back)]
            mass = np.einsum("ni,ij,nj->n", alpha, step, ahead)
            pairs += (alpha / mass[:, None]).T @ ahead * step
        beta /= beta.sum(axis=1, keepdims=True)
        mixed = both[own] * beta
        both[own] = mixed / mixed.sum(axis=1, keepdims=True)
        back = beta
    return both[to], pairs


def code_switched(samples: list[tuple[str, str]], languages: list[str], rng):
    """Training lines of words from segments of different documents, with each word's language."""
    segments: list[tuple[list[str], int]] = []
    for language, text in samples:
        own = "".join(c if c.isalpha() else " " for c in text.lower()).split()
        at = 0
        while at < len(own):
            size = int(rng.integers(*SEGMENTS))
            segments.append((own[at : at + size], languages.index(language)))
            at += size
    order = rng.permutation(len(segments))
    lines: list[list[str]] = [[]]
    labels: list[int] = []
    for i in order:
        words, language = segments[i]
        if len(lines[-1]) + len(words) > SEQUENCE and lines[-1]:
            lines.append([])
        lines[-1] += words
        labels += [language] * len(words)
    return [" ".join(line) for line in lines], np.array(labels)


def train(samples: list[tuple[str, str]]) -> Model:
    """Fit weights and transitions by gradient ascent on the likelihood of the labels."""
    languages = sorted({language for language, _ in samples})
    rng = np.random.default_rng(SEED)
    k = len(languages)
    bits = max(FEWEST_BITS, min(FEATURE_BITS, (MOST_WEIGHTS // max(k, 1)).bit_length() - 1))
    weights = np.zeros((1 << bits, k), np.float32)
    seen, least = fitted_trigrams([text for _, text in samples])
    model = Model(languages, weights, np.zeros(k), np.zeros((k, k)), seen, least)
    lines, gold = code_switched(samples, languages, rng)
    codes, starts, lengths, line = words_of(lines)
    if k < 2 or not len(starts):
        return model
    assert len(starts) == len(gold), "words of letters are found again in the joined lines"
    # Equal words have equal potentials, and their gradients are added up before they spread.
    first, at = different(codes, starts, lengths)
    rows, words = features(codes, starts[first], lengths[first], bits)
    rows, words = np.concatenate(rows), np.concatenate(words)
    used, local = np.unique(rows, return_inverse=True)
    weights, squares = np.zeros((len(used), k)), np.full((len(used), k), 1e-6)
    t_squares, b_squares = np.full((k, k), 1e-6), np.full(k, 1e-6)
    truth = np.eye(k)[gold]
    follows = line[1:] == line[:-1]
    seen_pairs = truth[:-1][follows].T @ truth[1:][follows]

    def summed(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
        return np.stack([np.bincount(at, values[:, j], n) for j in range(k)], axis=1)

    def gathered(values: np.ndarray) -> np.ndarray:
        columns = (np.bincount(words, values[:, j][local], len(first)) for j in range(k))
        return np.stack(list(columns), axis=1)

    def spread(values: np.ndarray) -> np.ndarray:
        columns = (np.bincount(local, values[:, j][words], len(used)) for j in range(k))
        return np.stack(list(columns), axis=1)

    for _ in range(ROUNDS):
        scores = model.bias + gathered(weights)[at]
        marginal, pairs = posteriors(scores, model.transitions, line)
        away = truth - marginal
        gradient = spread(summed(away, at, len(first))) - DECAY * len(starts) * weights
        squares += gradient**2
        weights += RATE * gradient / np.sqrt(squares)
        change = seen_pairs - pairs
        t_squares += change**2
        model.transitions += RATE * change / np.sqrt(t_squares)
        b_change = away.sum(axis=0)
        b_squares += b_change**2
        model.bias += RATE * b_change / np.sqrt(b_squares)
    model.weights[used] = weights
    return model


def trigram_shares(seen: np.ndarray, texts: list[str]) -> np.ndarray:
    """The share of each text's trigrams that is in ``seen``; 1 without any."""
    codes, starts, lengths, line = words_of([" ".join(t.split()) for t in texts])
    found = np.zeros((len(texts), 2))
    if len(starts):
        counts = known_trigrams(seen, codes, starts, lengths)
        for j in range(2):
            found[:, j] = np.bincount(line, counts[:, j], len(texts))
    return np.where(found[:, 1] > 0, found[:, 0] / np.maximum(found[:, 1], 1), 1.0)


def marked_trigrams(texts: list[str]) -> np.ndarray:
    seen = np.zeros(1 << SEEN_BITS, bool)
    codes, starts, lengths, _ = words_of(texts)
    if len(starts):
        seen[trigrams(codes, starts, lengths)[0]] = True
    return seen


def fitted_trigrams(texts: list[str]) -> tuple[np.ndarray, float]:
    """The trigrams of the sample, and the share of them that a known text has at least.

    The halves of the sample measure each other.  A sample too small or too mixed to know its
    own texts by each other sets a low threshold, and so drops little.
    """
    halves = texts[::2], texts[1::2]
    seen = [marked_trigrams(half) for half in halves]
    across = [trigram_shares(seen[1 - i], halves[i]) for i in range(2) if halves[i]]
    least = min((float(s.min()) for s in across), default=0.0)
    return seen[0] | seen[1], SLACK * least


def held_out(id_column: str) -> Column:
    """Whether a document is kept from learning: CRC-32 of the id's text, modulo 5, is 0."""
    text = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text), F.lit(HELD_OUT_OF)) == 0


def labelled_sample(docs: DataFrame, id_column: str, text: str, lang: str) -> list[tuple[str, str]]:
    """Windows of text of about ``SAMPLE_DOCS`` documents of each language, or fewer if many.

    The driver holds a count for each language.  Should copies make more of them, the limit cuts
    every language by the same share.
    """
    known = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(id_column))
    counts = known.groupBy(F.col(lang).alias("_lang")).count()
    found = counts.orderBy("_lang").collect()
    if not found:
        return []
    whole = 1 << 40
    each = max(LEAST_DOCS, min(SAMPLE_DOCS, SAMPLE_ALL // len(found)))
    bounds = F.create_map(
        *[F.lit(x) for r in found for x in (r._lang, each * whole // r["count"])]
    )
    hashed = F.pmod(F.xxhash64(id_column, text, F.lit(SEED)), F.lit(whole))
    chosen = known.filter(hashed <= bounds[F.col(lang)])
    start = F.pmod(hashed, F.greatest(F.length(text) - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
    window = F.substring(F.col(text), start, F.lit(SAMPLE_CHARS)).alias("_window")
    place = (hashed / F.least(bounds[F.col(lang)], F.lit(whole))).alias("_place")
    rows = chosen.select(F.col(lang).alias("_lang"), window, place).distinct()
    most = 2 * each * len(found)
    taken = rows.orderBy("_place", "_window", "_lang").limit(most).collect()
    return [(r._lang, r._window) for r in taken]


def pieces(text: str) -> Iterator[str]:
    """Cut a long text at line ends, or else at spaces, into pieces of a batch at most."""
    at = 0
    while len(text) - at > BATCH_CHARS:
        stop = at + BATCH_CHARS
        stop = text.rfind("\n", at, stop) + 1 or text.rfind(" ", at, stop) + 1 or stop
        yield text[at:stop]
        at = stop
    yield text[at:]


def in_batches(texts: list[str]) -> Iterator[tuple[list[int], list[str]]]:
    """Batches of pieces, with the text that each belongs to."""
    owners, parts, waiting = [], [], 0
    for owner, text in enumerate(texts):
        for part in pieces(text):
            owners.append(owner)
            parts.append(part)
            waiting += len(part)
            if waiting >= BATCH_CHARS:
                yield owners, parts
                owners, parts, waiting = [], [], 0
    if parts:
        yield owners, parts


def totals(model: Model, texts: list[str]) -> np.ndarray:
    """Sums over each text's words: probabilities of each language, words, trigrams known and all."""
    codes, starts, lengths, line = words_of(texts)
    k = len(model.languages)
    found = np.zeros((len(texts), k + 3))
    if not len(starts) or not k:
        return found
    first, at = different(codes, starts, lengths)
    own = codes, starts[first], lengths[first]
    marginal, _ = posteriors(potentials(model, *own)[at], model.transitions, line)
    lowered = np.array([len(t.lower()) + 1 for t in texts])
    owner = np.searchsorted(np.cumsum(lowered), starts, side="right")
    for j in range(k):
        found[:, j] = np.bincount(owner, marginal[:, j], len(texts))
    found[:, k] = np.bincount(owner, minlength=len(texts))
    grams = known_trigrams(model.seen, *own)[at]
    for j in range(2):
        found[:, k + 1 + j] = np.bincount(owner, grams[:, j], len(texts))
    return found


def shares(model: Model, texts: list[str]) -> np.ndarray:
    """For each text the mean probability of each language over its words; zeros without words.

    The last column is the share of its trigrams that the sample has.
    """
    k = len(model.languages)
    found = np.zeros((len(texts), k + 3))
    for owners, parts in in_batches(texts):
        np.add.at(found, owners, totals(model, parts))
    found[:, :k] /= np.maximum(found[:, k : k + 1], 1)
    found[:, k] = found[:, k + 1] / np.maximum(found[:, k + 2], 1)
    return found[:, : k + 1]


def predicted(text: Column, model: Model) -> Column:
    """A struct of ``lang_pred``, ``score``, ``known`` and ``is_known``.

    ``known`` is the share of the text's trigrams that the sample has; 0 without letters.
    """

    @F.pandas_udf("lang_pred string, score double, known double, is_known boolean")
    def labelled(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            share = shares(model, batch.fillna("").tolist())
            share, known = share[:, :-1], share[:, -1]
            # Nothing at all is more than nothing: texts without words are ``und``.
            share = np.concatenate([share, np.where(share.any(axis=1), 0.0, 1e-9)[:, None]], axis=1)
            best = share.argmax(axis=1)
            score = np.where(best < len(model.languages), share.max(axis=1), 0.0)
            yield pd.DataFrame(
                {
                    "lang_pred": names[best],
                    "score": np.minimum(score, 1.0),
                    "known": known,
                    "is_known": (best < len(model.languages)) & (known >= model.least_known),
                }
            )

    return labelled(text)


def identify(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``docs`` with a struct ``_lang`` of ``lang_pred``, ``score``, ``known`` and ``is_known``.

    The model learns from the rows of ``docs`` with a language that are not held out.
    """
    arrow_rows(docs.sparkSession)
    model = train(labelled_sample(docs, id_column, text, lang))
    return docs.withColumn("_lang", predicted(F.col(text), model))


def keep_known(docs: DataFrame, min_share: float = MIN_SHARE) -> DataFrame:
    """The rows of ``docs`` in a learned language, which has a share of ``min_share`` of the words.

    Texts without letters go, and those with too few trigrams that the sample has.
    """
    rated = identify(docs)
    return rated.filter(F.col("_lang.is_known") & (F.col("_lang.score") >= min_share)).drop("_lang")


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = ("_lang.lang_pred", "_lang.score")
    return identify(docs).select("doc_id", held_out("doc_id").alias("held_out"), *found)
