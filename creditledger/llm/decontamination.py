"""Benchmark decontamination: find benchmark passages in documents by the q-gram lemma.

Texts are compared as lower-cased letters and digits with one space for any run of other
characters.  Each benchmark item is covered by windows of two kinds (``KINDS``): long ones, which
may be met with many edits, and short ones that begin every few characters, so that a fragment of
``LEAST`` characters holds a whole short window wherever in the item it begins.  An item shorter
than a long window is one window.  By the q-gram lemma, a region of a document within k edits of the window shares at
least ``m + 1 - q (k + 1)`` q-grams with it, on diagonals that differ by at most k.  Diagonals
are covered by bands of twice k that overlap by half, so that such a region has all of these
in one band.  The index has every place of an item once; shared q-grams are counted for the
windows that cover their place, by window and band; bands that reach the bound are verified by
aligning the window inside the band, which gives the least number of edits.  Regions that
overlap are one.

The benchmark is cut into blocks of at most ``BLOCK_CHARS`` characters by the hash of the
items, each small enough to send to every task; documents are searched against one block after
the other.  One block is the usual case.  Documents are never shuffled, exploded or joined.
Tasks look up the q-grams of a piece of up to ``PIECE_CHARS`` characters at once; long texts
are searched in pieces that overlap by more than any window's region.

Defined results: null and empty texts and items meet nothing, nor do items shorter than one
q-gram, whose bound would be below one shared q-gram.  Repeated rows are reported each.  Equal
items are reported each with its id.  An empty benchmark or table gives an empty result.  Other
columns are left alone; working columns are named ``_leak...``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_rows, read

Q = 10
#: Characters of a window, from how many to how many one begins, and edits allowed per character.
KINDS = ((100, 50, 0.08), (50, 8, 0.04))
WINDOW = max(window for window, _, _ in KINDS)
#: Every fragment of an item of so many compared characters is found, with two edits at most.
LEAST = 50 + 8 - 1
BLOCK_CHARS = 4 << 20
PIECE_CHARS = 1 << 20
FILTER_BITS = 22
BASE = 0x9E3779B97F4A7C15
#: Shared q-grams that are listed at once, and bands that are aligned at once.
HITS, BANDS = 1 << 20, 4096
SPACE, GAP = 32, 0


@dataclass
class Index:
    """Windows of benchmark items, and where each q-gram occurs in the items."""

    items: list
    codes: np.ndarray
    #: Of each item that has a q-gram: its number, and where it begins in ``codes``.
    number: np.ndarray
    begin: np.ndarray
    #: Of each kind and item: the first of its windows, the last one's start, and their length.
    base: np.ndarray
    last: np.ndarray
    size: np.ndarray
    #: Of each window.
    start: np.ndarray
    length: np.ndarray
    owner: np.ndarray
    edits: np.ndarray
    #: The different q-grams, the first of the places of each, and all places.
    grams: np.ndarray
    first: np.ndarray
    place: np.ndarray
    filter: np.ndarray


def normal(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the text as compared, and for each the place in the text it stands for."""
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    if not len(codes):
        return codes.astype(np.uint32), np.zeros(0, np.int64)
    seen = np.flatnonzero(np.bincount(codes))
    table = np.full(int(seen[-1]) + 1, SPACE, np.uint32)
    for code in seen:
        low = chr(code).lower()
        if chr(code).isalnum():
            table[code] = ord(low[0])
    mapped = table[codes]
    keep = mapped != SPACE
    keep[1:] |= mapped[:-1] != SPACE
    places = np.flatnonzero(keep)
    mapped = mapped[places]
    if len(mapped) and mapped[-1] == SPACE:
        mapped, places = mapped[:-1], places[:-1]
    if len(mapped) and mapped[0] == SPACE:
        mapped, places = mapped[1:], places[1:]
    return mapped, places


def gram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """A 64-bit hash of each q-gram, by doubling the length of the grams."""
    if len(codes) < q:
        return np.zeros(0, np.uint64)
    own = codes.astype(np.uint64) + np.uint64(1)
    size, power, hashed, done = 1, BASE, None, 0
    while q:
        if q & 1:
            if hashed is None:
                hashed, done = own, size
            else:
                n = min(len(hashed), len(own) - done)
                hashed = hashed[:n] * np.uint64(power) + own[done : done + n]
                done += size
        q >>= 1
        if q:
            own = own[:-size] * np.uint64(power) + own[size:]
            power = power * power % (1 << 64)
            size *= 2
    mixed = hashed ^ (hashed >> np.uint64(31))
    return mixed * np.uint64(BASE)


def build(items: list[tuple[object, str]]) -> Index:
    texts = [normal(text or "")[0] for _, text in items]
    number = np.array([i for i, codes in enumerate(texts) if len(codes) >= Q], np.int64)
    parts = [texts[i] for i in number]
    codes = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    sizes = np.array([len(c) for c in parts], np.int64)
    begin = np.cumsum(sizes) - sizes
    base, last, size, windows = [], [], [], [np.zeros((4, 0), np.int64)]
    made = 0
    for kind, (window, stride, rate) in enumerate(KINDS):
        length = np.minimum(window, sizes)
        edits = np.minimum((rate * length).astype(np.int64), (length - Q) // Q)
        # A shorter item is one window of the first kind, which stands for all.
        n = np.where((kind == 0) | (sizes > window), -((length - sizes) // stride) + 1, 0)
        base.append(made + np.cumsum(n) - n)
        last.append(sizes - length)
        size.append(np.where(n > 0, length, 0))
        of = np.repeat(np.arange(len(sizes)), n)
        at = np.minimum((np.arange(len(of)) + made - base[-1][of]) * stride, last[-1][of])
        windows.append(np.stack([begin[of] + at, length[of], number[of], edits[of]]))
        made += len(of)
    start, length, owner, edits = np.concatenate(windows, axis=1)
    hashed = gram_hashes(codes)
    # Grams that reach from one item into the next are none.
    whole = np.ones(len(hashed), bool)
    for k in range(1, Q):
        ends = (begin + sizes - k)[begin + sizes - k < len(hashed)]
        whole[ends] = False
    place = np.flatnonzero(whole)
    order = np.argsort(hashed[place], kind="stable")
    place = place[order]
    grams, first = np.unique(hashed[place], return_index=True)
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[(grams >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return Index(
        [i for i, _ in items],
        codes,
        number,
        begin,
        np.array(base),
        np.array(last),
        np.array(size),
        start,
        length,
        owner,
        edits,
        grams,
        np.concatenate([first, [len(place)]]),
        place,
        bits,
    )


def aligned(index: Index, text: np.ndarray, windows: np.ndarray, low: np.ndarray, width: int):
    """Least edits between windows and a part of ``text`` inside a band each.

    The windows are equally long.  A band holds diagonals ``low`` to ``low + width - 1``: place i
    of the window faces place i plus the diagonal of the text.  Gives the edits and the end place
    in the text.
    """
    m = int(index.length[windows[0]])
    start = index.start[windows]
    diagonal = low[:, None] + np.arange(width)[None, :]
    step = np.arange(width)
    cost = np.zeros((len(low), width), np.int32)
    padded = np.concatenate([text, [GAP]])
    for i in range(m):
        at = diagonal + i
        at = np.where((at >= 0) & (at < len(text)), at, len(text))
        met = cost + (padded[at] != index.codes[start + i][:, None])
        skipped = np.full_like(cost, m + 1)
        skipped[:, :-1] = cost[:, 1:] + 1
        best = np.minimum(met, skipped) - step
        cost = np.minimum.accumulate(best, axis=1) + step
    end = cost.argmin(axis=1)
    rows = np.arange(len(low))
    return cost[rows, end], low + end + m


def covering(index: Index, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The windows that hold the q-grams at places of items: (which of ``place``, window)."""
    item = np.searchsorted(index.begin, place, side="right") - 1
    own = place - index.begin[item]
    for kind, (_, stride, _) in enumerate(KINDS):
        last, size = index.last[kind][item], index.size[kind][item]
        most = -(-last // stride)
        low = np.minimum(-(-np.maximum(0, own - (size - Q)) // stride), most)
        high = np.where(own >= last, most, own // stride)
        n = np.where(size > 0, high - low + 1, 0)
        which = np.repeat(np.arange(len(place)), n)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        yield which, index.base[kind][item[which]] + low[which] + nth


def search(index: Index, text: np.ndarray):
    """Matches in one text: (item number, start, end, edits), places of compared characters."""
    hashed = gram_hashes(text)
    if not len(hashed) or not len(index.grams):
        return []
    maybe = np.flatnonzero(index.filter[(hashed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    own = hashed[maybe]
    at = np.minimum(np.searchsorted(index.grams, own), len(index.grams) - 1)
    real = index.grams[at] == own
    maybe, at = maybe[real], at[real]
    if not len(maybe):
        return []
    # Keys of (window, band); places of the text are raised so that diagonals are positive.
    raise_by = WINDOW + 1
    half = np.maximum(index.edits, 1) + 1
    n_bands = (len(text) + raise_by) + 2
    n = index.first[at + 1] - index.first[at]
    found_keys, found_counts = [], []
    group = np.cumsum(n) // HITS
    starts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    for a, b in zip(starts, [*starts[1:], len(n)], strict=True):
        size = n[a:b]
        begin = np.repeat(index.first[at[a:b]] - (np.cumsum(size) - size), size)
        place = index.place[begin + np.arange(int(size.sum()))]
        here = np.repeat(maybe[a:b], size)
        for which, window in covering(index, place):
            diagonal = here[which] - (place[which] - index.start[window]) + raise_by
            band = diagonal // half[window]
            keys = np.concatenate([window * n_bands + band, window * n_bands + band - 1])
            keys, own_counts = np.unique(keys, return_counts=True)
            found_keys.append(keys)
            found_counts.append(own_counts)
    keys, inverse = np.unique(np.concatenate(found_keys), return_inverse=True)
    total = np.bincount(inverse, np.concatenate(found_counts))
    window, band = keys // n_bands, keys % n_bands
    bound = index.length[window] + 1 - Q * (index.edits[window] + 1)
    enough = total >= bound
    window, band = window[enough], band[enough]
    low = band * half[window] - raise_by - index.edits[window]
    matches = []
    for m in np.unique(index.length[window]):
        same = np.flatnonzero(index.length[window] == m)
        for k in np.unique(index.edits[window[same]]):
            alike = same[index.edits[window[same]] == k]
            width = 2 * (max(int(k), 1) + 1) + 2 * int(k)
            for a in range(0, len(alike), BANDS):
                part = alike[a : a + BANDS]
                edits, end = aligned(index, text, window[part], low[part], width)
                good = edits <= k
                owners = index.owner[window[part][good]].tolist()
                for o, e, stop in zip(owners, edits[good].tolist(), end[good].tolist(), strict=True):
                    matches.append((o, max(0, stop - int(m)), min(stop, len(text)), e))
    return matches


def merged(regions: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Regions (edits, begin, end) with those that overlap as one, with the least edits of them."""
    found: list[list[int]] = []
    for edits, begin, end in sorted(regions, key=lambda r: r[1:]):
        if found and begin <= found[-1][2]:
            found[-1][0] = min(found[-1][0], edits)
            found[-1][2] = max(found[-1][2], end)
        else:
            found.append([edits, begin, end])
    return sorted(tuple(r) for r in found)


def matches_of(index: Index, text: str | None) -> list[tuple[object, int, int, int, int]]:
    """Per item met in a text: (item, regions, start, end, edits) of the region of least edits.

    ``start`` and ``end`` are places in the text itself.
    """
    overlap = 4 * WINDOW
    best: dict[int, list] = {}
    codes, places = normal(text or "")
    for at in range(0, max(1, len(codes) - overlap), PIECE_CHARS):
        for item, a, b, edits in search(index, codes[at : at + PIECE_CHARS + overlap]):
            begin, end = int(places[a + at]), int(places[b + at - 1]) + 1
            best.setdefault(item, []).append((edits, begin, end))
    found = []
    for item, regions in sorted(best.items()):
        regions = merged(regions)
        edits, begin, end = regions[0]
        found.append((index.items[item], len(regions), begin, end, edits))
    return found


def blocks(benchmark: DataFrame, id_column: str, text: str) -> Iterator[list[tuple[object, str]]]:
    """The benchmark in blocks of bounded size, each brought to the driver by itself."""
    size = benchmark.agg(F.sum(F.length(text))).first()[0] or 0
    n = -(-size // BLOCK_CHARS) if size else 0
    part = F.pmod(F.xxhash64(id_column, text), F.lit(2 * n if n > 1 else 1))
    for k in range(2 * n if n > 1 else n):
        rows = benchmark.filter(part == k).select(id_column, text)
        yield sorted(((r[0], r[1]) for r in rows.collect()), key=str)


MATCH = "item_id bigint, n_regions bigint, start bigint, end bigint, edits bigint"


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and benchmark item met in it, with the region of least edits."""
    arrow_rows(docs.sparkSession)
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(name, pa.int64()) for name in ("item_id", "n_regions", "start", "end", "edits")]
    )
    own = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    result = None
    for items in blocks(benchmark, item_id, item_text):
        shared = docs.sparkSession.sparkContext.broadcast(build(items).__dict__)

        def searched(batches: Iterator[pa.RecordBatch], shared=shared):
            index = Index(**shared.value)
            for batch in batches:
                rows = [
                    (doc, *match)
                    for doc, text in zip(
                        batch.column("doc_id").to_pylist(),
                        batch.column("text").to_pylist(),
                        strict=True,
                    )
                    for match in matches_of(index, text)
                ]
                columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
                arrays = [pa.array(c, pa.int64()) for c in columns]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        found = own.mapInArrow(searched, f"doc_id bigint, {MATCH}")
        result = found if result is None else result.unionByName(found)
    if result is None:
        return docs.sparkSession.createDataFrame([], f"doc_id bigint, {MATCH}")
    return result


def contaminated(text: Column, items: list[tuple[object, str]], spark: SparkSession) -> Column:
    """Whether a text holds a passage of one of ``items``."""
    shared = spark.sparkContext.broadcast(build(items).__dict__)

    @F.pandas_udf("boolean")
    def met(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = Index(**shared.value)
        for batch in batches:
            yield pd.Series([bool(matches_of(index, t)) for t in batch], dtype=bool)

    return met(text)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is met."""
    arrow_rows(docs.sparkSession)
    for items in blocks(benchmark, "item_id", "text"):
        docs = docs.filter(~contaminated(F.col(text), items, docs.sparkSession))
    return docs


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return leaks(docs, read(spark, sf_dir, "benchmark"))
