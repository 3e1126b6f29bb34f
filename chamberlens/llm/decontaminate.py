"""Benchmark decontamination: an FM-index per training shard, searched for test phrases.

A shard is a run of documents of one task. Words outside the benchmark cannot be part of
a phrase, so before indexing they become breaks, and runs of benchmark words shorter
than the shortest phrase go with them. Phrases are searched backwards through wavelet
ranks, located by sampled positions, and their spans merged.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from chamberlens.llm.common import without
from chamberlens.llm.fm_index import FMIndex
from chamberlens.session import stored

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
WINDOW = 10
SHARD_BYTES = 32 << 20
BLOCK_BYTES = 4 << 20
SPANS = "array<struct<first:int,last:int>>"


def words_of(text: str | bytes | None) -> list[bytes]:
    """Runs of digits, letters and every non-ASCII character; A-Z in lower case."""
    raw = text if isinstance(text, bytes) else (text or "").encode("utf-8", "replace")
    return WORD.findall(raw.lower())


def null_last(item: int | None) -> tuple[bool, int]:
    return item is None, item or 0


@dataclass
class Phrases:
    """The windows of a block of benchmark items, as numbers of its vocabulary.

    An owner is a place in ``item_ids``; the place behind the last is the item without id.
    """

    vocabulary: dict[bytes, int]
    windows: np.ndarray
    lengths: np.ndarray
    owner_of: np.ndarray
    owners: np.ndarray
    item_ids: np.ndarray

    @classmethod
    def of(cls, items: Iterable[tuple[int | None, str | bytes | None]], window: int) -> Phrases:
        """``window`` consecutive words; a shorter item, if it has a word, is one phrase."""
        vocabulary: dict[bytes, int] = {}
        read, sizes, owned = array("i"), [], []
        for item, text in items:
            before = len(read)
            read.extend(vocabulary.setdefault(w, len(vocabulary) + 1) for w in words_of(text))
            if len(read) > before:
                sizes.append(len(read) - before)
                owned.append(item)
        numbers, n_words = np.array(read, np.int32), np.array(sizes, np.int64)
        times = np.maximum(n_words - window + 1, 1)
        first = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(np.cumsum(n_words) - n_words, times)
        n_each = np.repeat(np.minimum(n_words, window), times)
        windows = np.zeros((len(first), window), np.int32)
        for back in range(min(window, int(n_each.max(initial=0)))):
            inside = np.flatnonzero(back < n_each)
            windows[inside, window - 1 - back] = numbers[first[inside] + n_each[inside] - 1 - back]
        # equal windows become one phrase, owned by every item that holds it
        windows, phrase = np.unique(windows, axis=0, return_inverse=True)
        ids = np.array(sorted(set(owned) - {None}), np.int64)
        place_of = {item: i for i, item in enumerate(ids.tolist())} | {None: len(ids)}
        places = np.repeat(np.array([place_of[item] for item in owned], np.int64), times)
        pairs = np.unique(phrase.reshape(-1).astype(np.int64) * (len(ids) + 1) + places)
        return cls(
            vocabulary,
            windows,
            np.count_nonzero(windows, axis=1),
            np.searchsorted(pairs // (len(ids) + 1), np.arange(len(windows) + 1)),
            (pairs % (len(ids) + 1)).astype(np.int32),
            ids,
        )


@dataclass
class Hits:
    """Per document of a shard: word count, merged spans of hit words, items found."""

    n_words: np.ndarray
    spans: list[list[tuple[int, int]]]
    items: list[list[int | None]]


def search_shard(texts: list[str | None], phrases: Phrases) -> Hits:
    """Index the documents and find every phrase in them."""
    numbers, sizes = [], []
    number_of = phrases.vocabulary.get
    for text in texts:
        words = words_of(text)
        sizes.append(len(words))
        numbers.append(np.fromiter(map(number_of, words, repeat(0)), np.int32, len(words)))
    sizes = np.array(sizes, np.int64)
    hits = Hits(sizes, [[] for _ in texts], [[] for _ in texts])
    all_words = np.concatenate(numbers) if numbers else np.zeros(0, np.int32)
    if not len(phrases.windows) or not len(all_words):
        return hits
    ends = np.cumsum(sizes)

    # runs of benchmark words within one document, at least as long as the shortest phrase
    inside = all_words > 0
    starts_run = inside.copy()
    starts_run[1:] &= ~inside[:-1]
    starts = ends[:-1][ends[:-1] < len(all_words)]
    starts_run[starts] = inside[starts]
    run = np.cumsum(starts_run) * inside
    long_enough = np.bincount(run) >= phrases.lengths.min()
    long_enough[0] = False
    at = np.flatnonzero(long_enough[run])
    if not len(at):
        return hits
    breaks = np.flatnonzero(run[at][1:] != run[at][:-1]) + 1
    text = np.insert(all_words[at].astype(np.int64), breaks, 0)
    place = np.insert(at, breaks, -1)

    index = FMIndex(text, len(phrases.vocabulary) + 1)
    low, high = index.search(phrases.windows, phrases.lengths)
    n_rows = high - low
    phrase = np.repeat(np.arange(len(low)), n_rows)
    if not len(phrase):
        return hits
    rows = np.arange(len(phrase)) - np.repeat(np.cumsum(n_rows) - n_rows, n_rows) + np.repeat(low, n_rows)
    first = place[index.locate(rows)]
    document = np.searchsorted(ends, first, side="right")

    # merged spans: where the running number of open phrases rises from and falls to nothing
    change = np.zeros(len(all_words) + 1, np.int64)
    np.add.at(change, first, 1)
    np.add.at(change, first + phrases.lengths[phrase], -1)
    covered = np.concatenate(([False], np.cumsum(change)[:-1] > 0, [False]))
    document_starts = ends - sizes
    for d in np.unique(document):
        lo, hi = document_starts[d], ends[d]
        here = np.concatenate(([False], covered[lo + 1 : hi + 1], [False]))
        edges = np.flatnonzero(here[1:] != here[:-1])
        hits.spans[d] = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]

    owned = np.diff(phrases.owner_of)
    pair = np.unique(np.stack([document, phrase], 1), axis=0)
    times = owned[pair[:, 1]]
    offset = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + np.repeat(phrases.owner_of[pair[:, 1]], times)
    for d, o in np.unique(np.stack([np.repeat(pair[:, 0], times), phrases.owners[offset]], 1), axis=0):
        hits.items[d].append(int(phrases.item_ids[o]) if o < len(phrases.item_ids) else None)
    return hits


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    result: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if result and first <= result[-1][1]:
            result[-1] = (result[-1][0], max(last, result[-1][1]))
        else:
            result.append((first, last))
    return result


def cut(text: str | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of ``spans`` and what stands between them."""
    if not spans:
        return text
    raw = text.encode("utf-8", "replace")
    places = [m.span() for m in WORD.finditer(raw.lower())]
    kept, at = [], 0
    for first, last in spans:
        kept.append(raw[at : places[first][0]])
        at = places[last - 1][1]
    kept.append(raw[at:])
    return b"".join(kept).decode("utf-8", "replace")


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_bytes: int) -> Iterator[list[tuple[int | None, bytes]]]:
    """Words of the benchmark items in blocks of bounded size; the driver holds one
    partition's items at a time. A longer item is cut in pieces that share ``window`` - 1
    words, so that each of its windows stands in one of them."""
    block: list[tuple[int | None, bytes]] = []
    room = block_bytes
    usable = benchmark.where(F.col(text_col).isNotNull())
    for row in usable.select(F.col(id_col).cast("bigint"), F.col(text_col)).toLocalIterator():
        words = words_of(row[1])
        at, last = 0, max(0, len(words) - window)
        while words and at <= last:
            # the words that begin a window, and those that end the last one
            to = at
            while to <= last and room > 0:
                room -= len(words[to]) + 1
                to += 1
            block.append((row[0], b" ".join(words[at : to + window - 1])))
            at = to
            if room <= 0:
                yield block
                block, room = [], block_bytes
    if block:
        yield block


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    shard_bytes: int = SHARD_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents with ``n_words``, ``spans`` (merged, in words: first to before last),
    ``n_hit`` (words in spans) and ``items`` (ids of the items found, in order).

    The phrases of a block of the benchmark are broadcast: as many windows as their first
    words fill ``block_bytes``, so half as many windows at most, as arrays of word numbers.
    A larger benchmark, or item, takes one stored pass per block, each adding to the spans
    and items so far.
    A shard closes at ``shard_bytes`` of text; one longer document is a shard by itself.

    A null text has no words; a benchmark row without text or words is no item. Rows with
    the same item id are one item with all their phrases, and so are those without an id,
    which stand last in ``items``, as null. Repeated documents are
    searched row by row. Input columns with the names of the results are replaced.
    """
    base = without(docs, "n_words", "spans", "n_hit", "items")
    found = base.withColumns({"n_words": F.lit(0).cast("bigint"), "spans": F.array().cast(SPANS), "items": F.array().cast("array<bigint>")})
    passes = 0
    for block in _blocks(benchmark, item_col, item_text_col, window, block_bytes):
        found = _searched(stored(found) if passes else found, Phrases.of(block, window), text_col, shard_bytes)
        passes += 1
    if not passes:
        found = _searched(found, Phrases.of([], window), text_col, shard_bytes)
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["last"] - s["first"])
    return found.select(*base.columns, "n_words", "spans", n_hit.alias("n_hit"), "items")


def _searched(found: DataFrame, phrases: Phrases, text_col: str, shard_bytes: int) -> DataFrame:
    shared = found.sparkSession.sparkContext.broadcast(phrases)
    names = found.columns
    text_at, spans_at, items_at = names.index(text_col), names.index("spans"), names.index("items")
    span_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def shards(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
        first, size = 0, 0
        for i, n in enumerate(sizes):
            if i > first and size + n > shard_bytes:
                yield batch.slice(first, i - first)
                first, size = i, 0
            size += n
        yield batch.slice(first)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in shards(batch) if batch.num_rows else ():
                hits = search_shard(shard.column(text_at).to_pylist(), shared.value)
                columns = dict(zip(names, shard.columns))
                columns["n_words"] = pa.array(hits.n_words, pa.int64())
                spans, items = hits.spans, hits.items
                earlier = shard.column(spans_at).to_pylist(), shard.column(items_at).to_pylist()
                spans = [merged([*s, *((x["first"], x["last"]) for x in old)]) for s, old in zip(spans, earlier[0])]
                items = [sorted({*i, *old}, key=null_last) for i, old in zip(items, earlier[1])]
                columns["spans"] = pa.array([[{"first": a, "last": b} for a, b in s] for s in spans], span_type)
                columns["items"] = pa.array(items, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([columns[n] for n in names], names=names)

    return found.mapInArrow(search, found.schema)


def remove_spans(found: DataFrame, text_col: str = "text") -> DataFrame:
    """Cut the ``spans`` that :func:`find_contamination` found out of the texts; text
    without spans, null text included, stays as it is."""
    names = found.columns
    text_at, spans_at = names.index(text_col), names.index("spans")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                cut(t, [(s["first"], s["last"]) for s in spans or []])
                for t, spans in zip(batch.column(text_at).to_pylist(), batch.column(spans_at).to_pylist())
            ]
            columns = [pa.array(texts, pa.string()) if i == text_at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return found.mapInArrow(clean, T.StructType([f if f.name != text_col else T.StructField(text_col, T.StringType()) for f in found.schema.fields]))
