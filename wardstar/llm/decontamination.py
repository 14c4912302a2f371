"""Benchmark passages in documents, by the CGK embedding and exact edit distance.

A random walk over a window's words repeats a word or moves on by a hashed bit of
the word and the step. Windows within a small edit distance fall into step, so
their walks agree in most places; bit sampling takes some places of a walk as a
key. Several walks and samples, begun at every few words of a long item, make it all
but certain that a window near it meets one of its keys; a short item, which has too
few places to begin a walk, is met for certain by the runs of words that no allowed
edits can break all. Every meeting is then confirmed by the edit distance of the item to the best part of the window.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import emit, table, texts
from wardstar.llm.words import MARKED, Words, mix, ngrams

#: Steps of a walk, places sampled from it, and walks with samples of their own.
#: A walk of 14 steps spans about 7 words, of which half the steps count; an item is
#: met if any walk begun at one of its words stays clear of edits in those places.
#: The fewer words, the fewer such beginnings, so shorter items do not rely on walks.
STEPS, SAMPLED, WALKS = 14, 7, 6
#: Items of fewer words are met by a run of words that the edits must leave whole:
#: k edits leave at most k + 1 runs, so the longest is met whichever words they hit.
SHORT = 30
#: Edits allowed as a share of an item's words.
EDITS = 0.2
#: Words of items that one pass over the documents looks for.
BLOCK_WORDS = 200_000
_RANDOM = np.random.default_rng(8128)
_WALK = mix(_RANDOM.integers(1, 2**62, WALKS, dtype=np.uint64))
_PLACES = [np.sort(_RANDOM.choice(STEPS, SAMPLED, replace=False)) for _ in range(WALKS)]


class Item(NamedTuple):
    item_id: int
    words: np.ndarray


class Keys(NamedTuple):
    """Sorted keys with the item and the word each came from, and a bitmap of them."""

    keys: np.ndarray
    item: np.ndarray
    word: np.ndarray
    bitmap: np.ndarray
    runs: list[int]


_BITMAP = (1 << 20) - 1


def walk_keys(words: np.ndarray, walk: int) -> np.ndarray:
    """A key for each place where a window may begin; the end is padded with zeros."""
    padded = np.concatenate((words, np.zeros(STEPS, np.uint64)))
    turns = mix(padded ^ _WALK[walk])
    at = np.arange(len(words))
    total = np.full(len(words), _WALK[walk], np.uint64)
    for step in range(STEPS):
        if step in _PLACES[walk]:
            total = (total ^ padded[at]) * np.uint64(0x9E3779B97F4A7C15)
            total ^= total >> np.uint64(29)
        at += ((turns[at] >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
    return total


def clean_run(n: int, edits: float) -> int:
    """Words in a row that an item of n words keeps whatever edits it is allowed."""
    allowed = int(edits * n)
    return max(1, -(-(n - allowed) // (allowed + 1)))


def item_keys(items: list[Item], edits: float) -> Keys:
    parts = []
    runs = set()
    for number, item in enumerate(items):
        n = len(item.words)
        if n < SHORT:
            run = clean_run(n, edits)
            runs.add(run)
            keys = [ngrams(item.words, run)]
        else:
            # Begun later, a walk may leave the item, where a document goes on otherwise.
            last = max(1, n - STEPS // 2)
            keys = [walk_keys(item.words, walk)[:last] for walk in range(WALKS)]
        for own in keys:
            parts.append((own, np.full(len(own), number), np.arange(len(own))))
    keys, item, word = (np.concatenate(p) for p in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    bitmap = np.zeros(_BITMAP + 1, bool)
    bitmap[(keys & np.uint64(_BITMAP)).astype(np.int64)] = True
    return Keys(keys[order], item[order], word[order], bitmap, sorted(runs))


def candidates(words: np.ndarray, keys: Keys) -> np.ndarray:
    """Distinct (item, place where the item would begin) that any key points to."""
    found = [np.empty((0, 2), np.int64)]
    owns = [lambda w=walk: walk_keys(words, w) for walk in range(WALKS)]
    owns += [lambda n=run: ngrams(words, n) for run in keys.runs]
    for make in owns:
        own = make()
        at = np.flatnonzero(keys.bitmap[(own & np.uint64(_BITMAP)).astype(np.int64)])
        first = np.searchsorted(keys.keys, own[at], "left")
        n = np.searchsorted(keys.keys, own[at], "right") - first
        if n.any():
            at = np.repeat(at, n)
            entry = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append(np.stack((keys.item[entry], at - keys.word[entry]), axis=1))
    return np.unique(np.concatenate(found), axis=0)


def best_part(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int]:
    """The least edit distance of the item to a part of the window, and that part.

    Distance, start and stop; of equal distances the part that ends first.
    """
    n = len(window)
    cost = np.zeros(n + 1, np.int64)
    start = np.arange(n + 1)
    places = np.arange(n + 1)
    for row, word in enumerate(item, 1):
        swap = cost[:-1] + (window != word)
        drop = cost[1:] + 1
        new = np.concatenate(([row], np.minimum(swap, drop)))
        begun = np.concatenate(([0], np.where(swap <= drop, start[:-1], start[1:])))
        # Window words left out: a running minimum of the cost less the place.
        lead = new - places
        least = np.minimum.accumulate(lead)
        source = np.maximum.accumulate(np.where(lead == least, places, 0))
        # Where a later place repeats the minimum, it is the nearest one.
        cost, start = least + places, begun[source]
    stop = int(cost.argmin())
    return int(cost[stop]), int(start[stop]), stop


def item_blocks(benchmark: DataFrame) -> Iterator[list[Item]]:
    """The items in blocks of bounded words; those without words are left out."""
    block: list[Item] = []
    size = 0
    rows = benchmark.select("item_id", "text").where("item_id is not null")
    for row in rows.orderBy("item_id", "text").toLocalIterator():
        words = Words([(row["text"] or "").encode()], True, MARKED).hashes
        if len(words):
            block.append(Item(row["item_id"], words))
            size += len(words)
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


MATCHES = "doc_id long, item_id long, start long, stop long, distance long, item_words long"


def matches(docs: DataFrame, benchmark: DataFrame, edits: float = EDITS) -> DataFrame:
    """Where whole ``docs`` (doc_id, text) hold items of ``benchmark`` (item_id, text).

    Returns doc_id, item_id, the words start up to stop of the best part, its edit
    distance in words, and the item's words, for parts within floor(edits * words).
    Words are compared in lower case without punctuation. A document and an item
    meet once, at the least distance that comes first. Items without words match
    nothing; a null text is empty; a row without doc_id is searched like others.
    The benchmark is a query set, looked for in blocks of bounded size.
    """
    spark = docs.sparkSession
    found = spark.range(0).selectExpr(*[f"cast(null as long) as {c.split()[0]}" for c in MATCHES.split(", ")])
    for items in item_blocks(benchmark):
        found = found.unionByName(_matches_of(docs, items, edits))
    return found


def _matches_of(docs: DataFrame, items: list[Item], edits: float) -> DataFrame:
    keys = item_keys(items, edits)
    shared = docs.sparkSession.sparkContext.broadcast((items, keys))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("item_id", pa.int64()), ("start", pa.int64()),
        ("stop", pa.int64()), ("distance", pa.int64()), ("item_words", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, keys = shared.value
        for batch, found in texts(batches):
            words = Words(found, True, MARKED)
            pairs = candidates(words.hashes, keys)
            ids = batch.column("doc_id").to_pylist()
            best: dict[tuple[int, int], tuple] = {}
            done: set[tuple[int, int, int]] = set()
            for number, begin in pairs.tolist():
                item = items[number]
                n = len(item.words)
                slack = int(edits * n) + 1
                middle = min(max(begin + n // 2, 0), len(words.hashes) - 1)
                for d in _documents(words, begin, begin + n, middle):
                    first, last = int(words.first[d]), int(words.first[d + 1])
                    # Places a few words apart are one window.
                    cell = (d, number, begin // slack)
                    if cell in done:
                        continue
                    done.add(cell)
                    low = max(first, (begin // slack - 1) * slack)
                    high = min(last, (begin // slack + 2) * slack + n)
                    # Each edit spares all but one word of the item.
                    if np.isin(item.words, words.hashes[low:high]).sum() < n - int(edits * n):
                        continue
                    distance, start, stop = best_part(item.words, words.hashes[low:high])
                    if distance <= int(edits * n):
                        row = (distance, low + start - first, low + stop - first)
                        best[d, number] = min(best.get((d, number), row), row)
            if best:
                rows = [
                    (ids[d], items[i].item_id, row[1], row[2], row[0], len(items[i].words))
                    for (d, i), row in sorted(best.items())
                ]
                yield emit(schema, **dict(zip(schema.names, zip(*rows, strict=True), strict=True)))

    return docs.select("doc_id", "text").mapInArrow(run, MATCHES)


def _documents(words: Words, begin: int, end: int, middle: int) -> set[int]:
    """The documents of a slice that a window may lie in."""
    places = [min(max(p, 0), len(words.hashes) - 1) for p in (begin, middle, end - 1)]
    return {int(np.searchsorted(words.first, p, "right")) - 1 for p in places}


def query(spark, sf_dir: str) -> DataFrame:
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
