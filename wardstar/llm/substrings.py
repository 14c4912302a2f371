"""Repeated passages, removed word by word, with sharded phrase automata.

Of every window of WINDOW words the run of ANCHOR words with the least hash is its
anchor, so equal windows have equal anchors. Windows whose anchor occurs once are
settled. Neighbouring windows with one anchor are a piece; equal pieces are counted
as one, and of the windows in different pieces the digests are counted, so it is
known which windows recur and in which document first, before any word moves.

The runs of such windows, each different one once, are sent to the shard of their anchor.
A shard compiles the windows that start there first into an Aho-Corasick
automaton over words and streams all its passages through it. What a match finds
in a passage holds for each of its occurrences; only matches remove words.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from wardstar.llm.common import cut, emit, partitions, table, texts, written
from wardstar.llm.files import remove_folder
from wardstar.llm.words import BASE, INVERSE, Words, mix, ngrams, powers

WINDOW, ANCHOR = 20, 5
#: Shards for each shuffle partition, so an automaton stays far below a task's memory.
SHARDS = 4
#: Pieces from which on a task compiles what it has into an automaton of its own.
SHARD_PIECES = 100_000
#: Words that an automaton reads as one character. A window is WINDOW / UNIT of them,
#: and a text is read once for each place within a unit that it may begin at.
UNIT = 5
#: Code points a unit may be written as in an automaton.
CODES = np.array([*range(0x100, 0xD800), *range(0xE000, 0x110000)], "<u4")


def window_anchors(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window inside one document: its place, its anchor's place and hash."""
    count = len(words.hashes) - WINDOW + 1
    if count <= 0:
        return (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))
    grams = ngrams(words.hashes, ANCHOR)
    # The low bits of the rank are the place, so the least rank tells where it is.
    low = np.uint64(0xFFFF)
    least = (mix(grams) & ~low) | (np.arange(len(grams), dtype=np.uint64) & low)
    span, width = WINDOW - ANCHOR + 1, 1
    while 2 * width <= span:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:count], least[span - width : span - width + count])
    at = np.arange(count)
    anchor = at + (((least & low).astype(np.int64) - at) & 0xFFFF)
    owner = words.documents()
    inside = owner[at] == owner[at + WINDOW - 1]
    at, anchor = at[inside], anchor[inside]
    return at, anchor, grams[anchor]


def _digests(hashes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """A hash of the words low up to high for each pair."""
    up, down = powers(BASE, len(hashes) + 1), powers(INVERSE, len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes) * up[:-1], out=sums[1:])
    return mix((sums[high] - sums[low]) * down[low] + (high - low).astype(np.uint64))


def _anchor_rows(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("_key", pa.int64()), ("anchors", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            words = Words(found, False)
            _, places, hashes = window_anchors(words)
            # Neighbouring windows share an anchor; each place counts once.
            places, first = np.unique(places, return_index=True)
            cuts = np.searchsorted(places, words.first)
            values = hashes[first].view(np.int64)
            lists = [values[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
            yield emit(schema, _key=batch.column("_key"), anchors=lists)

    return docs.select("_key", "text").mapInArrow(run, "_key long, anchors array<long>")


def _piece_rows(docs: DataFrame) -> DataFrame:
    """Pieces of documents (_key, _order, text, recurring anchors): windows with one anchor.

    A piece is known by its digest and has the digests of its windows, but no words.
    """
    schema = pa.schema([
        ("_key", pa.int64()), ("_order", pa.int64()), ("place", pa.int32()),
        ("digest", pa.int64()), ("windows", pa.list_(pa.int64())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            words = Words(found, False)
            at, places, hashes = window_anchors(words)
            owner = words.documents()[at] if len(at) else at
            hashes = hashes.view(np.int64)
            again = [np.sort(np.array(a, np.int64)) for a in batch.column("anchors").to_pylist()]
            cuts = np.searchsorted(at, words.first)
            recurs = np.zeros(len(at), bool)
            for d, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                if len(again[d]):
                    to = np.minimum(np.searchsorted(again[d], hashes[a:b]), len(again[d]) - 1)
                    recurs[a:b] = again[d][to] == hashes[a:b]
            chosen = np.flatnonzero(recurs)
            if not len(chosen):
                continue
            new = (np.diff(places[chosen]) != 0) | (np.diff(chosen) != 1)
            new |= np.diff(owner[chosen]) != 0
            starts = np.concatenate(([0], np.flatnonzero(new) + 1))
            stops = np.append(starts[1:], len(chosen))
            first = chosen[starts]
            doc = owner[first]
            windows = ngrams(words.hashes, WINDOW)[at[chosen]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(batch.column("_key").to_numpy()[doc]),
                    pa.array(batch.column("_order").to_numpy()[doc]),
                    pa.array((at[first] - words.first[doc]).astype(np.int32)),
                    pa.array(_digests(windows, starts, stops).view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.append(starts, len(chosen)).astype(np.int32)),
                        pa.array(windows.view(np.int64)),
                    ),
                ],
                schema=schema,
            )

    return docs.select("_key", "_order", "text", "anchors").mapInArrow(
        run, "_key long, _order long, place int, digest long, windows array<long>"
    )


def recurring_runs(pieces: DataFrame) -> DataFrame:
    """Of different pieces, the runs of windows that stand in two places or more.

    A row has the piece's digest, the first document it stands in, the number ``k`` of
    the run's first window in the piece, ``run`` (equal for equal words), and of each
    window whether no earlier document holds it. A row that is repeated whole counts
    twice, which costs time and removes nothing.
    """
    different, folder = written(
        pieces.groupBy("digest", "windows").agg(
            F.count(F.lit(1)).alias("n"), F.min("_order").alias("first_order")
        ),
        "different-pieces",
    )
    counted = different.select("n", "first_order", F.explode("windows").alias("window"))
    recurring = cut(
        counted.groupBy("window")
        .agg(F.sum("n").alias("n"), F.min("first_order").alias("starts_in"))
        .where("n > 1")
        .select("window", "starts_in"),
        "recurring-windows",
    )
    each = different.select("digest", "first_order", F.posexplode("windows").alias("k", "window"))
    held = F.struct("k", "window", (F.col("starts_in") == F.col("first_order")).alias("new"))
    found = (
        each.join(recurring, "window")
        .groupBy("digest", "first_order")
        .agg(F.sort_array(F.collect_list(held)).alias("held"))
    )
    runs = cut(_split(found), "recurring-runs")
    remove_folder(folder)
    return runs


def _split(pieces: DataFrame) -> DataFrame:
    """The runs of windows numbered one after the other in each piece's ``held``."""
    schema = pa.schema([
        ("digest", pa.int64()), ("first_order", pa.int64()), ("k", pa.int32()), ("run", pa.int64()),
        ("new", pa.list_(pa.bool_())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column("held")
            ends = held.offsets.to_numpy()
            here = slice(int(ends[0]), int(ends[-1]))
            k, window, new = (
                held.values.field(i).to_numpy(zero_copy_only=False)[here] for i in range(3)
            )
            piece = np.repeat(np.arange(batch.num_rows), np.diff(ends))
            opens = np.concatenate(([True], (np.diff(k) != 1) | (np.diff(piece) != 0)))
            starts = np.flatnonzero(opens[: len(k)])
            stops = np.append(starts[1:], len(k))
            yield emit(
                schema,
                digest=batch.column("digest").to_numpy()[piece[starts]],
                first_order=batch.column("first_order").to_numpy()[piece[starts]],
                k=k[starts],
                run=_digests(window.view(np.uint64), starts, stops).view(np.int64),
                new=pa.ListArray.from_arrays(
                    pa.array(np.append(starts, len(k)).astype(np.int32)), pa.array(new, pa.bool_())
                ),
            )

    return pieces.mapInArrow(
        run, "digest long, first_order long, k int, run long, new array<boolean>"
    )


def _passage_rows(docs: DataFrame) -> DataFrame:
    """The words of different passages, from the first documents that hold them.

    ``docs`` has _order, text, and what to send: the run, its place, and which of its
    windows stand in no earlier document.
    """
    schema = pa.schema([
        ("anchor", pa.int64()), ("run", pa.int64()), ("_order", pa.int64()),
        ("place", pa.int64()), ("words", pa.binary()), ("new", pa.list_(pa.bool_())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            words = Words(found, False)
            at, _, hashes = window_anchors(words)
            hashes = hashes.view(np.int64)
            rows: list[tuple] = []
            orders = batch.column("_order").to_pylist()
            for d, sent in enumerate(batch.column("sent").to_pylist()):
                for passage in sent:
                    low = int(words.first[d]) + passage["place"]
                    high = low + len(passage["new"]) + WINDOW - 1
                    text = words.data[words.starts[low] : words.ends[high - 1]].tobytes()
                    rows.append((
                        int(hashes[np.searchsorted(at, low)]), passage["run"], orders[d],
                        passage["place"], b" ".join(text.split()), passage["new"],
                    ))
            if rows:
                yield emit(schema, **dict(zip(schema.names, zip(*rows, strict=True), strict=True)))

    return docs.select("_order", "text", "sent").mapInArrow(
        run, "anchor long, run long, _order long, place long, words binary, new array<boolean>"
    )


class Shard:
    """The passages of some anchors, and the automaton of the windows that start in them first."""

    def __init__(
        self, passages: list[bytes], new: list[list[bool]], order: np.ndarray, place: np.ndarray
    ):
        self.words = Words(passages, False)
        units = ngrams(self.words.hashes, UNIT)
        places = [np.arange(phase, len(units), UNIT) for phase in range(UNIT)]
        self.read = np.concatenate(places)  # the place of each unit as it is read
        codes = np.unique(units[self.read], return_inverse=True)[1]
        # A unit is two characters of a small alphabet: the states of an automaton list
        # their arcs, and a list as long as the number of units would be searched for each.
        base = max(2, int(np.ceil(np.sqrt(codes.max(initial=0) + 1))))
        spelled = CODES[np.stack((codes // base, codes % base), axis=1)]
        self.text = spelled.astype("<u4").tobytes().decode("utf-32-le")
        owner = self.words.documents()
        at = np.arange(max(0, len(owner) - WINDOW + 1))
        self.at = at[owner[at] == owner[at + WINDOW - 1]]
        self.owner = owner[self.at]
        self.offset = self.at - self.words.first[self.owner]
        self.order, self.place = order[self.owner], place[self.owner] + self.offset
        self.automaton = self._compiled(np.array([n for row in new for n in row], bool))

    def _compiled(self, new: np.ndarray):
        """The windows at which ``new`` holds, each with the number of the window it is.

        Of equal windows in one document the earliest is kept: it is added last.
        """
        import ahocorasick

        written = np.argsort(self.read)
        chosen = np.flatnonzero(new)
        chosen = chosen[np.lexsort((-self.place[chosen], ~self.order[chosen]))]
        step = WINDOW // UNIT * 2
        starts = (written[self.at[chosen]] * 2).tolist()
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for window, s in zip(chosen.tolist(), starts, strict=True):
            automaton.add_word(self.text[s : s + step], window)
        if starts:
            automaton.make_automaton()
        return automaton

    def matches(self) -> tuple[np.ndarray, np.ndarray]:
        """Windows where the automaton matches, in order, and the window that each equals."""
        if not len(self.automaton):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        hits = itertools.chain.from_iterable(self.automaton.iter(self.text))
        hits = np.fromiter(hits, np.int64).reshape(-1, 2)
        units = WINDOW // UNIT
        start = hits[:, 0] + 1 - units * 2
        aligned = start % 2 == 0
        start, equal = start[aligned] // 2, hits[aligned, 1]
        # A match may also lie across two readings or two passages; that is no window.
        at = self.read[start]
        window = np.minimum(np.searchsorted(self.at, at), len(self.at) - 1)
        inside = (self.at[window] == at) & (self.read[start + units - 1] == at + WINDOW - UNIT)
        window, equal = window[inside], equal[inside]
        ranked = np.argsort(window, kind="stable")
        return window[ranked], equal[ranked]


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by anchor in tables that hold all rows of theirs."""
    held: list[pa.RecordBatch] = []
    size, enough = 0, SHARD_PIECES
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.num_rows
        if size < enough:
            continue
        rows = pa.Table.from_batches(held)
        anchor = rows.column("anchor").to_numpy()
        # More rows of the last anchor may follow.
        stop = int((anchor == anchor[-1]).argmax())
        if stop:
            yield rows.slice(0, stop)
            held = rows.slice(stop).to_batches()
            size -= stop
        enough = max(SHARD_PIECES, 2 * size)
    if held:
        yield pa.Table.from_batches(held)


MATCHES = "array<struct<k:int, first_order:long, first_place:long>>"
#: Later than any document.
NEVER_LATER = 2**63 - 1


def _matched(passages: DataFrame) -> DataFrame:
    """By run, the windows that the automata found, with the first place of each.

    Where every window of a run matched, ``latest`` is the last document in which one of
    them stands first: the run is a repeat as a whole in any later document.

    ``passages`` has all rows of an anchor in one partition, next to each other.
    """
    match = pa.struct([("k", pa.int32()), ("first_order", pa.int64()), ("first_place", pa.int64())])
    schema = pa.schema([
        ("run", pa.int64()), ("n", pa.int32()), ("latest", pa.int64()), ("found", pa.list_(match))
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _groups(batches):
            runs, order, place = (rows.column(c).to_numpy() for c in ("run", "_order", "place"))
            words, new = rows.column("words").to_pylist(), rows.column("new").to_pylist()
            shard = Shard(words, new, order, place)
            window, equal = shard.matches()
            owner = shard.owner[window]
            cuts = np.searchsorted(owner, np.arange(len(runs) + 1)).astype(np.int32)
            found = pa.StructArray.from_arrays(
                [
                    pa.array(shard.offset[window].astype(np.int32)),
                    pa.array(shard.order[equal]),
                    pa.array(shard.place[equal]),
                ],
                fields=list(match),
            )
            lists = pa.ListArray.from_arrays(pa.array(cuts), found)
            sizes = np.array([len(n) for n in new], np.int32)
            latest = np.full(len(runs), NEVER_LATER)
            whole = np.flatnonzero((np.diff(cuts) == sizes) & (sizes > 0))
            if len(whole):
                every = np.maximum.reduceat(shard.order[equal], np.minimum(cuts[:-1], len(equal) - 1))
                latest[whole] = every[whole]
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs), pa.array(sizes), pa.array(latest), lists], schema=schema
            )

    return passages.mapInArrow(run, f"run long, n int, latest long, found {MATCHES}")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` without the words of windows that also start earlier.

    A window is WINDOW words in a row, unchanged; earlier is a smaller doc_id, or an
    earlier start in the document (null doc_id before all others; rows of one doc_id
    are one place in the order, so a row repeated whole repeats nothing). Windows
    are judged on the input. Returns all columns, the text of a document that lost
    words as the kept ones joined by spaces, other texts as they are, and n_words
    and n_removed (which replace columns of that name).
    Null and short texts lose nothing; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_words", "n_removed")
    names = docs.columns
    # Columns of the caller travel as one, so no name of theirs meets one of these.
    rows = docs.select(
        F.struct(*names).alias("_row"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text").alias("_key"),
        F.coalesce("doc_id", F.lit(-(2**63))).cast("long").alias("_order"),
    )
    spread, folder = written(_anchor_rows(rows), "anchors")
    each = spread.select("_key", F.explode("anchors").alias("anchor"))
    # Counted before they move, so an anchor of many documents is a row for each task.
    again = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    lists = each.join(again, "anchor").groupBy("_key").agg(F.collect_list("anchor").alias("anchors"))
    lists = cut(lists, "recurring-anchors")
    remove_folder(folder)
    pieces = cut(_piece_rows(rows.select("_key", "_order", "text").join(lists, "_key")), "pieces")
    runs = recurring_runs(pieces)
    # Of equal runs one is sent: the first of the first document that holds it.
    least = runs.groupBy("run").agg(F.min("first_order").alias("first_order"))
    sending = runs.join(least, ["run", "first_order"]).withColumnRenamed("first_order", "_order")
    occurrences = pieces.select("_key", "_order", "place", "digest")
    one = F.min_by(F.struct("_key", "place", "new"), "place").alias("one")
    sent = (
        occurrences.join(sending, ["digest", "_order"])
        .withColumn("place", F.col("place") + F.col("k"))
        .groupBy("run")
        .agg(one)
        .groupBy("one._key")
        .agg(F.collect_list(F.struct("one.place", "run", "one.new")).alias("sent"))
    )
    different = rows.select("_key", "_order", "text").join(cut(sent, "sent"), "_key")
    passages = _passage_rows(different)
    dealt = passages.repartition(SHARDS * partitions(spark), "anchor").sortWithinPartitions("anchor")
    found = cut(_matched(dealt), "matches")
    placed = occurrences.join(
        runs.select("digest", "k", "run").join(found.select("run", "n", "latest"), "run"), "digest"
    ).select("_key", "_order", (F.col("place") + F.col("k")).alias("start"), "n", "run", "latest")
    repeated = placed.where("_order > latest").select("_key", F.struct("start", "n").alias("span"))
    # Where a window of the run may stand first, each of its windows is compared.
    single = F.expr(
        "explode(transform(filter(found, m -> m.first_order < _order or "
        "(m.first_order = _order and m.first_place < start + m.k)), "
        "m -> struct(start + m.k as start, 1 as n)))"
    )
    compared = placed.where("_order <= latest").join(found.select("run", "found"), "run")
    spans = repeated.union(compared.select("_key", single.alias("span")))
    # A span that comes twice covers the same words; lists merge faster than sets.
    lost = spans.groupBy("_key").agg(F.collect_list("span").alias("_lost"))
    joined = rows.select("_row", "text", "_key").join(cut(lost, "lost"), "_key", "left")
    kept = _without(joined.select("_row", "text", "_lost"))
    plain = [F.col("_row")[n].alias(n) if n != "text" else F.col("text") for n in names]
    return kept.select(*plain, "n_words", "n_removed")


def _without(rows: DataFrame) -> DataFrame:
    """The rows (_row, text, _lost) without the words of the windows that ``_lost`` names.

    ``_lost`` has the start of the first and the number of windows in a row.
    """
    result = StructType([f for f in rows.schema.fields if f.name != "_lost"])
    result = result.add("n_words", LongType()).add("n_removed", LongType())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            words = Words(found, False)
            kept_texts, removed = batch.column("text").to_pylist(), []
            for d, lost in enumerate(batch.column("_lost")):
                if not lost.is_valid:
                    removed.append(0)
                    continue
                first, last = int(words.first[d]), int(words.first[d + 1])
                start, n = (lost.values.field(i).to_numpy() for i in range(2))
                # One up where a span starts and one down behind its end.
                cover = np.zeros(last - first + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + n + WINDOW - 1, -1)
                gone = np.cumsum(cover[:-1]) > 0
                removed.append(int(gone.sum()))
                if removed[-1]:
                    spans = zip(words.starts[first:last][~gone], words.ends[first:last][~gone], strict=True)
                    kept = b" ".join([words.data[s:e].tobytes() for s, e in spans])
                    kept_texts[d] = kept.decode()
            arrays = [batch.column("_row"), pa.array(kept_texts, pa.string())]
            arrays += [pa.array(words.counts(), pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["_row", "text", "n_words", "n_removed"])

    return rows.mapInArrow(run, result)


def spaced(text: Column) -> Column:
    """The words of a text joined by one space; a null text is empty."""
    out = F.coalesce(text, F.lit(""))
    for space in "\t\n\x0b\x0c\r":
        out = F.replace(out, F.lit(space), F.lit(" "))
    # Single spaces, the usual case, need no pattern.
    doubled = F.contains(out, F.lit("  "))
    return F.trim(F.when(doubled, F.regexp_replace(out, " +", " ")).otherwise(out))


def query(spark, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    # A text that lost words is joined already.
    words = F.when(F.col("n_removed") > 0, F.col("text")).otherwise(spaced(F.col("text")))
    return kept.select(
        "doc_id",
        "n_words",
        "n_removed",
        F.sha2(words.cast("binary"), 256).alias("kept_sha256"),
    )
