"""Phrases of two to four words, counted while shorter ones are still being counted.

Dynamic itemset counting: the documents are dealt to shards that are scanned in a
cycle. Words are counted from the first scan on. A longer phrase becomes active with
the scan after both phrases it consists of, without its last and without its first
word, have been seen ``least`` times; it is counted until every shard has been
scanned once since. So all counts are exact, lengths interleave, and phrases
with a rare part are never counted.

Words are compared by 64-bit hashes of language and word. What was seen often enough,
and since which scan, is sent to the tasks as a table of 2^``bits`` bytes for each
length, whatever the size of the corpus: a phrase is held at two places, and one that
finds both taken by others is counted too early or needlessly, but never wrongly,
since the places of a phrase do not change once they are taken.

Null texts are empty, a null lang is ``und``; documents without words add nothing;
equal documents and doc_ids count each time. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardstar.llm.common import cut, emit, table, texts, work_folder
from wardstar.llm.files import remove_folder
from wardstar.llm.words import SPACE, Words, mix

#: A phrase is a candidate from this many occurrences on.
LEAST = 30
LONGEST = 4
#: Parts of the corpus, scanned in turn. More parts let phrases start earlier, but
#: move the counts so far once more for each.
SHARDS = 2
#: The bytes of each table of frequent phrases are 2^BITS.
BITS = 23
#: Bytes of text counted in one step.
STEP = 4 << 20
#: Phrases reported for each language.
TOP = 2000
#: Each language is ranked in so many parts first.
SALTS = 32
#: A candidate inside a longer phrase goes if that has so many percent of its count.
INSIDE = 80
NEVER = 255
KEYS = [f"w{k + 1}" for k in range(LONGEST)]
FACTOR = np.uint64(0x9E3779B97F4A7C15)

#: Bytes that end a piece, and all that end a word.
PIECE_END = np.zeros(256, bool)
PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD_END = SPACE | PIECE_END

COUNTS = pa.schema(
    [(k, pa.int64()) for k in KEYS]
    + [("since", pa.int16()), ("lang", pa.string()), ("word", pa.string()), ("c", pa.int64())]
)
COUNTS_DDL = ", ".join(f"{k} long" for k in KEYS) + ", since short, lang string, word string, c long"


def joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The hash of a phrase and one more word."""
    return mix(left * FACTOR + right)


class Frequent:
    """For each length the scan with which a phrase had been seen often enough."""

    def __init__(self, bits: int):
        self.mask = np.uint64((1 << bits) - 1)
        self.tables = [np.full(1 << bits, NEVER, np.uint8) for _ in range(LONGEST - 1)]

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return (hashes & self.mask).astype(np.int64), ((hashes >> np.uint64(32)) & self.mask).astype(np.int64)

    def scan(self, length: int, hashes: np.ndarray) -> np.ndarray:
        """The scan for each phrase of that many words, or NEVER."""
        one, two = self.places(hashes)
        held = self.tables[length - 1]
        return np.maximum(held[one], held[two])

    def add(self, length: int, places: np.ndarray, scan: int) -> None:
        held = self.tables[length - 1]
        held[places] = np.minimum(held[places], scan)


def grouped(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One place of each distinct hash, and how often it stands there."""
    order = np.argsort(hashes, kind="stable")
    opens = np.flatnonzero(np.concatenate(([True], hashes[order][1:] != hashes[order][:-1])))
    return order[opens], np.diff(np.append(opens, len(order)))


def counted(
    documents: list[bytes], langs: list[str], frequent: Frequent, scan: int, shards: int, words_too: bool
) -> Iterator[pa.RecordBatch]:
    """The occurrences, in some documents, of all phrases that are active in this scan."""
    words = Words(documents, True, WORD_END)
    n = len(words.hashes)
    if not n:
        return
    seeds = {
        lang: np.uint64(int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little"))
        for lang in set(langs)
    }
    of = words.documents()
    keys = mix(words.hashes ^ np.array([seeds[lang] for lang in langs], np.uint64)[of])
    if words_too:
        at, uses = grouped(keys)
        spans = zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)
        yield _rows(
            [keys[at]], np.zeros(len(at), np.int16), uses,
            lang=[langs[d] for d in of[at].tolist()],
            word=pa.array([words.data[a:b].tobytes() for a, b in spans], pa.binary()).cast(pa.string()),
        )
    cuts = np.cumsum(PIECE_END[words.data])
    # A piece goes on from word i to the next where no byte between them ends one.
    goes_on = np.append(cuts[words.starts[1:]] == cuts[words.ends[:-1] - 1], False)
    hashes, at = keys, np.arange(n)
    for length in range(2, LONGEST + 1):
        # The scans with which the parts starting at each word were seen often enough.
        seen = np.full(n + 1, NEVER, np.int16)
        seen[at] = frequent.scan(length - 1, hashes)
        since = 1 + np.maximum(seen[at], seen[at + 1])
        fits = (since <= scan) & goes_on[at + length - 2]
        at, since, hashes = at[fits], since[fits], hashes[fits]
        if not len(at):
            return
        hashes = joined(hashes, keys[at + length - 1])
        active = np.flatnonzero(scan < since + shards)
        if len(active):
            first, uses = grouped(hashes[active])
            first = active[first]
            yield _rows([keys[at[first] + k] for k in range(length)], since[first], uses)


def _rows(keys: list[np.ndarray], since: np.ndarray, uses: np.ndarray, **named) -> pa.RecordBatch:
    n = len(uses)
    none = np.zeros(n, np.int64)
    columns = {k: none for k in KEYS} | {k: v.view(np.int64) for k, v in zip(KEYS, keys)}
    return emit(COUNTS, since=since.astype(np.int16), c=uses, **({"lang": [None] * n, "word": [None] * n} | named), **columns)


def count_phrases(
    docs: DataFrame, least: int = LEAST, shards: int = SHARDS, bits: int = BITS
) -> tuple[DataFrame, DataFrame]:
    """All words and phrases seen ``least`` times, with their counts, and the words of each language."""
    spark = docs.sparkSession
    folder = work_folder(spark, "phrases")
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang")
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).alias("shard")
    rows = docs.select(shard, lang, F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Files by row group; a shard without documents has no folder of its own.
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(f"{folder}/texts")
    corpus = spark.read.schema("lang string, text string, shard long").parquet(f"{folder}/texts")
    frequent = Frequent(bits)
    state, former, totals = None, None, None
    last, scan = shards - 1, 0
    while scan <= last:
        sent = spark.sparkContext.broadcast(frequent)

        def count(batches, sent=sent, scan=scan):
            for batch, documents in texts(batches, STEP):
                yield from counted(
                    documents, batch.column("lang").to_pylist(), sent.value, scan, shards, scan < shards
                )

        found = corpus.where(F.col("shard") == scan % shards).drop("shard").mapInArrow(count, COUNTS_DDL)
        if state is not None:
            # What has been counted in every shard and is rare is left behind.
            found = state.where((F.col("since") + shards > scan) | (F.col("c") >= least)).unionByName(found)
        path = f"{folder}/counts-{scan}"
        found.groupBy(*KEYS, "since", "lang", "word").agg(F.sum("c").alias("c")).write.option(
            "compression", "zstd"
        ).parquet(path)
        state = spark.read.schema(COUNTS_DDL).parquet(path)
        if former:
            remove_folder(former)
        former = path
        if scan == shards - 1:
            totals = cut(
                state.where("word is not null").groupBy("lang").agg(F.sum("c").alias("n")), "phrase-totals"
            )
        for length, places in _newly_frequent(state, least, sent).items():
            frequent.add(length, places, scan)
            last = max(last, scan + shards)
        sent.destroy()
        scan += 1
    return state.where(F.col("c") >= least).drop("since"), totals


def _newly_frequent(state: DataFrame, least: int, sent) -> dict[int, np.ndarray]:
    """By length, the table places of phrases that have just been seen often enough.

    The driver gets distinct places, at most the size of the tables.
    """
    schema = pa.schema([("length", pa.int32()), ("place", pa.int64())])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [batch.column(k).to_numpy().view(np.uint64) for k in KEYS]
            hashes = keys[0]
            for length in range(1, LONGEST):
                if length > 1:
                    hashes = joined(hashes, keys[length - 1])
                mine = (keys[length - 1] != 0) & (keys[length] == 0)
                new = hashes[mine]
                new = new[sent.value.scan(length, new) == NEVER]
                found = np.unique(np.concatenate(sent.value.places(new)))
                yield emit(schema, length=np.full(len(found), length, np.int32), place=found)

    often = state.where((F.col("c") >= least) & (F.col(KEYS[-1]) == 0)).select(KEYS)
    found = often.mapInArrow(places, "length int, place long").distinct().toArrow()
    lengths, places_ = found["length"].to_numpy(), found["place"].to_numpy()
    return {int(k): places_[lengths == k] for k in np.unique(lengths)}


def _phrase(first: int, last: int, names: tuple[str, ...]) -> str:
    """SQL of the words from number ``first`` to ``last`` as a struct of four keys."""
    keys = [f"w{k}" for k in range(first, last + 1)]
    keys += ["0L"] * (LONGEST - len(keys))
    return f"named_struct({', '.join(f"'{n}', {k}" for n, k in zip(names, keys))})"


def scored(frequent: DataFrame) -> DataFrame:
    """Phrases with a, l, r and score of their lowest-scoring cut; ties to the earliest cut."""
    left, right = tuple(f"l{k}" for k in range(4)), tuple(f"r{k}" for k in range(4))
    options = ", ".join(
        f"if(w{k + 1} != 0, struct({k} as k, {_phrase(1, k, left)} as l, {_phrase(k + 1, LONGEST, right)} as r), null)"
        for k in range(1, LONGEST)
    )
    cuts = (
        frequent.where("w2 != 0")
        .select(*KEYS, F.col("c").alias("a"), F.expr(f"inline(array_compact(array({options})))"))
        .select(*KEYS, "a", "k", "l.*", "r.*")
    )
    totals = frequent.select(*KEYS, "c")
    cuts = cuts.join(totals.toDF(*left, "l"), list(left)).join(totals.toDF(*right, "r"), list(right))
    score = F.expr("cast(a as decimal(20, 0)) * 2000000BD div (cast(l as decimal(20, 0)) + r)")
    best = cuts.groupBy(*KEYS, "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select(*KEYS, "a", "best.score", "best.l", "best.r")


def inside_longer(frequent: DataFrame) -> DataFrame:
    """By phrase, the count of the most frequent longer phrase that holds it."""
    parts = [
        f"if(w{length} != 0 and {'true' if length == LONGEST else f'w{length + 1} = 0'}, "
        f"{_phrase(first, last, tuple(KEYS))}, null)"
        for length in range(3, LONGEST + 1)
        for first in range(1, length)
        for last in range(first + 1, length + 1)
        if last - first + 1 < length
    ]
    return (
        frequent.where("w3 != 0")
        .select("c", F.expr(f"explode(array_compact(array({', '.join(parts)})))").alias("part"))
        .groupBy(*(F.col(f"part.{k}").alias(k) for k in KEYS))
        .agg(F.max("c").alias("longer"))
    )


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, shards: int = SHARDS) -> DataFrame:
    """Each language's first ``top`` phrases by score: lang, rank, phrase, a, l, r, n, score."""
    found, totals = count_phrases(docs, least, shards)
    found = cut(found, "phrase-counts")
    words = found.where("w2 = 0").select("w1", "lang", "word")
    left = scored(found.drop("lang", "word")).join(inside_longer(found), KEYS, "left")
    left = left.where(f"longer is null or 100BD * longer < {INSIDE}BD * a").drop("longer")
    by_score = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    of_part = Window.partitionBy("lang", "salt").orderBy(F.desc("score"), F.desc("a"))
    salt = F.pmod(F.xxhash64(*KEYS), F.lit(SALTS))
    # Ties at the end stay in until the texts of the phrases are known.
    ranked = left.join(words.drop("word"), "w1").withColumn("salt", salt)
    for window in (of_part, by_score):
        ranked = ranked.withColumn("place", F.rank().over(window)).where(F.col("place") <= top)
    first = cut(ranked.drop("salt", "place"), "phrase-first")
    spelled = (
        first.select(*KEYS, F.posexplode(F.array(*KEYS)).alias("at", "key"))
        .where("key != 0")
        .join(words.select(F.col("w1").alias("key"), "word"), "key")
        .groupBy(*KEYS)
        .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("words"))
        .select(*KEYS, F.array_join("words.word", " ").alias("phrase"))
    )
    by_phrase = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        first.join(spelled, KEYS)
        .withColumn("rank", F.row_number().over(by_phrase).cast("long"))
        .where(F.col("rank") <= top)
        .join(totals, "lang")
        .select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))
