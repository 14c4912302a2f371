"""Deleted interpolation: a bigram model mixed by context-frequency buckets.

Documents are gathered in blocks. A block asks for the corpus counts of its
distinct words and word pairs; the requests are dealt by key, so a word in every
document is one row per block, and the answers go back to the blocks. The mixture
weights of each bucket are learned by expectation-maximisation on pairs of held-out
training documents, whose counts are left out of the estimates they are judged by.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import cut, emit, partitions, table, texts
from wardstar.llm.words import BASE, Words, mix

#: Bytes of text in a block.
BLOCK_BYTES = 1 << 23
#: Documents that count, that judge the mixture, and that are only scored.
KEPT, HELD, SCORED = 0, 1, 2
#: One in so many training documents judges the mixture.
JUDGES = 10
#: Hashes of the end of a document and of the place before its first word.
END, BEGIN = mix(np.array([11, 13], np.uint64))
#: Steps for each factor of e in the histogram of estimates.
GRID = 5
BUCKETS = 48
ROUNDS = 60


def _pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(values.tobytes())


def _unpack(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


def _pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys by their steps, byte by byte: the high bytes are nearly all zero."""
    steps = np.diff(keys, prepend=np.uint64(0))
    return _pack(np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T))


def _unpack_sorted(data: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(_unpack(data, np.uint8).reshape(8, -1).T)
    return np.cumsum(steps.view(np.uint64).ravel(), dtype=np.uint64)


class Block(NamedTuple):
    """Token hashes of some documents, each ended by END."""

    tokens: np.ndarray
    before: np.ndarray
    owner: np.ndarray
    folds: np.ndarray

    @classmethod
    def of(cls, tokens: np.ndarray, sizes: np.ndarray, folds: np.ndarray) -> Block:
        before = np.concatenate(([BEGIN], tokens[:-1]))
        before[np.cumsum(sizes)[:-1]] = BEGIN
        return cls(tokens, before, np.repeat(np.arange(len(sizes)), sizes), folds)

    def pairs(self) -> np.ndarray:
        return mix(self.before * np.uint64(BASE) + self.tokens)

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct keys, whether a key is a word, and its counts by fold."""
        fold = self.folds[self.owner]
        first = self.before == BEGIN
        every = np.concatenate((self.tokens, self.before[first], self.pairs()))
        folds = np.concatenate((fold, fold[first], fold))
        kind = np.zeros(len(every), bool)
        kind[: len(self.tokens)] = True
        keys, place = np.unique(every, return_inverse=True)
        is_word = np.zeros(len(keys), bool)
        is_word[place[kind]] = True
        kept, held = (np.bincount(place[folds == f], minlength=len(keys)) for f in (KEPT, HELD))
        return keys, is_word, kept, held


BLOCK_FIELDS = "doc_ids array<long>, folds binary, sizes binary, words binary, tokens binary, judges boolean"


def _blocks(docs: DataFrame, fold: Column) -> DataFrame:
    schema = pa.schema([
        ("doc_ids", pa.list_(pa.int64())), ("folds", pa.binary()), ("sizes", pa.binary()),
        ("words", pa.binary()), ("tokens", pa.binary()), ("judges", pa.bool_()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(judges: bool, held: list) -> pa.RecordBatch:
            ids, folds, sizes, parts, _ = held
            words, tokens = np.unique(np.concatenate(parts), return_inverse=True)
            return emit(
                schema,
                doc_ids=[ids],
                folds=[_pack(np.array(folds, np.uint8))],
                sizes=[_pack(np.array(sizes, np.int64))],
                words=[words.tobytes()],
                tokens=[_pack(tokens.astype(np.uint32))],
                judges=[judges],
            )

        # Documents that judge the mixture have blocks of their own, so learning it
        # moves no others. Each: doc_ids, folds, sizes, token hashes, bytes.
        open_blocks: dict[bool, list] = {j: [[], [], [], [], 0] for j in (False, True)}
        for batch, found in texts(batches):
            words = Words(found, True)
            ends = words.first[1:]
            tokens = np.insert(words.hashes, ends, END)
            sizes = words.counts() + 1
            fold = batch.column("fold").to_numpy()
            doc_ids = batch.column("doc_id").to_pylist()
            for judges, held in open_blocks.items():
                chosen = (fold == HELD) == judges
                if not chosen.any():
                    continue
                held[0] += [doc_ids[k] for k in np.flatnonzero(chosen)]
                held[1] += fold[chosen].tolist()
                held[2] += sizes[chosen].tolist()
                held[3].append(tokens[np.repeat(chosen, sizes)])
                held[4] += int((np.diff(words.places))[chosen].sum())
                if held[4] >= BLOCK_BYTES:
                    yield flush(judges, held)
                    open_blocks[judges] = [[], [], [], [], 0]
        for judges, held in open_blocks.items():
            if held[0]:
                yield flush(judges, held)

    rows = docs.select("doc_id", "text", fold.alias("fold")).mapInArrow(run, BLOCK_FIELDS)
    return cut(rows.withColumn("block", F.monotonically_increasing_id()), "blocks")


def _read(row: dict) -> Block:
    words = np.frombuffer(row["words"], np.uint64)
    return Block.of(
        words[_unpack(row["tokens"], np.uint32)],
        _unpack(row["sizes"], np.int64),
        _unpack(row["folds"], np.uint8),
    )


def _counts(blocks: DataFrame) -> DataFrame:
    """For each block and part of the keys, the corpus counts of the block's keys."""
    parts = partitions(blocks.sparkSession)
    asked = pa.schema([
        ("part", pa.int32()), ("block", pa.int64()), ("keys", pa.binary()),
        ("is_word", pa.binary()), ("kept", pa.binary()), ("held", pa.binary()),
        ("judges", pa.bool_()),
    ])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                keys, *values = _read(row).keys()
                part = ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
                cuts = np.searchsorted(part, np.arange(parts + 1))
                for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                    if a < b:
                        is_word, kept, held = (v[a:b] for v in values)
                        yield emit(
                            asked, part=[p], block=[row["block"]], keys=[_pack_sorted(keys[a:b])],
                            is_word=[_pack(is_word)], kept=[_pack(kept)], held=[_pack(held)],
                            judges=[row["judges"]],
                        )

    answered = pa.schema([
        ("part", pa.int32()), ("block", pa.int64()), ("kept", pa.binary()),
        ("held", pa.binary()), ("vocabulary", pa.int64()), ("judges", pa.bool_()),
    ])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        if not rows:
            return
        keys = [_unpack_sorted(r.pop("keys")) for r in rows]
        place = np.unique(np.concatenate(keys), return_inverse=True)[1]
        n = int(place.max()) + 1
        totals = [
            np.bincount(place, np.concatenate([_unpack(r.pop(c), np.int64) for r in rows]), n)
            for c in ("kept", "held")
        ]
        is_word = np.concatenate([_unpack(r.pop("is_word"), bool) for r in rows])
        learned = np.zeros(n, bool)
        learned[place[is_word]] = True
        vocabulary = int((learned & (totals[0] + totals[1] > 0)).sum())
        start = 0
        for r, own in zip(rows, keys, strict=True):
            here = place[start : start + len(own)]
            start += len(own)
            kept, held = (_pack(t[here].astype(np.int64)) for t in totals)
            yield emit(
                answered, part=[r["part"]], block=[r["block"]], kept=[kept], held=[held],
                vocabulary=[vocabulary], judges=[r["judges"]],
            )
            vocabulary = 0

    requests = blocks.mapInArrow(
        ask,
        "part int, block long, keys binary, is_word binary, kept binary, held binary, "
        "judges boolean"
    )
    answers = requests.repartition(parts, "part").mapInArrow(
        answer,
        "part int, block long, kept binary, held binary, vocabulary long, judges boolean",
    )
    return cut(answers, "corpus-counts")


class Counted(NamedTuple):
    """A block with the counts of its tokens, contexts and pairs, kept and held."""

    row: dict
    block: Block
    word: np.ndarray
    context: np.ndarray
    pair: np.ndarray


def _with_counts(
    blocks: DataFrame, counts: DataFrame, use: Callable, schema: str
) -> DataFrame:
    """``use`` of every counted block; blocks and their answers meet in one partition."""
    blocks = blocks.drop("judges")
    fields = blocks.columns
    left = blocks.select(*fields, F.lit(-1).alias("part"), *[
        F.lit(None).cast("binary").alias(c) for c in ("kept", "held")
    ])
    right = counts.select(
        *[(F.col(c) if c == "block" else F.lit(None).cast(blocks.schema[c].dataType)).alias(c) for c in fields],
        "part", "kept", "held",
    )
    rows = left.unionByName(right).repartition("block").sortWithinPartitions("block", "part")

    def counted(row: dict, answers: list[dict]) -> Counted:
        block = _read(row)
        keys = block.keys()[0]
        totals = np.stack(
            [np.concatenate([_unpack(a[c], np.int64) for a in answers]) for c in ("kept", "held")]
        )
        found = [
            totals[:, np.searchsorted(keys, x)]
            for x in (block.tokens, block.before, block.pairs())
        ]
        return Counted(row, block, *found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, answers = None, []
        for batch in batches:
            for k in range(batch.num_rows):
                new = batch.slice(k, 1).to_pylist()[0]
                if new["part"] >= 0:
                    answers.append(new)
                    continue
                if row:
                    yield use(counted(row, answers))
                row, answers = new, []
        if row:
            yield use(counted(row, answers))

    return rows.mapInArrow(run, schema)


def _bucket(context: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the log of its count."""
    return np.where(context > 0, 1 + np.floor(np.log2(np.maximum(context, 1))), 0).astype(np.int64)


def learn_mixture(cells: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Weights of pair, word and uniform estimates by bucket, by EM.

    ``cells`` are (bucket, step of the pair's estimate, of the word's, count); steps
    are relative to the uniform estimate, and -1 is an estimate of zero.
    """
    out = np.tile(np.array([0.4, 0.5, 0.1]), (BUCKETS, 1))
    out[0] = (0.0, 0.9, 0.1)
    data = np.array(cells, np.int64).reshape(-1, 4)

    def fit(rows: np.ndarray, start: np.ndarray) -> np.ndarray:
        ratio = np.where(rows[:, 1:3] >= 0, np.exp(rows[:, 1:3] / GRID), 0.0)
        ratio = np.column_stack((ratio, np.ones(len(rows))))
        weight = start
        for _ in range(ROUNDS):
            share = ratio * weight
            share /= share.sum(axis=1, keepdims=True)
            weight = (share * rows[:, 3:]).sum(axis=0)
            weight = np.maximum(weight / weight.sum(), 1e-9)
        return weight / weight.sum()

    seen = data[data[:, 0] > 0]
    if len(seen):
        out[1:] = fit(seen, out[1])
    for bucket in np.unique(data[:, 0]):
        out[bucket] = fit(data[data[:, 0] == bucket], out[bucket])
    out[0] = (0.0, out[0][1], out[0][2])
    return out / out.sum(axis=1, keepdims=True)


def score(docs: DataFrame, held_out: Column) -> DataFrame:
    """The log10 probability of every row of ``docs`` (doc_id, text) under a model of them.

    ``held_out`` names the rows the model does not learn from (null: it does). Words
    are lower-cased (A to Z); a null text is empty; every document ends with one end
    token, which counts as a token. Returns doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score (add-one unigrams) and score. Null and repeated doc_id
    are rows like others; an empty table gives no rows. With no training rows the
    score is that of the uniform estimate.
    """
    out = F.coalesce(held_out, F.lit(False))
    judge = F.pmod(F.xxhash64("doc_id"), F.lit(JUDGES)) == 0
    fold = F.when(out, SCORED).when(judge, HELD).otherwise(KEPT).cast("int")
    blocks = _blocks(docs, fold)
    counts = _counts(blocks)
    vocabulary = counts.agg(F.sum("vocabulary")).first()[0] or 0
    sizes = pa.schema([("fold", pa.int64()), ("n", pa.int64())])

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                n, folds = _unpack(row["sizes"], np.int64), _unpack(row["folds"], np.uint8)
                yield emit(sizes, fold=folds.astype(np.int64), n=n)

    tokens = blocks.select("sizes", "folds").mapInArrow(tally, "fold long, n long")
    total = {r["fold"]: r["n"] for r in tokens.groupBy("fold").agg(F.sum("n").alias("n")).collect()}
    kept_n = total.get(KEPT, 0)
    train = kept_n + total.get(HELD, 0)
    uniform = 1.0 / (vocabulary + 1)
    cell = pa.schema([(c, pa.int64()) for c in ("bucket", "pair", "word", "n")])

    def steps(share: np.ndarray) -> np.ndarray:
        known = share > 0
        step = np.round(GRID * np.log(np.where(known, share, 1.0) / uniform))
        return np.where(known, np.maximum(step, 0), -1).astype(np.int64)

    def judged(c: Counted) -> pa.RecordBatch:
        """How often the held-out pairs of a block have which estimates."""
        chosen = c.block.folds[c.block.owner] == HELD
        word, context, pair = (x[0][chosen] for x in (c.word, c.context, c.pair))
        rows = np.column_stack((
            _bucket(context),
            steps(pair / np.maximum(context, 1)),
            steps(word / max(kept_n, 1)),
        ))
        found, n = np.unique(rows, axis=0, return_counts=True)
        return emit(cell, bucket=found[:, 0], pair=found[:, 1], word=found[:, 2], n=n)

    # The grid bounds what the driver gets, whatever the corpus.
    own = [rows.where("judges") for rows in (blocks, counts)]
    cells = _with_counts(*own, judged, "bucket long, pair long, word long, n long")
    cells = cells.groupBy("bucket", "pair", "word").agg(F.sum("n").alias("n")).collect()
    mixture = learn_mixture([tuple(r) for r in cells])
    scored = pa.schema([
        ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
        ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
        ("score", pa.float64()),
    ])

    def scores(c: Counted) -> pa.RecordBatch:
        word, context, pair = (x.sum(axis=0) for x in (c.word, c.context, c.pair))
        weight = mixture[_bucket(context)]
        chance = (
            weight[:, 0] * pair / np.maximum(context, 1)
            + weight[:, 1] * word / max(train, 1)
            + weight[:, 2] * uniform
        )
        n = len(c.block.folds)
        per = lambda x: np.bincount(c.block.owner, x, n)
        return emit(
            scored,
            doc_id=c.row["doc_ids"],
            held_out=c.block.folds == SCORED,
            n_tokens=np.bincount(c.block.owner, minlength=n),
            n_known=per(word > 0).astype(np.int64),
            train_tokens=np.full(n, train),
            base_score=per(np.log10((word + 1) / (train + vocabulary + 1))),
            score=per(np.log10(chance)),
        )

    return _with_counts(
        blocks,
        counts,
        scores,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


def query(spark, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    return score(table(spark, sf_dir, "documents"), remainder == 2)
