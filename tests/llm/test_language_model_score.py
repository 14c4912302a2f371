"""The score of deleted interpolation against plain dictionaries and loops."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardstar.llm import language_model
from wardstar.llm.language_model import GRID, HELD, JUDGES, KEPT, SCORED, learn_mixture

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bucket(n: int) -> int:
    return n.bit_length()


@pytest.fixture(scope="module")
def rows():
    draw = np.random.default_rng(5)
    words = [f"W{k}" for k in range(60)]
    chance = 1 / np.arange(1, 61)
    chance /= chance.sum()
    out = [(k, " ".join(draw.choice(words, int(n), p=chance))) for k, n in enumerate(draw.integers(0, 90, 150))]
    return [*out, (150, None), (151, "unseen words only"), (152, " ".join(["w1 w2"] * 4000))]


def test_score_equals_plain_loops(spark, rows, monkeypatch):
    # Small blocks, so that counts come from many of them.
    monkeypatch.setattr(language_model, "BLOCK_BYTES", 3000)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    got = {r["doc_id"]: r for r in language_model.score(docs, remainder == 2).collect()}
    judge = F.pmod(F.xxhash64("doc_id"), F.lit(JUDGES)) == 0
    judges = {r[0] for r in docs.where(judge).select("doc_id").collect()}
    fold = {
        k: SCORED if zlib.crc32(str(k).encode()) % 7 == 2 else HELD if k in judges else KEPT
        for k, _ in rows
    }
    tokens = {k: [*(w.lower() for w in WORD.findall(t or "")), None] for k, t in rows}

    def counted(folds):
        # A context is counted by the tokens that follow it; the place before a text counts too.
        word, context, pair = Counter(), Counter(), Counter()
        for k, seq in tokens.items():
            if fold[k] in folds:
                word.update(seq)
                context.update(["", *seq[:-1]])
                pair.update(zip(["", *seq[:-1]], seq, strict=True))
        return word, context, pair

    word, context, pair = counted({KEPT})
    every = counted({KEPT, HELD})
    n, total = sum(word.values()), sum(every[0].values())
    uniform = 1 / (len(every[0]) + 1)

    def step(share):
        return max(0, round(GRID * math.log(share / uniform))) if share else -1

    cells = Counter()
    for k, seq in tokens.items():
        if fold[k] == HELD:
            for a, b in zip(["", *seq[:-1]], seq, strict=True):
                cells[
                    bucket(context[a]), step(pair[a, b] / max(context[a], 1)), step(word[b] / n)
                ] += 1
    mixture = learn_mixture([(*c, m) for c, m in cells.items()])
    assert len(cells) > 20
    word, context, pair = every
    for k, seq in tokens.items():
        expected = 0.0
        for a, b in zip(["", *seq[:-1]], seq, strict=True):
            w = mixture[bucket(context[a])]
            expected += math.log10(
                w[0] * pair[a, b] / max(context[a], 1) + w[1] * word[b] / total + w[2] * uniform
            )
        assert got[k]["score"] == pytest.approx(expected, rel=1e-9), k
        assert got[k]["n_known"] == sum(word[b] > 0 for b in seq)


def test_sorted_keys_come_back():
    draw = np.random.default_rng(1).integers(0, 2**64, 5000, np.uint64, endpoint=False)
    for keys in (np.unique(draw), draw[:0], np.array([0, 2**64 - 1], np.uint64)):
        packed = language_model._pack_sorted(keys)
        assert (language_model._unpack_sorted(packed) == keys).all()
    assert len(language_model._pack_sorted(np.unique(draw))) < 5000 * 7.5
