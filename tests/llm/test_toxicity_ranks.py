"""Held-out documents with label 1 rank above those with label 0, however few are labelled."""

from __future__ import annotations

import random

import numpy as np
import pytest

from wardstar.llm import toxicity

VILE = ["vile", "foul", "nasty", "rotten", "grim", "mean", "cruel", "dire"]


@pytest.mark.parametrize(("size", "marked"), [(80, 1), (600, 1), (600, 0)])
def test_held_out_rows_are_ranked(spark, size, marked):
    """Few documents, and documents whose words mark label 0 instead of 1."""
    rng = random.Random(size + marked)
    rows, labels = [], []
    for k in range(size):
        words = [f"w{rng.randint(0, 5000)}" for _ in range(80)]
        vile = rng.random() < 0.12
        if vile:
            words[30:36] = rng.choices(VILE, k=6)
        rows.append((k, " ".join(words)))
        labels.append((k, marked if vile else 1 - marked))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fitted(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    scored = toxicity.score(docs.where(toxicity.fold("doc_id", 3) == 1), model).collect()
    truth = dict(labels)
    ones = [r["score"] for r in scored if truth[r["doc_id"]] == 1]
    zeros = [r["score"] for r in scored if truth[r["doc_id"]] == 0]
    above = sum((a > b) + (a == b) / 2 for a in ones for b in zeros)
    assert above >= 0.85 * len(ones) * len(zeros) > 0


def test_evidence_never_speaks_against_its_label():
    best = np.arange(20.0)
    x = np.stack([best, best[::-1], best * 0, best * 0, best * 0 + 1], 1)
    curve = toxicity._curve(x, (best > 12).astype(float))
    assert curve[0] > 0 and curve[1] == 0
