"""A line that stands in every document is dealt to many tasks, with equal results."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wardstar.llm import substrings


@pytest.mark.parametrize("line", [5, 12, 24])
def test_frequent_line(spark, monkeypatch, line):
    """However many documents hold it, its passage is sent and compiled once."""
    monkeypatch.setattr(substrings, "SHARD_PIECES", 50)
    sent = []
    matched = substrings._matched

    def watched(passages):
        sent.extend(passages.select("words").collect())
        return matched(passages)

    monkeypatch.setattr(substrings, "_matched", watched)
    rng = random.Random(line)
    common = [f"c{k}" for k in range(line)]
    texts = {}
    for doc in range(300):
        own = [f"d{doc}x{k}" for k in range(60)]
        at = rng.randrange(60)
        texts[doc] = [*own[:at], *common, *own[at:]]
        if doc % 50 == 49:
            texts[doc] += texts[doc - 9][at - at % 7 :]
    table = spark.createDataFrame(
        [(k, " ".join(w)) for k, w in texts.items()], "doc_id long, text string"
    )
    got = {r["doc_id"]: r for r in substrings.remove_repeats(table).collect()}
    seen: set = set()
    for doc, words in texts.items():
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            key = tuple(words[k : k + 20])
            if key in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        assert got[doc]["n_removed"] == sum(gone)
        assert got[doc]["text"].split() == kept
    found = [bytes(r.words).decode().split() for r in sent]
    assert sum(common == w for w in found) <= 1
    assert sum(w[:3] == common[:3] for w in found) < 20


def test_only_matches_remove(spark, monkeypatch):
    """With automata that hold nothing, nothing is removed, first or later."""
    text = " ".join(f"w{k}" for k in range(50))
    table = spark.createDataFrame([(1, text), (2, "x " + text), (3, text)], "doc_id long, text string")
    full = {r.doc_id: r.n_removed for r in substrings.remove_repeats(table).collect()}
    assert full == {1: 0, 2: 50, 3: 50}
    passages = substrings._passage_rows
    nothing = F.transform("new", lambda _: F.lit(False))
    monkeypatch.setattr(substrings, "_passage_rows", lambda docs: passages(docs).withColumn("new", nothing))
    assert {r.n_removed for r in substrings.remove_repeats(table).collect()} == {0}


def test_a_document_that_repeats_itself(spark, monkeypatch):
    """However often a run stands in its first document, it is sent and found once."""
    sent = []
    matched = substrings._matched

    def watched(passages):
        sent.extend(r.run for r in passages.select("run").collect())
        return matched(passages)

    monkeypatch.setattr(substrings, "_matched", watched)
    texts = ["same " * 500, "one two three four five six seven " * 90, "same " * 70]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(table).collect()}
    assert got == {0: 499, 1: 630 - 7, 2: 70}
    assert len(sent) == len(set(sent)) < 100


def test_columns_of_the_caller_stay(spark):
    text = " ".join(f"w{k}" for k in range(30))
    names = ["_key", "_order", "_lost", "place", "digest", "run", "k", "_row", "found"]
    rows = [(1, text, *range(9)), (2, text, *range(10, 19))]
    table = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    got = {r.doc_id: r for r in substrings.remove_repeats(table).collect()}
    assert [got[2][n] for n in names] == [*range(10, 19)] and got[2].n_removed == 30
    assert (got[1].text, got[2].text) == (text, "")


def test_stages_keep_columns_of_any_name(spark, tmp_path):
    text = " ".join(f"w{k}" for k in range(30))
    names = ["score", "n_words", "n_removed", "_key", "at", "kept", "found"]
    rows = [(1, text, 7.5, *range(6)), (2, "x y z " + text, 8.5, *range(6))]
    schema = "doc_id long, text string, score double, " + ", ".join(f"{n} int" for n in names[1:])
    table = spark.createDataFrame(rows, schema)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    for stage in (corpus_pipeline.drop_toxic, corpus_pipeline.cut_repeats):
        got = sorted(stage(spark, table, str(tmp_path)).collect())
        assert [tuple(r)[2:] for r in got] == [(7.5, *range(6)), (8.5, *range(6))]
        assert got[0].__fields__ == table.columns
    assert got[1].text == "x y z"


def test_words_are_joined_by_one_space(spark):
    texts = ["", None, " ", "a", " a  b\t\n c\x0b\x0cd\r\r\re ", "a b  c", "  \t", "a b c"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    for text, joined in rows.select("text", substrings.spaced(F.col("text"))).collect():
        assert joined == " ".join(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
