"""Phrase counts and ranks against plain counting."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np

from wardstar.llm import phrases

SCHEMA = "doc_id long, text string, lang string, since long, c string, shard int, word string"


def brute(rows, top, least):
    counts: Counter = Counter()
    for _, text, lang, *_ in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            words = re.findall(r"[^\x20\x09]+", piece)
            for size in range(1, 5):
                for k in range(len(words) - size + 1):
                    counts[lang or "und", tuple(words[k : k + size])] += 1
    found = []
    candidates = {p: a for p, a in counts.items() if len(p[1]) > 1 and a >= least}
    for (lang, words), a in candidates.items():
        inside = any(
            other == lang and len(longer) > len(words) and 100 * b >= 80 * a
            and any(longer[k : k + len(words)] == words for k in range(len(longer)))
            for (other, longer), b in candidates.items()
        )
        if inside:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((2000000 * a // (left + right), k, left, right))
        score, _, left, right = min(cuts)
        n = sum(c for (other, w), c in counts.items() if other == lang and len(w) == 1)
        found.append((lang, -score, -a, " ".join(words).encode(), left, right, n))
    out, rank = [], Counter()
    for lang, score, a, phrase, left, right, n in sorted(found):
        rank[lang] += 1
        if rank[lang] <= top:
            out.append((lang, rank[lang], phrase.decode(), -a, left, right, n, -score))
    return out


def documents(seed):
    rng = random.Random(seed)
    common = "the of And a to é ß x".split()
    rows = []
    for k in range(900):
        words = [rng.choice(common) if rng.random() < 0.8 else f"w{rng.randint(0, 40)}" for _ in range(40)]
        if k % 3 == 0:
            words[5:9] = ["new", "York", "city", "hall"]
        text = "".join(w + rng.choice([" ", " ", " ", "\t", ", ", ".\n", "! "]) for w in words)
        rows.append((k, text, rng.choice(["en", "en", "fr", None]), 1, "c", 2, "w"))
    rows += [(1, None, "en", 1, "c", 2, "w"), (None, "", None, 1, "c", 2, "w"), (7, " ., \n", "de", 1, "c", 2, "w")]
    rows += [(9, "same words again here " * 40, "en", 1, "c", 2, "w")] * 3
    rows += [(10, "x" * 100_000 + " of the " + "y" * 100_000, "en", 1, "c", 2, "w")]
    return rows


def test_against_plain_counting(spark):
    rows = documents(1)
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = brute(rows, 25, 30)
    assert len(expected) > 30
    for shards in (1, 2, 4):
        got = phrases.collocations(table, 25, 30, shards).collect()
        assert sorted(map(tuple, got), key=lambda r: r[:2]) == sorted(expected, key=lambda r: r[:2])


def test_full_tables_only_cost_time(spark):
    """With two places for everything, every phrase starts early, and counts stay right."""
    rows = documents(2)
    table = spark.createDataFrame(rows, SCHEMA)
    counts, totals = phrases.count_phrases(table, 30, 3, bits=1)
    few, _ = phrases.count_phrases(table, 30, 3)
    keys = ["w1", "w2", "w3", "w4", "c"]
    assert sorted(counts.select(keys).collect()) == sorted(few.select(keys).collect())
    assert {r.lang for r in totals.collect()} == {"en", "fr", "und"}


def test_empty_table(spark):
    assert not phrases.collocations(spark.createDataFrame([], SCHEMA)).collect()


def test_rare_parts_are_never_counted():
    """Only phrases whose parts were seen often enough are counted."""
    frequent = phrases.Frequent(20)
    [words] = phrases.counted([b"a b a b. a c"], ["en"], frequent, 0, 2, True)
    assert sorted(zip(words["word"].to_pylist(), words["c"].to_pylist())) == [("a", 3), ("b", 2), ("c", 1)]
    keys = {w: k for w, k in zip(words["word"].to_pylist(), words["w1"].to_numpy().view("u8"))}
    for word in "ab":
        for places in frequent.places(np.array([keys[word]])):
            frequent.add(1, places, 0)
    [pairs] = phrases.counted([b"a b a b. a c"], ["en"], frequent, 1, 2, False)
    assert sorted(pairs["c"].to_pylist()) == [1, 2]
    assert not list(phrases.counted([b"a b a b. a c"], ["en"], frequent, 3, 2, False))
