"""Operators against brute force on rows with nulls, empty and long texts, and repeats."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from wardstar.llm import (
    decontamination,
    language_model,
    minhash,
    packing,
    sharding,
    substrings,
    syncmers,
    token_files,
    toxicity,
    warc,
)
from wardstar.llm.queries import ORACLES, QUERIES
from wardstar.llm.tokens import Encoder, default_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi".split()


def phrase(seed: int, n: int) -> str:
    """Words that repeat nowhere else, from a small generator."""
    return " ".join(f"{WORDS[(seed * 7 + k * k) % 16]}{seed}x{k}" for k in range(n))


@pytest.fixture(scope="session")
def rows():
    shared = phrase(99, 60)
    base = phrase(3, 80)
    near = base.replace("3x40", "3y40")
    return [
        (1, phrase(1, 50) + " " + shared, "en", "a", 1),
        (2, shared + "\n " + phrase(2, 30), "en", "a", 1),
        (3, base, "en", "a", 1),
        (4, near, "en", "a", 1),
        (5, base, "en", None, 1),
        (6, None, None, "a", None),
        (7, "", "en", "a", 0),
        (8, " \t\n", "en", "a", 3),
        (9, "Two words", "en", "a", 9),
        (10, phrase(10, 3000), "en", "a", 1),
        (11, " ".join(["again and"] * 60), "en", "a", 1),
        (None, phrase(12, 40), "en", "a", 1),
        (13, base, "en", "a", 1),
        (13, base, "en", "a", 1),
        (14, "漢字 é 😀 " * 9, "zz", "a", 1),
    ]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ids_of(text):
    return Encoder(default_path()).library.encode(text or "", add_special_tokens=False).ids


def test_best_fit_takes_the_tightest_bin():
    rng = random.Random(5)
    for _ in range(50):
        sizes = sorted((rng.randint(1, 40) for _ in range(60)), reverse=True)
        classes = [(s, len(list(g))) for s, g in itertools.groupby(sizes)]
        bins: list[int] = []
        placed = sharding.best_fit(classes, 50, bins)
        plain: list[int] = []
        for s in sizes:
            fit = [(left, k) for k, left in enumerate(plain) if left >= s]
            if fit:
                plain[min(fit)[1]] -= s
            else:
                plain.append(50 - s)
        assert sorted(bins) == sorted(plain)
        assert sum(p.n for p in placed) == len(sizes)


def test_sharding(docs, rows, empty):
    got = sharding.shard_rows(docs, 3).collect()
    assert len(got) == len(rows) and not sharding.shard_rows(empty, 3).collect()
    assert sum(r["size"] for r in got) == sum(len((t or "").encode()) + 1 for _, t, *_ in rows)
    for shard in range(3):
        slots = sorted(r["slot"] for r in got if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    assert len({r["shard"] for r in got if r["doc_id"] in (3, 5, 13)}) == 1


def test_near_duplicates(docs, rows, empty):
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    assert got[4]["component_id"] == got[5]["component_id"] == got[13]["component_id"] == 3
    assert [got[k]["n_shingles"] for k in (3, 6, 7, 8, 9)] == [76, 0, 0, 0, 1]
    assert not got[4]["kept"] and got[3]["kept"] and got[None]["component_id"] is None
    assert not minhash.near_duplicates(empty).collect()


def test_near_duplicates_in_one_large_group(spark):
    rng = random.Random(2)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(rng.randint(0, 5)):
            words[rng.randrange(120)] = f"n{rng.random()}"
        rows.append((k, " ".join(words)))
    sets = {k: {tuple(t.split()[i : i + 5]) for i in range(116)} for k, t in rows}
    parent = list(range(150))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(150), 2):
        if 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {k: root(k) for k in range(150)}


def test_sketch_fills_every_coordinate():
    for n in (1, 3, 500):
        shingles = np.arange(1, n + 1, dtype=np.uint64)
        assert minhash.sketch(shingles).max() < np.iinfo(np.uint64).max
    a, b = np.arange(0, 400, dtype=np.uint64), np.arange(100, 500, dtype=np.uint64)
    same = (minhash.sketch(a) == minhash.sketch(b)).mean()
    assert abs(same - 0.6) < 0.2


def test_token_files(docs, rows, empty):
    manifest = token_files.write_token_files(docs, default_path())
    got = token_files.read_token_files(manifest).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for row, (doc_id, text, *_) in zip(sorted(got, key=lambda r: r["start"]), order, strict=True):
        ids = np.array([*ids_of(text), 0], "<u4").tobytes()
        assert (row["doc_id"], row["start"], row["ids"]) == (doc_id, start, ids)
        start += len(ids) // 4
    path = manifest.where("documents > 1").first()["path"]
    reader = token_files.FileReader(path)
    one = next(k for k, _ in reader.documents())
    assert [k for k, _ in reader.documents([one])][0] == one
    assert not token_files.read_token_files(
        token_files.write_token_files(empty, default_path())
    ).collect()


def test_damaged_frame_is_found(docs):
    path = token_files.write_token_files(docs, default_path()).first()["path"]
    path = path.removeprefix("file://")
    with open(path, "r+b") as file:
        file.seek(20)
        file.write(b"\x00\xff\x00")
    with pytest.raises(Exception):  # noqa: B017  zstandard's own error or the checksum's
        list(token_files.FileReader(path).documents())


def test_language_model(docs, rows, empty):
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    got = language_model.score(docs, remainder == 2).collect()
    tokens = [(k, [*WORD.findall((t or "").translate(LOWER)), None]) for k, t, *_ in rows]
    train = [t for k, t in tokens if k is None or zlib.crc32(str(k).encode()) % 7 != 2]
    counts = Counter(w for t in train for w in t)
    total = sum(counts.values())
    expected = sorted(
        round(sum(math.log10((counts[w] + 1) / (total + len(counts) + 1)) for w in t), 6)
        for _, t in tokens
    )
    assert sorted(round(r["base_score"], 6) for r in got) == expected
    assert {r["train_tokens"] for r in got} == {total}
    assert all(r["score"] < 0 for r in got)
    assert not language_model.score(empty, remainder == 2).collect()


def test_mixture_learns_which_estimate_is_right():
    weights = language_model.learn_mixture([(3, 20, -1, 90), (3, -1, 5, 10)])
    assert weights[3][0] > 0.8 and abs(weights[3].sum() - 1) < 1e-9


@pytest.mark.parametrize("choose", ["norm", "dot"])
def test_packing_holds_every_constraint(choose):
    rng = random.Random(1)
    lengths = sorted(Counter(rng.randint(1, 64) for _ in range(500)).items(), reverse=True)
    capacity = packing.Capacity(64, 5, 2000 + 64 * 64)
    used: dict[int, list] = {}
    for run in packing.vector_best_fit(lengths, capacity, choose):
        for k in range(run.n):
            used.setdefault(run.sequence + k // run.each, []).append(
                (run.offset + k % run.each * run.length, run.length)
            )
    assert sum(map(len, used.values())) == 500
    for pieces in used.values():
        pieces.sort()
        assert [o for o, _ in pieces] == [sum(n for _, n in pieces[:k]) for k in range(len(pieces))]
        sizes = [n for _, n in pieces]
        assert sum(sizes) <= 64 and len(sizes) <= 5 and sum(n * n for n in sizes) <= capacity.attention


def test_packing(docs, rows, empty):
    got = packing.pack(docs, default_path(), with_ids=True).collect()
    for doc_id, text, *_ in rows:
        ids = np.array([*ids_of(text), 2], "<u4").tobytes()
        own = [r for r in got if r["doc_id"] == doc_id and r["start"] * 4 < len(ids)]
        own = {r["piece"]: r["ids"] for r in own}
        assert b"".join(own[k] for k in sorted(own)) == ids
    assert not packing.pack(empty, default_path()).collect()


def test_fingerprints(docs, rows, empty):
    got = syncmers.fingerprints(docs).collect()
    assert len(got) == len(rows) and not syncmers.fingerprints(empty).collect()
    by = {r["doc_id"]: r for r in got}
    text, following = rows[0][1], rows[1][1]
    n = len(text) // 4
    edited = (text[: len(text) - n] + following[:n]).encode()
    assert by[1]["edited_sha256"] == hashlib.sha256(edited).hexdigest()
    assert by[3]["fingerprint"] == by[5]["fingerprint"] == by[13]["fingerprint"]
    assert by[1]["next_doc_id"] == rows[1][0]
    assert by[10]["near_edited"] > 0.4 > by[10]["near_next"]
    assert by[7]["fingerprint"] == "" and by[9]["fingerprint"] != ""


def closed_syncmers(text: str, k: int = 4, s: int = 2, size: int = 64) -> list[tuple[int, int]]:
    """Anchors by the definition, with the hash functions of Spark."""

    def hashed(values: list[int]) -> int:
        seed = 42
        for v in values:
            seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little"), seed)
        return seed

    def signed(v: int) -> int:
        return v - (1 << 64) if v >> 63 else v

    words = [xxhash.xxh64_intdigest(w.encode(), 42) for w in text.lower().split()]
    first: dict[int, int] = {}
    for i in range(len(words) - k + 1):
        inner = [hashed(words[j : j + s]) for j in range(i, i + k - s + 1)]
        order = [signed(x) for x in inner]
        if min(order) in (order[0], order[-1]):
            first.setdefault(signed(hashed([inner[0], inner[k - s]])), i)
    return sorted(first.items())[:size]


def test_anchors_are_closed_syncmers(spark):
    rng = random.Random(7)
    texts = [
        " ".join(rng.choice("ab cde F gh ij".split()) + str(rng.randint(0, m)) for _ in range(n))
        for n, m in ((4, 3), (9, 0), (40, 1), (400, 9), (3000, 2))
    ]
    found = spark.createDataFrame([(t,) for t in texts], "text string").select(
        "text", syncmers.anchors(F.col("text")).alias("found")
    )
    compared = 0
    for row in found.collect():
        expected = closed_syncmers(row["text"])
        if expected:
            assert [tuple(a) for a in row["found"]] == expected
            compared += 1
    assert compared >= 4


def test_fingerprints_hold_every_anchor_and_match_by_place(spark):
    """Texts far over 64 anchors, anchors that recur, and a passage that moved."""
    rng = random.Random(11)
    passage = phrase(21, 300)
    texts = {
        1: phrase(22, 2000) + " " + passage,
        2: passage + " " + phrase(23, 1500),
        3: "to be or not to be that is " * 90 + phrase(24, 50),
        4: "to be or not to be that is " * 30,
        5: " ".join(rng.choice("abc") for _ in range(700)),
        6: " ".join(rng.choice("abc") for _ in range(400)),
        7: "two words",
        8: "",
        9: "same " * 333,
    }

    def every(text):
        # The definition for one place at a time: each run of four words on its own.
        words = text.split()
        runs = [" ".join(words[i : i + 4]) for i in range(max(0, len(words) - 3))]
        found = [(closed_syncmers(run), i) for i, run in enumerate(runs)]
        return [(f[0][0], i) for f, i in found if f]

    def link_counts(found):
        return Counter((a[0], b[0], b[1] - a[1]) for a, b in itertools.pairwise(found))

    def share(a, b):
        a, b = link_counts(a), link_counts(b)
        return sum((a & b).values()) / max(1, sum((a | b).values()))

    table = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r["doc_id"]: r for r in syncmers.fingerprints(table).collect()}
    found = {k: every(t) for k, t in texts.items()}
    for k, row in got.items():
        # Before the row comes the text that this row is next to.
        follower = texts[k % 9 + 1]
        n = len(texts[k]) // 4
        edited = texts[k][: len(texts[k]) - n] + follower[:n]
        if not found[k]:
            continue
        printed = [f"{v & (1 << 64) - 1:X}:{i}" for v, i in found[k]]
        assert row["fingerprint"].split() == printed
        assert row["near_edited"] == pytest.approx(share(found[k], every(edited)))
        if found[k % 9 + 1]:
            assert row["near_next"] == pytest.approx(share(found[k], found[k % 9 + 1]))
    assert len(found[1]) > 1000 and len(found[9]) == 330
    assert got[1]["near_next"] > 0.05 and got[8]["near_next"] == 0


def test_maximal_segments():
    def brute(x, a, b):
        spans = [(i, j, sum(x[i:j])) for i in range(a, b) for j in range(i + 1, b + 1)]
        best = max(spans, key=lambda s: s[2], default=(0, 0, 0))
        if best[2] <= 0:
            return []
        return [*brute(x, a, best[0]), best, *brute(x, best[1], b)]

    rng = random.Random(7)
    for _ in range(200):
        x = [rng.uniform(-3, 2) for _ in range(rng.randint(0, 12))]
        got = toxicity.maximal_segments(np.array(x))
        assert [(s.start, s.stop) for s in got] == [(i, j) for i, j, _ in brute(x, 0, len(x))]


def test_toxicity(spark, docs, empty):
    rng = random.Random(3)
    rows, labels = [], []
    for k in range(400):
        words = [f"w{rng.randint(0, 300)}" for _ in range(60)]
        if k % 5 == 0:
            words[20:24] = rng.choices(["vile", "foul", "vilest", "fouler"], k=4)
        rows.append((k, " ".join(words)))
        labels.append((k, int(k % 5 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(table, spark.createDataFrame(labels, "doc_id long, label int"))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(table, model).collect()}
    assert all((s >= 0.7) == (k % 5 == 0) for k, s in scores.items())
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(docs, model).collect())
    assert toxicity.passages(model, rows[0][1])[0][1] > 0
    nothing = toxicity.fit(empty, spark.createDataFrame([], "doc_id long, label int"))
    assert not toxicity.score(empty, nothing).collect()


def test_substrings(docs, rows, empty):
    got = {r["doc_id"]: r for r in substrings.remove_repeats(docs).collect()}
    seen: set = set()
    for doc_id, text, *_ in sorted(rows[:-2], key=lambda r: (r[0] is not None, r[0] or 0)):
        words = WORD.findall(text or "")
        if doc_id == 13:
            continue
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            key = tuple(words[k : k + 20])
            if key in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(key)
        assert (got[doc_id]["n_words"], got[doc_id]["n_removed"]) == (len(words), sum(gone))
        kept = [w for w, g in zip(words, gone, strict=True) if not g]
        assert WORD.findall(got[doc_id]["text"] or "") == kept
    assert got[13]["n_removed"] == 80 and not substrings.remove_repeats(empty).collect()


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, "u", "same"), (2, "v", "same"), (3, None, None), (4, "w", ""), (None, "x", "same"),
         (5, "y", "\x1f\x8b\x08" * 50), (6, "z", "é" * 3000)],
        "page_id long, url string, html string",
    )
    manifest = warc.write_archives(pages)
    for size in (97, 1 << 22):
        got = {r["page_id"]: r for r in warc.read_archives(manifest, size).collect()}
        assert len(got) == 7
        assert (got[1]["record_type"], got[1]["refers_to"]) == ("revisit", 2)
        assert got[2]["record_type"] == "response" and got[3]["refers_to"] == 4
        assert got[None]["refers_to"] == 2 and got[6]["payload"].decode() == "é" * 3000
    assert not warc.read_archives(warc.write_archives(pages.limit(0))).collect()


def test_decontamination(spark, docs, empty):
    items = spark.createDataFrame(
        [(1, " ".join(f"q{k}" for k in range(30))), (2, "one two three four"), (3, None)],
        "item_id long, text string",
    )
    words = [f"q{k}" for k in range(30)]
    words[4] = "other"
    del words[20]
    planted = spark.createDataFrame(
        [(1, "before " + " ".join(words) + " after"), (2, "One, two, three. Four!"),
         (3, "one two four"), (4, None)],
        "doc_id long, text string",
    )
    got = {(r["doc_id"], r["item_id"]): r for r in decontamination.matches(planted, items).collect()}
    assert set(got) == {(1, 1), (2, 2)} and got[1, 1]["distance"] == 2
    assert not decontamination.matches(docs, items).collect()
    assert not decontamination.matches(empty, items).collect()
    assert not decontamination.matches(docs, items.limit(0)).collect()


def test_best_part_is_the_least_distance():
    rng = random.Random(4)
    for _ in range(200):
        item = [rng.randint(0, 3) for _ in range(rng.randint(1, 7))]
        window = [rng.randint(0, 3) for _ in range(rng.randint(0, 9))]
        row = [0] * (len(window) + 1)
        for i, x in enumerate(item, 1):
            new = [i]
            for j, y in enumerate(window, 1):
                new.append(min(row[j - 1] + (x != y), row[j] + 1, new[-1] + 1))
            row = new
        found = decontamination.best_part(np.array(item), np.array(window, int))
        assert found[0] == min(row)


def test_encoder_equals_the_library():
    texts = ["", "  a\n\n b  ", "<|endoftext|> x", "don't 123 ©é 漢字  \t", "a" * 3000, "x ​ y", "a, b. c"]
    encoder = Encoder(default_path(), 4)
    for text in texts * 2:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids_of(text)


def test_pipeline_stages(spark, docs, empty, tmp_path):
    schema = "doc_id long, quality int, toxic int"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "one two three")], "item_id long, text string").write.parquet(
        str(tmp_path / "benchmark.parquet")
    )
    for table in (docs, empty):
        rows = table
        for _, stage in corpus_pipeline.STAGES[:-1]:
            rows = stage(spark, rows, str(tmp_path))
            assert rows.columns == docs.columns
            rows = spark.createDataFrame(rows.collect(), docs.schema)
        kept = {r["doc_id"] for r in rows.collect()}
        assert (kept >= {1, 2, 3, 6, 7, 9, 10, None}) == (table is docs)
        assert not kept & {4, 5, 13}


def test_every_operator_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES)
    assert numbers == list(range(1, 14))


#: Queries that SQL cannot express, and the test that holds each against brute force.
WITHOUT_SQL = {
    "op1_sharding": "test_sharding",
    "op2_near_dedup": "test_near_duplicates",
    "op3_token_files": "test_token_files",
    "op4_language_model": "test_language_model",
    "op5_packing": "test_packing",
    "op6_fingerprints": "test_fingerprints",
    "op7_toxicity": "test_toxicity",
    "op8_substring_dedup": "test_substrings",
    "op10_decontamination": "test_decontamination",
    "op12_bpe": "test_texts_equal_the_library",
}


def test_every_query_has_sql_or_a_test():
    assert set(QUERIES) == set(ORACLES) | set(WITHOUT_SQL)
    sources = "".join(p.read_text() for p in Path(__file__).parent.glob("test_*.py"))
    for name in WITHOUT_SQL.values():
        assert f"def {name}(" in sources, name
