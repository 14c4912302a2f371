"""Encoding through the transducer against the library, and the automaton itself."""

from __future__ import annotations

import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from wardstar.llm import bpe, transducer

PATH = bpe.default_path()
ODD = ["İ", "Σ", "ς", "漢", "́", "J̌", "<|endoftext|>", "<|startoftext|>", "<|", "ﬁ", "가", " ", "𝔘", "Å", "\x1c", "\x85"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(8)
    latin = list("aAsStTdDmMrRvVlLeE'''  \n\t.,<>|_019éÉñßçœŒ²½")
    found = ["".join(rng.choices(latin + ODD, k=rng.randint(0, 60))) for _ in range(400)]
    found += ["".join(rng.choices(latin, k=rng.randint(0, 60))) for _ in range(400)]
    found += ["It's the cat's, isn't it? We'll've I'm ''s 'd 'rest", "", " \n", "x" * 50_000, "ab " * 60_000]
    return found


def test_texts_equal_the_library(spark, library):
    rows = [(k, t, "ids", 1) for k, t in enumerate(texts())] + [(None, None, "", 1), (3, "again", "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, word int").repartition(3)
    for limit in (0, 40, 10_000):
        files = bpe.fitted(docs, PATH, limit)
        got = bpe.decode(bpe.encode(docs, PATH, files), PATH).collect()
        found = sorted((r.doc_id or 0, bytes(r.ids), r.text) for r in got)
        expected = []
        for doc_id, text, *_ in rows:
            ids = library.encode(text or "", add_special_tokens=False).ids
            decoded = library.decode(ids, skip_special_tokens=False)
            expected.append((doc_id or 0, np.array(ids, "<u4").tobytes(), decoded))
        assert found == sorted(expected)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert not bpe.encode(docs, PATH, bpe.fitted(docs, PATH)).collect()


def test_every_word_has_its_row_and_no_other_string_has_one():
    rng = random.Random(2)
    words = sorted({"".join(rng.choices("abé", k=rng.randint(1, 7))).encode() for _ in range(500)})
    arrays = transducer.compiled(words) | {"starts": np.zeros(1, int), "ids": np.zeros(0, int)}
    found = transducer.Transducer(arrays)
    others = [w + b"c" for w in words] + [w[:-1] for w in words if w[:-1] not in set(words)] + [b""]
    cells = words + others
    offsets = np.cumsum([0, *map(len, cells)])
    rows = found.rows(np.frombuffer(b"".join(cells), np.uint8), offsets)
    assert rows.tolist() == [*range(len(words)), *[-1] * len(others)]


def test_states_are_shared_and_minimal():
    words = sorted(a + b"ation" for a in (b"n", b"st", b"r", b"cre", b"rot"))
    arrays = transducer.compiled(words)
    # The root, six states of "ation", two after c, one after r, and one before t for s and ro.
    assert len(arrays["finals"]) == 1 + 6 + 2 + 1 + 1
    assert arrays["finals"].sum() == 1


def test_unseen_words_only_are_merged():
    """Words in the transducer take their ids from it, right or wrong."""
    known = bpe.vocabulary(PATH)
    arrays = transducer.compiled([b"cat"]) | {"starts": np.array([0, 2]), "ids": np.array([7, 9], np.uint32)}
    part = bpe.Slice([b"Cat dog cat", b""], known)
    ids, sizes = bpe.encoded(part, transducer.Transducer(arrays), known)
    dog = known.ids(["dog"])[0].tolist()
    assert ids.tolist() == [7, 9, *dog, 7, 9] and sizes.tolist() == [4 + len(dog), 0]
