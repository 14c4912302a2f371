"""What one step of the encoder holds beside the texts it is given."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa

from wardstar.llm import packing, token_files, tokens
from wardstar.llm.common import texts


def test_a_step_of_the_encoder_is_small():
    encoder = tokens.Encoder(tokens.default_path())
    text = "some words, which return often. " * 32768
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(24)), "text": [text] * 24})
    whole = encoder.library.encode(text, add_special_tokens=False).ids
    tracemalloc.start()
    n = 0
    for _, found in texts(iter([batch]), tokens.ENCODED_BYTES):
        for ids in encoder.encode_all(found):
            assert ids == np.array(whole, "<u4").tobytes()
            n += 1
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 24
    assert peak < 160e6


def test_the_library_gets_a_bounded_number_of_pieces_at_once():
    encoder = tokens.Encoder(tokens.default_path())
    asked: list[str] = []
    library = encoder._library
    encoder._library = lambda given: asked.extend(given) or library(given)
    text = " ".join(f"w{k}" for k in range(3 << 13))
    whole = encoder.library.encode(text, add_special_tokens=False).ids
    assert encoder.encode(text) == np.array(whole, "<u4").tobytes()
    assert max(t.count(" ") for t in asked) <= 1 << 13


def test_a_worker_keeps_no_pieces_after_its_task(spark):
    path = tokens.default_path()
    texts_of = [(k, " ".join(f"w{k}x{j}" for j in range(50))) for k in range(40)]
    docs = spark.createDataFrame(texts_of, "doc_id long, text string").repartition(4)

    def held(batches):
        # The same workers again: what the encoder of each still has.
        for _ in batches:
            pass
        made = tokens.encoder.cache_info().currsize
        known = tokens.encoder(path)
        yield pa.RecordBatch.from_pydict({"made": [made], "n": [len(known.memo) + len(known.older)]})

    for encode in (
        lambda: packing.pack(docs, path).count(),
        lambda: token_files.write_token_files(docs, path).count(),
    ):
        assert encode()
        rows = spark.range(0, 32, 1, 16).mapInArrow(held, "made long, n long").collect()
        assert max(r.made for r in rows) == 1
        assert max(r.n for r in rows) == 0
