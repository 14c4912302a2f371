"""The encoder asks the library for nothing it knows, and gives what the library gives."""

from __future__ import annotations

import numpy as np

from wardstar.llm.tokens import Encoder, default_path


def test_a_word_before_a_mark_is_known_from_the_older_generation():
    encoder = Encoder(default_path(), size=8)
    asked: list[str] = []
    library = encoder._library
    encoder._library = lambda texts: asked.extend(texts) or library(texts)
    encoder.encode("one zebra a b c d e")
    encoder.encode("two three")
    assert encoder.older
    asked.clear()
    found = encoder.encode("one zebra. zebra, six")
    assert not any("zebra" in text for text in asked)
    whole = encoder.library.encode("one zebra. zebra, six", add_special_tokens=False)
    assert found == np.array(whole.ids, "<u4").tobytes()


def test_pieces_of_many_scripts_and_empty_texts():
    encoder = Encoder(default_path(), size=3)
    texts = ["", "a", " ", "\n", "un été, là-bas.\nOui !", "日本 語", "x  y\t z ", "<|endoftext|> a.", ""]
    for _ in range(3):
        found = encoder.encode_all([t.encode() for t in texts])
        for text, ids in zip(texts, found, strict=True):
            whole = encoder.library.encode(text, add_special_tokens=False)
            assert ids == np.array(whole.ids, "<u4").tobytes()
