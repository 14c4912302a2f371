"""Hashes of words in a row against the polynomial written out."""

from __future__ import annotations

import numpy as np

from wardstar.llm.words import BASE, Words, mix, ngrams


class Counted(np.ndarray):
    """An array that counts how often it is multiplied."""

    times = 0

    def __array_ufunc__(self, ufunc, method, *inputs, **kwargs):
        Counted.times += ufunc is np.multiply
        plain = [i.view(np.ndarray) if isinstance(i, Counted) else i for i in inputs]
        if "out" in kwargs:
            kwargs["out"] = tuple(o.view(np.ndarray) for o in kwargs["out"])
        return getattr(ufunc, method)(*plain, **kwargs).view(Counted)


def test_ngrams_are_the_polynomial_in_few_steps():
    hashes = np.random.default_rng(1).integers(0, 2**63, 60, dtype=np.uint64) * np.uint64(2)
    for n in (1, 2, 3, 4, 5, 7, 16, 20, 59, 60):
        plain = [
            sum(int(h) * pow(BASE, k + 1, 1 << 64) for k, h in enumerate(hashes[i : i + n])) % (1 << 64)
            for i in range(len(hashes) - n + 1)
        ]
        assert ngrams(hashes, n).tolist() == mix(np.array(plain, np.uint64)).tolist()
    for n in (61, 100):
        assert len(ngrams(hashes, n)) == 0
    assert len(ngrams(hashes[:0], 1)) == 0
    Counted.times = 0
    ngrams(hashes.view(Counted), 20)
    assert Counted.times < 12


def test_words_are_hashed_when_asked():
    words = Words([b"a b", b"", b"b a b"], False)
    assert words.counts().tolist() == [2, 0, 3]
    assert "hashes" not in vars(words)
    a, b = words.hashes[:2]
    assert words.hashes.tolist() == [a, b, b, a, b]
