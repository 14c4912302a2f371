"""Items of every length, edited as much as is allowed, are all found."""

from __future__ import annotations

import random

from wardstar.llm import decontamination


def edited(rng: random.Random, words: list[str], places: list[int], kinds: str) -> list[str]:
    out = list(words)
    for at in sorted(places, reverse=True):
        kind = rng.choice(kinds)
        if kind == "s":
            out[at] = f"s{rng.randrange(10**12)}"
        elif kind == "d":
            del out[at]
        else:
            out.insert(at, f"i{rng.randrange(10**12)}")
    return out


def test_every_length_at_the_full_edit_allowance(spark):
    rng = random.Random(20)
    items, docs, expected = [], [], {}
    for n in range(5, 61):
        allowed = int(decontamination.EDITS * n)
        for layout in ("even", "random", "mixed"):
            item = len(items)
            words = [f"w{item}x{k}" for k in range(n)]
            items.append((item, " ".join(words)))
            even = [k * n // allowed + n // allowed // 2 for k in range(allowed)]
            places = even if layout == "even" else rng.sample(range(n), allowed)
            text = edited(rng, words, places, "sdi" if layout == "mixed" else "s")
            around = [[f"a{item}s{side}x{k}" for k in range(25)] for side in (0, 1)]
            docs.append((item, " ".join([*around[0], *text, *around[1]])))
            expected[item] = n
    found = decontamination.matches(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    ).collect()
    missed = set(expected) - {r["doc_id"] for r in found}
    assert not missed, sorted(expected[k] for k in missed)
    assert all(r["doc_id"] == r["item_id"] for r in found)
    assert all(r["distance"] <= int(decontamination.EDITS * r["item_words"]) for r in found)
