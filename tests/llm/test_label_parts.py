"""The rounds of the near-duplicate components write tables as small as their rows ask."""

from __future__ import annotations

from wardstar.llm import minhash


def test_rounds_write_few_parts_and_find_the_components(spark, monkeypatch):
    pairs = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 140)] + [(7, 7)]
    links = spark.createDataFrame(pairs, "a long, b long")
    wrote: list[int] = []
    before = minhash.cut

    def counted(rows, name):
        out = before(rows, name)
        wrote.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(minhash, "cut", counted)
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for rows, parts in ((1 << 17, 1), (40, 3)):
            monkeypatch.setattr(minhash, "LABELLED", rows)
            wrote.clear()
            found = {r.node: r.component for r in minhash.components(links, len(pairs)).collect()}
            assert found == {k: 1 for k in range(1, 41)} | {k: 100 for k in range(100, 140)}
            assert max(wrote) <= parts + 1  # and at most one file without rows
            assert parts == 1 or max(wrote) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)
