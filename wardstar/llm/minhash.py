"""Near-duplicates by fast similarity sketching, banding and exact verification.

A sketch has COORDINATES bins. In each round every shingle falls into one hashed
bin with a value that grows with the round; in the later rounds into a fixed bin
each, so every coordinate is filled whatever the size of the set. Bands of equal
coordinates give candidates; links are confirmed on the full shingle sets.

No bucket is expanded into pairs. Documents with equal sets are one class. Each
class is first compared with one representative of its buckets, and only where a
bucket still holds several components are more pairs compared.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardstar.llm.common import cut, emit, table, texts
from wardstar.llm.words import Words, mix, ngrams

SHINGLE = 5
#: A pair at similarity 0.75 shares no band with probability (1 - 0.75^4)^32 < 0.00001.
COORDINATES, BAND_ROWS = 128, 4
BANDS = COORDINATES // BAND_ROWS
#: Of the lowest bits of two sketches' coordinates, a pair at 0.75 differs in 16 on
#: average with deviation 3.7; pairs that differ in more than this are no links.
MOST_BITS = 35
#: Rounds in which a class meets the best of its buckets' representatives, before
#: every pair that may still be a link is compared.
ROUNDS = 3
#: Rows of links or labels that one task writes: numbers, so a part of fewer is mostly start-up.
LABELLED = 1 << 17
#: Classes outside the largest components, and members, that one cell compares.
BLOCK, MEMBERS = 64, 512
_SEEDS = mix(np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BAND_SEEDS = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingle_set(hashes: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """The sorted set of hashes of n words in a row; of fewer words, one of them all."""
    if len(hashes) < n:
        return ngrams(hashes, len(hashes)) if len(hashes) else hashes
    return np.unique(ngrams(hashes, n))


def sketch(shingles: np.ndarray) -> np.ndarray:
    """COORDINATES minima, every one filled."""
    out = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for turn in range(2 * COORDINATES):
        value = mix(shingles ^ _SEEDS[turn])
        low = (value >> np.uint64(8)) | (np.uint64(turn) << np.uint64(56))
        if turn < COORDINATES:
            np.minimum.at(out, (value % np.uint64(COORDINATES)).astype(np.int64), low)
        else:
            k = turn - COORDINATES
            out[k] = min(out[k], low.min())
        if out.max() < np.iinfo(np.uint64).max:
            break
    return out


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    rows = coordinates.reshape(BANDS, BAND_ROWS)
    total = _BAND_SEEDS.copy()
    for k in range(BAND_ROWS):
        total = mix(total + rows[:, k])
    return total


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, n (set size), digest of the set, bands and low bits of its sketch."""
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()),
        ("bands", pa.list_(pa.int64())), ("bits0", pa.int64()), ("bits1", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            words = Words(found, True)
            rows: dict[str, list] = {n: [] for n in schema.names}
            rows["doc_id"] = batch.column("doc_id").to_pylist()
            for first, last in zip(words.first[:-1], words.first[1:], strict=True):
                shingles = shingle_set(words.hashes[first:last])
                rows["n"].append(len(shingles))
                if not len(shingles):
                    for name in ("digest", "bands", "bits0", "bits1"):
                        rows[name].append(None)
                    continue
                coordinates = sketch(shingles)
                bits = np.packbits((coordinates & np.uint64(1)).astype(np.uint8)).view(np.int64)
                rows["digest"].append(xxhash.xxh3_128_digest(shingles.tobytes()))
                rows["bands"].append(band_keys(coordinates).view(np.int64))
                rows["bits0"].append(int(bits[0]))
                rows["bits1"].append(int(bits[1]))
            yield emit(schema, **rows)

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n long, digest binary, bands array<long>, bits0 long, bits1 long"
    )


def verified(edges: DataFrame, held: DataFrame) -> DataFrame:
    """The edges (a, b) whose sets share 75 % or more of their union.

    ``held`` has doc_id and text of every class named; the sets are built anew from
    whole texts where the two meet.
    """
    pairs = edges.join(held.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    pairs = pairs.join(held.select(F.col("doc_id").alias("b"), "text"), "b")
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            kept, known = [], {}
            left, right = batch.column("text_a"), batch.column("text")
            for i, pair in enumerate(zip(a, b, strict=True)):
                sets = []
                for doc, column in zip(pair, (left, right), strict=True):
                    if doc not in known:
                        if len(known) > 64:
                            known.clear()
                        raw = (column[i].as_py() or "").encode()
                        known[doc] = shingle_set(Words([raw], True).hashes)
                    sets.append(known[doc])
                both = len(np.intersect1d(*sets, assume_unique=True))
                if 100 * both >= 75 * (len(sets[0]) + len(sets[1]) - both):
                    kept.append(pair)
            if kept:
                yield emit(schema, a=[p[0] for p in kept], b=[p[1] for p in kept])

    return pairs.select("a", "b", "text_a", "text").mapInArrow(run, "a long, b long")


def parts(rows: int) -> int:
    """How many tasks write so many rows of numbers; the shuffle before may deal to more."""
    return max(1, -(-rows // LABELLED))


def components(links: DataFrame, most: int) -> DataFrame:
    """node and component (the smallest node reachable) for the nodes of links (a, b).

    Every round each node takes the least label among itself and its neighbours,
    then the label of its label, so long chains fold quickly. ``most`` bounds the links:
    rounds are many and their tables may be small, so they are written in as few parts.
    """
    tasks = parts(2 * most)
    both = links.select(F.col("a").alias("node"), F.col("b").alias("next")).union(
        links.select(F.col("b").alias("node"), F.col("a").alias("next"))
    )
    both = cut(both.distinct().coalesce(tasks), "links")
    labels = both.groupBy("node").agg(F.min("next").alias("next"))
    labels = labels.select("node", F.least("node", "next").alias("component"))
    labels = cut(labels.coalesce(tasks), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "next"), "next")
        least = near.groupBy("node").agg(F.min("component").alias("least"))
        step = labels.join(least, "node").select(
            "node", "component", F.least("component", "least").alias("new")
        )
        target = labels.select(
            F.col("node").alias("new"), F.col("component").alias("further")
        )
        step = step.join(target, "new").select(
            "node", "component", F.least("new", "further").alias("new")
        )
        step = cut(step.coalesce(tasks), "labels")
        moved = step.where("new <> component").limit(1).count()
        labels = step.select("node", F.col("new").alias("component"))
        if not moved:
            return labels


def _relabelled(labels: DataFrame, links: DataFrame, nodes: int) -> DataFrame:
    """The labels (node, component) of so many nodes after joining components by further links."""
    side = {
        x: labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab"
    }
    between = links.join(side["a"], "a").join(side["b"], "b").where("ca <> cb")
    between = between.select(F.col("ca").alias("a"), F.col("cb").alias("b"))
    merged = components(between, links.count())
    merged = merged.select(F.col("node").alias("component"), F.col("component").alias("merged"))
    joined = labels.join(merged, "component", "left")
    joined = joined.select("node", F.coalesce("merged", "component").alias("component"))
    return cut(joined.coalesce(parts(nodes)), "labels")


def shared_sizes(held: DataFrame) -> DataFrame:
    """node, n (set size) and shared (shingles that another class of ``held`` has too).

    A link lies in the shared shingles, so a class with few of them has none, and
    two classes overlap at most in the smaller number of shared ones.
    """
    schema = pa.schema([("node", pa.int64()), ("shingle", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in texts(batches):
            words = Words(found, True)
            ids = batch.column("doc_id").to_numpy()
            sets = [
                shingle_set(words.hashes[first:last])
                for first, last in zip(words.first[:-1], words.first[1:], strict=True)
            ]
            nodes = np.repeat(ids, [len(s) for s in sets])
            yield emit(schema, node=nodes, shingle=np.concatenate(sets).view(np.int64))

    rows = held.mapInArrow(run, "node long, shingle long")
    own = rows.groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("last"))
    own = own.where("node = last").groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    return own


def may_link(x: str, y: str) -> F.Column:
    """Whether sizes, shared shingles and low bits of two classes allow a link."""
    return (
        F.expr(f"7 * least({x}.shared, {y}.shared) >= 3 * ({x}.n + {y}.n)")
        & F.expr(f"4 * least({x}.n, {y}.n) >= 3 * greatest({x}.n, {y}.n)")
        & (_differing(x, y) <= MOST_BITS)
    )


def _differing(x: str, y: str) -> F.Column:
    return F.expr(
        f"bit_count({x}.bits0 ^ {y}.bits0) + bit_count({x}.bits1 ^ {y}.bits1)"
    )


def link_classes(reps: DataFrame, docs: DataFrame) -> DataFrame:
    """node and component of the classes (doc_id, n, bands, bits) with candidates.

    A class without candidates may be missing from the result.
    """
    members = reps.select(F.col("doc_id").alias("node"), F.explode("bands").alias("band"))
    # Counts move, not members: a bucket of many classes is a row for each task.
    several = members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = cut(members.join(several.select("band"), "band"), "buckets")
    nodes = buckets.select(F.col("node").alias("doc_id")).distinct()
    held = docs.join(nodes, "doc_id", "left_semi")
    held = cut(held.groupBy("doc_id").agg(F.min("text").alias("text")), "candidates")
    own = shared_sizes(held)
    sizes = reps.join(nodes, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    sizes = sizes.withColumnRenamed("doc_id", "node").join(own, "node", "left")
    sizes = sizes.withColumn("shared", F.col("n") - F.coalesce("own", F.lit(0)))
    # A link covers three quarters of either set.
    one = F.struct("node", "n", "shared", "bits0", "bits1").alias("one")
    sizes = cut(sizes.where("4 * shared >= 3 * n").select("node", one), "sizes")
    buckets = cut(buckets.join(sizes, "node"), "buckets")
    labels = sizes.select("node", F.col("node").alias("component"))
    total = sizes.count()
    for turn in range(ROUNDS + 1):
        named = buckets.join(labels, "node")
        pick = F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("turn"), "one")).alias("pick")
        parts = named.groupBy("band", "component").agg(F.count(F.lit(1)).alias("m"), pick)
        open_bands = parts.groupBy("band").agg(
            F.max(F.struct("m", "component", "pick")).alias("main"),
            ((F.sum("m") * F.sum("m") - F.sum(F.col("m") * F.col("m"))) / 2).alias("pairs"),
        )
        open_bands = cut(open_bands.where("pairs > 0"), "open-buckets")
        pending = open_bands.agg(F.sum("pairs")).first()[0] or 0
        if not pending:
            break
        last = pending <= BLOCK * total or turn == ROUNDS
        if last:
            links = links_in_blocks(named, open_bands, held)
        else:
            links = verified(_best_of_mains(named, open_bands), held)
        links = cut(links, "links")
        labels = _relabelled(labels, links, total)
        if last:
            break
    return labels


def _pair(x: str, y: str) -> list[F.Column]:
    nodes = (F.col(f"{x}.node"), F.col(f"{y}.node"))
    return [F.least(*nodes).alias("a"), F.greatest(*nodes).alias("b")]


def _best_of_mains(named: DataFrame, open_bands: DataFrame) -> DataFrame:
    """For each class outside the largest component of a bucket, one pair.

    Of the representatives that the largest components of its buckets show this
    round, the one whose sketch is nearest.
    """
    outside = named.join(open_bands.select("band", "main"), "band")
    outside = outside.where("component <> main.component").select(
        "node", "one", F.col("main.pick.one").alias("other")
    )
    outside = outside.where(may_link("one", "other"))
    nearest = F.min(F.struct(_differing("one", "other").alias("bits"), "other", "one"))
    outside = outside.groupBy("node").agg(nearest.alias("nearest"))
    return outside.select(*_pair("nearest.one", "nearest.other"))


def links_in_blocks(named: DataFrame, open_bands: DataFrame, held: DataFrame) -> DataFrame:
    """Every link between components that an open bucket holds.

    For each largest component the classes beside it in some bucket are a query set,
    dealt to blocks, and all classes of those buckets are dealt to chunks; a task
    compares one block with one chunk and returns links only. So no group is met
    whole in a task, and no pair is a row.
    """
    mains = open_bands.select("band", F.col("main.component").alias("main"))
    rows = named.join(mains, "band").select("main", "node", "one", "component").distinct()
    rows = rows.join(held.withColumnRenamed("doc_id", "node"), "node")
    rows = cut(rows, "unsettled")
    sizes = rows.groupBy("main").agg(
        F.ceil(F.count_if(F.col("component") != F.col("main")) / BLOCK).cast("int").alias("blocks"),
        F.ceil(F.count(F.lit(1)) / MEMBERS).cast("int").alias("chunks"),
    )
    rows = rows.join(sizes, "main")
    names = ["main", "block", "chunk", "node", "component", "text"]
    numbers = ["n"]
    kept = [*names, *[F.col(f"one.{c}").alias(c) for c in numbers]]
    block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    every = {c: F.explode(F.sequence(F.lit(0), F.col(f"{c}s") - 1)) for c in ("block", "chunk")}
    queries = rows.where("component <> main").withColumn("block", block)
    queries = queries.withColumn("chunk", every["chunk"]).select(*kept)
    members = rows.withColumn("chunk", chunk).withColumn("block", every["block"]).select(*kept)
    members = members.toDF(*members.columns)  # columns of their own, beside the queries'

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if left.num_rows:
            columns = [
                {c: t.column(c).to_numpy() for c in ("node", "component", *numbers)}
                for t in (left, right)
            ]
            sets = [
                [shingle_set(Words([(t or "").encode()], True).hashes) for t in x.column("text").to_pylist()]
                for x in (left, right)
            ]
            known, place = np.unique(np.concatenate(sets[0]), return_inverse=True)
            held = np.zeros((left.num_rows, len(known)), np.uint8)
            held[np.repeat(np.arange(left.num_rows), [len(s) for s in sets[0]]), place] = 1
            x, y = columns
            for k, own in enumerate(sets[1]):
                at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                both = held[:, at[known[at] == own]].sum(axis=1, dtype=np.int64)
                link = 100 * both >= 75 * (x["n"] + len(own) - both)
                for i in np.flatnonzero(link & (x["component"] != y["component"][k])):
                    found.append((int(x["node"][i]), int(y["node"][k])))
        return pa.table({
            "a": pa.array([min(p) for p in found], pa.int64()),
            "b": pa.array([max(p) for p in found], pa.int64()),
        })

    cell = ["main", "block", "chunk"]
    cells = queries.groupBy(*cell).cogroup(members.groupBy(*cell))
    return cells.applyInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """The near-duplicate component of every row of ``docs`` (doc_id, text).

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable over
    links, itself included) and kept (doc_id = component_id). Null, empty and
    wordless texts have no shingles and link with nothing. Rows of one doc_id are
    one node; if their texts differ, the first by order is compared. A row without doc_id links with nothing, has no component and is
    kept. An empty table gives no rows.
    """
    found = cut(sketches(docs), "sketches")
    keyed = found.where("n > 0 and doc_id is not null")
    # A third of all rows may be copies: they are one row per task before they move.
    classes = keyed.groupBy("digest").agg(F.min("doc_id").alias("class"))
    classes = cut(classes, "classes")
    reps = keyed.join(
        classes.select("digest", F.col("class").alias("doc_id")), ["digest", "doc_id"]
    ).dropDuplicates(["digest"])
    labels = link_classes(reps, docs)
    narrow = found.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    named = narrow.join(classes, "digest", "left")
    named = named.join(labels.select(F.col("node").alias("class"), "component"), "class", "left")
    own = F.coalesce("component", "class", "doc_id")
    result = named.select("doc_id", "n_shingles", own.alias("component_id"))
    return result.select(
        "*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
