"""The prefix trie of conversations, found by digests of blocks of several turns.

Each conversation gets the digest of its prefix at every turn. Conversations are
grouped by blocks of ``BLOCK`` turns first: a block is known by the prefix before it
and by its own turns, so equal prefixes meet as long as they agree block by block.
Only where different blocks follow the same prefix are these cut into turns and
grouped turn by turn. What is left are segments: runs of nodes without a branch.

A node is named by its smallest member. Nodes named alike form one path downwards,
so a subtree is the rest of a path and the paths that hang from it: paths are summed
up by doubling pointers, in rounds by the logarithm of how deep paths hang, and the
rest of a path by running sums.

Rows without conv_id belong to no conversation and are left out. Turns of equal
number are ordered by the SHA-256 of their role's length, role and text. Prefixes are
compared by 128-bit digests. An empty table has no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.llm.common import cut, emit, table
from wardstar.llm.running import running
from wardstar.llm.words import BASE

#: Turns of a block.
BLOCK = 4
#: Conversations whose numbers share the hundreds take their first turns, fewer than
#: six, from the one that ends in 00.
FAMILY, SHARED = 100, 6
#: Conversations that end at a node are listed in stretches of 2^9 numbers.
STRETCH_BITS = 9
NODE = ["start", "q1", "q2"]
#: What follows one prefix is dealt out to so many parts.
SALTS = 32
NO_ENDS = hashlib.sha256(b"").hexdigest()


def turns(conversations: DataFrame) -> DataFrame:
    """Turns without their texts: conv, turn, a digest and the code points of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    length = F.octet_length(role).cast("string")
    digest = F.unhex(F.sha2(F.concat(length, F.lit(":"), role, text), 256))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        digest.alias("digest"),
        F.char_length(text).cast("long").alias("chars"),
    )


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of the rebuilt conversations by number, and all conversations."""
    numbered = running(turns(conversations), "conv", [F.col("turn"), F.col("digest")], [], name="trie-turns")
    taken = F.crc32(F.col("conv").cast("string")) % SHARED
    convs = cut(numbered.groupBy("conv").agg(F.lit(1).alias("one")).select("conv"), "trie-convs")
    heads = (
        numbered.where((F.col("conv") % FAMILY == 0) & (F.col("place") < SHARED - 1))
        .groupBy(F.col("conv").alias("family"))
        .agg(F.sort_array(F.collect_list(F.struct("place", "digest", "chars"))).alias("head"))
    )
    first = (
        convs.withColumn("family", F.expr(f"conv - conv % {FAMILY}"))
        .join(heads, "family")
        .select("conv", F.explode("head").alias("t"))
        .select("conv", "t.*")
        .where(F.col("place") < taken)
    )
    own = numbered.where(F.col("place") >= taken).select(first.columns)
    return own.unionByName(first).withColumnRenamed("place", "number"), convs


def prefixes(rows: DataFrame) -> DataFrame:
    """Each turn with the digests of the prefix before it (q1, q2) and with it (p1, p2)."""
    lanes = rows.select(
        "conv", "number", "chars",
        F.xxhash64("digest").alias("d1"), F.xxhash64("digest", F.lit("second lane")).alias("d2"),
    )
    found = running(lanes, "conv", [F.col("number")], ["d1", "d2"], BASE, name="trie-prefixes")
    return found.selectExpr(
        "conv", "place", "chars", "d1_before as q1", "d2_before as q2", "d1_sum as p1", "d2_sum as p2"
    )


def segments(steps: DataFrame, block: int = BLOCK) -> DataFrame:
    """Runs of nodes without a branch: the prefix before, the turns, members, smallest one.

    ``start`` is the depth of the prefix before. A block with no other after the same
    prefix is one segment; blocks that diverge are cut into turns and merged again.
    """
    step = F.struct("p1", "p2", "chars")
    blocks = steps.groupBy("conv", F.expr(f"place div {block}").alias("b")).agg(
        F.sort_array(F.collect_list(F.struct("place", "q1", "q2", step.alias("step")))).alias("turns")
    )
    first = F.col("turns")[0]
    grouped = cut(
        blocks.select(
            "conv", first["place"].alias("start"), first["q1"].alias("q1"), first["q2"].alias("q2"),
            F.col("turns.step").alias("steps"),
        )
        .groupBy(*NODE, "steps")
        .agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("m")),
        "trie-blocks",
    )
    salted = _salted(grouped, "steps")
    siblings = _followers(salted, "siblings").select(*NODE, "siblings", F.explode("salts").alias("salt"))
    told = salted.join(siblings, [*NODE, "salt"]).drop("salt")
    alone = told.where("siblings = 1").drop("siblings")
    cut_up = told.where("siblings > 1").select(
        "n", "m", "q1", "q2", "steps", F.col("start").alias("top"), F.posexplode("steps").alias("k", "step")
    )
    refined = (
        cut_up.select(
            (F.col("top") + F.col("k")).alias("start"),
            F.expr("if(k = 0, q1, steps[k - 1].p1)").alias("q1"),
            F.expr("if(k = 0, q2, steps[k - 1].p2)").alias("q2"),
            F.array("step").alias("steps"),
            "n",
            "m",
        )
        .groupBy(*NODE, "steps")
        .agg(F.sum("n").alias("n"), F.min("m").alias("m"))
    )
    return cut(
        alone.unionByName(refined)
        .withColumn("e1", F.expr("element_at(steps, -1).p1"))
        .withColumn("e2", F.expr("element_at(steps, -1).p2"))
        .withColumn("stop", F.col("start") + F.size("steps"))
        .withColumn("chars", F.expr("aggregate(steps, 0L, (s, t) -> s + t.chars)")),
        "trie-segments",
    )


def _salted(rows: DataFrame, *columns: str) -> DataFrame:
    """A part number for each row, so that what follows a common prefix is not one group."""
    return rows.withColumn("salt", F.pmod(F.xxhash64(*columns), F.lit(SALTS)))


def _followers(salted: DataFrame, name: str) -> DataFrame:
    """By node, how many rows follow it and the parts they are in.

    Counted by part first, so that no step meets more than ``SALTS`` rows of a node.
    """
    return (
        salted.groupBy(*NODE, "salt")
        .agg(F.count(F.lit(1)).alias("k"))
        .groupBy(*NODE)
        .agg(F.sum("k").alias(name), F.collect_list("salt").alias("salts"))
    )


def _at_end(columns: list[str]) -> list:
    """The columns of a table by node, renamed so that they meet segments at their end."""
    return [F.col(a).alias(b) for a, b in zip(NODE, ("stop", "e1", "e2"), strict=True)] + columns


def linked(found: DataFrame, top: int) -> DataFrame:
    """Segments with the children of their last node and the name of the node before them."""
    salted = _salted(found, "e1", "e2")
    children = cut(_followers(salted, "n_children"), "trie-children")
    before = found.select(
        F.col("stop").alias("start"), F.col("e1").alias("q1"), F.col("e2").alias("q2"), F.col("m").alias("parent")
    )
    parents = children.join(before, NODE, "left").select(*NODE, "parent", F.explode("salts").alias("salt"))
    return cut(
        salted.join(children.select(*_at_end(["n_children"])), ["stop", "e1", "e2"], "left")
        .join(parents, [*NODE, "salt"], "left")
        .drop("salt")
        .withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        .withColumn("parent", F.coalesce("parent", F.lit(top)))
        .withColumn("leaves", F.expr("if(n_children = 0, 1L, 0L)"))
        .withColumn("saved", F.expr("(n - 1) * chars")),
        "trie-links",
    )


def hanging(links: DataFrame, top: int) -> DataFrame:
    """By node, the leaves and saved code points in the paths that hang from it.

    A path's own sums grow by those of the paths whose pointer names it, while every
    pointer moves to where the path it names points. Pointers to the path of the root
    are empty from the start, because nothing asks for that path's sum.
    """
    paths = links.groupBy("m").agg(
        F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"),
        F.min(F.struct("start", "parent", "q1", "q2")).alias("head"),
    )
    paths = cut(paths.where(F.col("m") != top).select("m", "leaves", "saved", "head.*"), "trie-paths")
    pointer = F.when(F.col("parent") != top, F.col("parent")).alias("pointer")
    sums = paths.select("m", "leaves", "saved", pointer)
    while not (pointing := sums.where("pointer is not null")).isEmpty():
        added = pointing.groupBy(F.col("pointer").alias("m")).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        onwards = sums.select(F.col("m").alias("pointer"), F.col("pointer").alias("onward"))
        sums = cut(
            sums.join(added, "m", "left")
            .join(onwards, "pointer", "left")
            .select(
                "m",
                (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
                F.col("onward").alias("pointer"),
            ),
            "trie-sums",
        )
    return (
        paths.drop("leaves", "saved")
        .join(sums, "m")
        .groupBy(*NODE)
        .agg(F.sum("leaves").alias("hung_leaves"), F.sum("saved").alias("hung_saved"))
    )


def ends(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """By node, the digest of the numbers of the conversations that end there.

    The numbers are joined to stretches of bounded length first, which then pass
    through the digest one by one, in order.
    """
    last = steps.groupBy("conv").agg(F.max(F.struct("place", "p1", "p2")).alias("last"))
    stretches = (
        convs.join(last, "conv", "left")
        .select(
            "conv",
            F.coalesce(F.col("last.place") + 1, F.lit(0)).alias("start"),
            F.coalesce("last.p1", F.lit(0)).alias("q1"),
            F.coalesce("last.p2", F.lit(0)).alias("q2"),
            F.shiftright("conv", STRETCH_BITS).alias("stretch"),
        )
        .groupBy(*NODE, "stretch")
        .agg(F.sort_array(F.collect_list("conv")).alias("convs"))
        .select(*NODE, "stretch", F.array_join(F.col("convs").cast("array<string>"), ",").alias("line"))
    )
    schema = pa.schema([(c, pa.int64()) for c in NODE] + [("ends_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state = None, None
        for batch in batches:
            done: list[tuple] = []
            nodes = zip(*(batch.column(c).to_pylist() for c in NODE), strict=True)
            for here, line in zip(nodes, batch.column("line").to_pylist(), strict=True):
                if here == node:
                    state.update(b"," + line.encode())
                    continue
                if state:
                    done.append((*node, state.hexdigest()))
                node, state = here, hashlib.sha256(line.encode())
            yield emit(schema, **_columns(schema, done))
        if state:
            yield emit(schema, **_columns(schema, [(*node, state.hexdigest())]))

    dealt = stretches.repartition(*NODE).sortWithinPartitions(*NODE, "stretch")
    return dealt.mapInArrow(digest, "start long, q1 long, q2 long, ends_sha256 string")


def _columns(schema: pa.Schema, rows: list[tuple]) -> dict:
    return {f.name: [row[k] for row in rows] for k, f in enumerate(schema)}


def trie(conversations: DataFrame) -> DataFrame:
    """One row for each node, with its figures (see the module) and the digest of its ends."""
    rows, convs = rebuilt(conversations)
    top = convs.agg(F.min("conv").alias("top"), F.count("conv").alias("n")).first()
    steps = prefixes(rows)
    found = segments(steps)
    links = linked(found, top.top or 0)
    hung = hanging(links, top.top or 0)
    weighed = links.join(hung.select(*_at_end(["hung_leaves", "hung_saved"])), ["stop", "e1", "e2"], "left")
    weighed = weighed.withColumn("leaves", F.expr("leaves + coalesce(hung_leaves, 0L)")).withColumn(
        "saved", F.expr("saved + coalesce(hung_saved, 0L)")
    )
    summed = running(
        weighed.drop("hung_leaves", "hung_saved").withColumn("from_below", -F.col("start")),
        "m", [F.col("from_below")], ["leaves", "saved"], name="trie-subtrees",
    )
    listed = cut(ends(steps, convs), "trie-ends")
    below = (
        summed.join(listed.select(*_at_end(["ends_sha256"])), ["stop", "e1", "e2"], "left")
        .select("*", F.posexplode("steps").alias("k", "step"))
        .selectExpr(
            "m as conv_id",
            "start + k + 1 as depth",
            "if(k = 0, parent, m) as parent_conv_id",
            "n as n_convs",
            "if(k + 1 = size(steps), n_children, 1L) as n_children",
            "leaves_sum as n_leaves",
            "saved_sum - (n - 1) * aggregate(slice(steps, 1, k), 0L, (s, t) -> s + t.chars) as saved_tokens",
            f"if(k + 1 = size(steps), coalesce(ends_sha256, '{NO_ENDS}'), '{NO_ENDS}') as ends_sha256",
        )
    )
    at_root = listed.where("start = 0").first()
    root = (
        links.agg(
            F.sum("leaves").alias("leaves"),
            F.sum("saved").alias("saved"),
            F.count_if(F.expr("start = 0")).alias("n_children"),
        )
        .select(
            F.lit(top.top).cast("long").alias("conv_id"),
            F.lit(0).cast("long").alias("depth"),
            F.lit(None).cast("long").alias("parent_conv_id"),
            F.lit(top.n).cast("long").alias("n_convs"),
            "n_children",
            F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
            F.coalesce("saved", F.lit(0)).alias("saved_tokens"),
            F.lit(at_root.ends_sha256 if at_root else NO_ENDS).alias("ends_sha256"),
        )
        .where("n_convs > 0")
    )
    return below.withColumn("depth", F.col("depth").cast("long")).unionByName(root)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie(table(spark, sf_dir, "conversations"))
