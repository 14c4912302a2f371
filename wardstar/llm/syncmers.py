"""Document fingerprints from closed syncmers, in DataFrame functions only.

A run of K words is an anchor if the least of its inner runs of S words lies at
either edge. Whether it is depends on nothing around it, so an edit elsewhere
leaves the anchor, and anchors keep their places. A fingerprint holds every anchor
of the text as often as it occurs, each with its place in words, so it grows with
the text. Two texts are compared by position: anchors match where the neighbouring
anchor matches too at the same difference of places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardstar.llm.common import ROW_BITS, in_order, table

K, S = 4, 2
#: Anchors of a sketch, for callers that want a text's least anchors only.
SIZE = 64
SPACES = r"[\x20\x09-\x0D]+"


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def anchors(text: Column, k: int = K, s: int = S, size: int | None = SIZE) -> Column:
    """The anchors of a text as an array of (hash, place).

    Without a ``size`` every occurrence of every anchor, by place; else that many
    least hashes, sorted, each with its first place. A text without an anchor, such
    as one of fewer than ``k`` words, is one anchor as a whole, and one without words
    has none.
    """
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), SPACES), "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def after(values: Column, n: int) -> Column:
        return F.slice(values, n + 1, F.size(values))

    def joined(values: Column, offsets: list[int]) -> Column:
        """For each place a hash of the values there and at the offsets."""
        out = values
        for n in offsets:
            out = F.zip_with(out, after(values, n), lambda a, b: F.xxhash64(a, b))
        return out

    def closed(inner: Column, i: Column) -> Column:
        """Whether no run in between is less than both runs at the edges of place i."""
        first, last = F.get(inner, i), F.get(inner, i + (k - s))
        between = [F.get(inner, i + j) for j in range(1, k - s)]
        if not between:
            return F.lit(True)
        least = between[0] if len(between) == 1 else F.least(*between)
        return (first <= least) | (last <= least)

    def chosen(h: Column) -> Column:
        places = F.size(h) - k + 1
        # Runs of s words at these offsets make up a run of k words.
        offsets = sorted({*range(s, k - s, s), k - s} - {0})
        found = let(
            joined(h, list(range(1, s))),
            lambda inner: F.transform(
                F.slice(joined(inner, offsets), 1, places),
                lambda run, i: F.when(closed(inner, i), run),
            ),
        )
        short = F.array(F.struct(F.xxhash64(h).alias("hash"), F.lit(0).alias("place")))
        return (
            F.when(F.size(h) >= k, let(found, lambda f: (least_of if size else all_of)(f, short)))
            .when(F.size(h) > 0, short)
            .otherwise(F.filter(short, lambda a: F.lit(False)))
        )

    def all_of(found: Column, short: Column) -> Column:
        """Every hash with its place; null is no anchor."""
        placed = F.transform(found, lambda run, i: F.struct(run.alias("hash"), i.alias("place")))
        kept = F.filter(placed, lambda a: a["hash"].isNotNull())
        return let(kept, lambda r: F.when(F.size(r) > 0, r).otherwise(short))

    def least_of(found: Column, short: Column) -> Column:
        """The least ``size`` hashes with their first places; null is no anchor."""
        ranked = F.slice(F.sort_array(F.array_distinct(F.array_compact(found))), 1, size)
        return let(
            ranked,
            lambda r: F.when(
                F.size(r) > 0,
                F.transform(
                    r,
                    lambda run: F.struct(
                        run.alias("hash"),
                        (F.array_position(found, run) - 1).cast("int").alias("place"),
                    ),
                ),
            ).otherwise(short),
        )

    return let(hashes, chosen)


def fingerprint(found: Column) -> Column:
    """The anchors as text: hash in hexadecimal, colon, place; separated by spaces."""
    return F.array_join(
        F.transform(found, lambda a: F.concat(F.hex(a["hash"]), F.lit(":"), a["place"])), " "
    )


def numbered(values: Column) -> Column:
    """Hashes that are all different: of equal ones each later one is hashed with its number."""

    def apart(ordered: Column) -> Column:
        # The place where a run of equal values begins is the greatest beginning so far,
        # found over twice as many places in each round.
        begins = F.transform(
            ordered,
            lambda v, i: F.when(v == F.get(ordered, i - 1), F.lit(0)).otherwise(i),
        )
        widths = F.filter(F.array(*[F.lit(1 << n) for n in range(31)]), lambda w: w < F.size(ordered))
        begins = F.aggregate(
            widths,
            begins,
            lambda found, w: F.transform(found, lambda v, i: F.greatest(v, F.get(found, i - w))),
        )
        return F.zip_with(
            ordered,
            F.transform(begins, lambda v, i: i - v),
            lambda v, n: F.when(n > 0, F.xxhash64(v, n)).otherwise(v),
        )

    return F.when(F.size(F.array_distinct(values)) == F.size(values), values).otherwise(
        let(F.sort_array(values), apart)
    )


def links(found: Column) -> Column:
    """A hash of each two neighbouring anchors and the difference of their places.

    Equal ones are numbered. A single anchor is a link of its own.
    """

    def linked(f: Column) -> Column:
        pairs = F.zip_with(
            F.slice(f, 1, F.greatest(F.size(f) - 1, F.lit(0))),
            F.slice(f, 2, F.size(f)),
            lambda a, b: F.xxhash64(a["hash"], b["hash"], b["place"] - a["place"]),
        )
        return F.when(F.size(f) > 1, let(pairs, numbered)).otherwise(
            F.transform(f, lambda a: a["hash"])
        )

    return let(found, linked)


def likeness(a: Column, b: Column) -> Column:
    """Of the links of both texts together, the share that both hold (0 to 1).

    A link is in both where two neighbouring anchors of one text are neighbours in
    the other at the same distance, so both matches have one difference of places.
    Counted with repetitions over all links; 1 where neither text has any.
    """
    return let(
        F.size(F.array_intersect(a, b)),
        lambda both: F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(
            both / (F.size(a) + F.size(b) - both)
        ),
    )


def with_next(docs: DataFrame) -> DataFrame:
    """For each distinct row its key and those of the row before it by doc_id.

    Returns key, before (the key of the row before; the last for the first) and
    ``wanted``, a quarter of the characters of the row before. Rows repeated whole
    count once. Only keys and lengths move, no text.
    """
    keys = docs.select("doc_id", "key", "n_chars").distinct()
    rows = in_order(keys, "doc_id", "key", name="document-order")
    rows = rows.withColumn("part", F.shiftright("at", ROW_BITS))
    row = F.struct("key", F.floor(F.col("n_chars") / 4).cast("int").alias("wanted"))
    # One row for each partition.
    lasts = rows.groupBy("part").agg(F.max_by(row, "at").alias("last"))
    parts = Window.orderBy("part")
    everywhere = parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lasts = lasts.select(
        "part",
        F.coalesce(F.lag("last").over(parts), F.last("last").over(everywhere)).alias("edge"),
    )
    inside = F.lag(row).over(Window.partitionBy("part").orderBy("at"))
    rows = rows.withColumn("inside", inside).join(lasts, "part")
    before = F.coalesce("inside", "edge")
    return rows.select(
        "key", before["key"].alias("before"), before["wanted"].alias("wanted")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``docs`` (doc_id, text) and of each text edited with the next.

    The edited text ends, in place of its last quarter of code points, with as many
    of the next document's by doc_id (rows of one doc_id by a hash of the text,
    null first; after the last comes the first). A null text is empty. Fingerprints
    hold every anchor, and near_edited and near_next count all links. Returns
    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next and next_doc_id; an empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    n_chars = F.char_length("text").cast("long")
    # Both joins take these three columns, so that one exchange of the texts serves both.
    # The next text moves as it is: its links would be longer than it.
    rows = docs.select(
        "doc_id",
        text.alias("text"),
        F.xxhash64(F.col("doc_id").isNull(), "doc_id", text).alias("key"),
    )
    placed = rows.join(with_next(rows.withColumn("n_chars", n_chars)), "key")
    following = placed.dropDuplicates(["key"]).select(
        F.col("before").alias("key"),
        F.col("doc_id").alias("next_doc_id"),
        F.col("text").alias("next_text"),
        "wanted",
    )
    both = rows.join(following, "key").withColumn("n_chars", n_chars)
    cut_at = (F.col("n_chars") - F.floor(F.col("n_chars") / 4)).cast("int")
    both = both.withColumn(
        "edited", F.concat(F.left("text", cut_at), F.left("next_text", F.col("wanted")))
    )
    both = both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        anchors(F.col("text"), size=None).alias("own"),
        anchors(F.col("edited"), size=None).alias("other"),
        links(anchors(F.col("next_text"), size=None)).alias("next_links"),
        "next_doc_id",
    )
    both = both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"),
        links(F.col("own")).alias("own_links"),
        links(F.col("other")).alias("other_links"),
        "next_links",
        "next_doc_id",
    )
    return both.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("own_links"), F.col("other_links")).alias("near_edited"),
        likeness(F.col("own_links"), F.col("next_links")).alias("near_next"),
        "next_doc_id",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
