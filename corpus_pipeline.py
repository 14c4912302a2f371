"""From raw documents to packed sequences: five stages, each written and read again.

Toxic documents go, one document of each near-duplicate group stays, repeated
passages are cut out, documents that hold benchmark passages go, and the rest is
packed. Each stage decides on all that the one before it kept.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.llm import decontamination, minhash, packing, substrings, toxicity
from wardstar.llm.common import cut, table
from wardstar.llm.tokens import default_path

#: No SQL expresses the trained score of the first stage.
ORACLE_SQL = None


def _carried(docs: DataFrame) -> DataFrame:
    """What a stage reads, and all columns as one, so that no name of theirs meets a stage's."""
    return docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below 0.7 by a model of the labelled ones that are not held out.

    Null and empty texts score as clean.
    """
    model = toxicity.fitted(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(_carried(docs), model).where("score < 0.7").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group.

    Null, empty and wordless texts, and rows without doc_id, stay.
    """
    found = minhash.near_duplicates(docs)
    return docs.join(found.where("not kept").select("doc_id"), "doc_id", "left_anti").select(
        *docs.columns
    )


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that came before; those that had nothing else go.

    n_chars follows the text; untouched rows stay as they are.
    """
    kept = substrings.remove_repeats(_carried(docs)).where("n_removed = 0 or n_removed < n_words")
    own = {c: F.col("_row")[c] for c in docs.columns}
    own["text"] = F.col("text")
    if "n_chars" in own:
        changed = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
        own["n_chars"] = F.coalesce(changed, own["n_chars"])
    return kept.select(*(value.alias(name) for name, value in own.items()))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage; rows without doc_id stay."""
    found = decontamination.matches(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(
        *docs.columns
    )


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents placed in sequences of at most 1024 tokens."""
    return packing.pack(docs, default_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeats),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
