"""Word-level BPE ids through a transducer of the corpus's frequent words, and back.

The words of the whole corpus are counted; the most frequent ones are compiled with
their ids into a minimal acyclic transducer that workers map into memory. Encoding
cuts a slice of texts into words at once, walks the distinct ones through the
transducer, and merges those it does not hold. Empty and null texts have no ids and
decode to empty text; rows with equal or null doc_id are encoded one by one; the
markers of the vocabulary inside a text become their ids, as in the library.
"""

from __future__ import annotations

import functools
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.llm.common import cut, emit, spans, table, texts, work_folder
from wardstar.llm.transducer import Transducer, compiled, mapped, save

#: Words compiled into the transducer at most; all others are merged exactly.
LEXICON = 300_000
#: Word counts are ranked by classes of about one percent.
CLASSES = 64
#: Bytes of text encoded in one step.
STEP = 4 << 20
#: Kinds of characters: white space, letter, digit, other.
SPACE, LETTER, DIGIT, OTHER = range(4)
#: Code points up to here (Latin) are cut by table; texts with others by the library.
LATIN = 0x180
KIND = np.array(
    [
        SPACE if c in (*range(9, 14), 0x20, 0x85, 0xA0)
        else {"L": LETTER, "N": DIGIT}.get(unicodedata.category(chr(c))[0], OTHER)
        for c in range(LATIN)
    ],
    np.uint8,
)
WORD_END = "</w>"


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Vocabulary:
    """The library's file: markers, exact ids of words, and the text of ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        added = self.library.get_added_tokens_decoder()
        self.markers = re.compile("|".join(f"({re.escape(t.content)})" for t in added.values()))
        self.marker_start = os.path.commonprefix([t.content for t in added.values()]).encode()
        pieces = self.library.get_vocab(with_added_tokens=True)
        names = [""] * (max(pieces.values()) + 1)
        for piece, i in pieces.items():
            names[i] = piece
        self.ends_word = np.array([n.endswith(WORD_END) or i in added for i, n in enumerate(names)])
        printed = [n.encode() + b" " for n in names]
        self.bytes = np.frombuffer(b"".join(printed), np.uint8)
        self.sizes = np.array([len(p) for p in printed])
        self.starts = np.cumsum(self.sizes) - self.sizes

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Merged ids of all words, one after the other, and where each word's begin.

        Words are cut pieces already, so a space between two keeps them apart.
        """
        if not words:
            return np.zeros(0, np.uint32), np.zeros(1, np.int64)
        [found] = self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words):
            raise ValueError(f"{len(words)} words gave ids of {len(ends)}")
        return ids, np.concatenate(([0], ends))

    def pieces(self, text: str) -> list[bytes]:
        """The words of any text, normalized, and its markers, by the library."""
        out = []
        for part in self.markers.split(text):
            if part and self.markers.fullmatch(part):
                out.append(part.encode())
            elif part:
                plain = self.library.normalizer.normalize_str(part)
                spans = self.library.pre_tokenizer.pre_tokenize_str(plain)
                out.extend(plain[a:b].encode() for _, (a, b) in spans)
        return out

    def text(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The decoded text of each run of ids: the entries with spaces between them."""
        flat = self.bytes[spans(self.starts[ids], self.sizes[ids])].tobytes()
        places = np.concatenate(([0], np.cumsum(self.sizes[ids])))
        ends = np.cumsum(sizes)
        return [
            flat[a : b - 1] if b > a else b""
            for a, b in zip(places[ends - sizes].tolist(), places[ends].tolist(), strict=True)
        ]


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Vocabulary(path)


def latin_pieces(documents: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of Latin texts, cut by table.

    Every character that is no white space belongs to a word, so the words stand
    without gaps in the bytes that remain: these bytes, where each word starts in
    them (and their end), and the number of words of each document.
    """
    places = np.cumsum([0, *(len(d) + 1 for d in documents)])
    lowered = "\n".join(documents).lower() + "\n   "
    points = np.frombuffer(lowered.encode("utf-32-le"), np.uint32)
    kind = KIND[points]
    start = np.empty(len(kind), bool)
    start[0] = True
    start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == DIGIT)
    # An apostrophe that opens a run of its own takes s, t, m, d, re, ve or ll along.
    at = np.flatnonzero(start & (points == ord("'")))
    at = at[kind[at + 1] == LETTER]
    one, two = points[at + 1], points[at + 2]
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = np.zeros(len(at), bool)
    for a, b in ("re", "ve", "ll"):
        long |= (one == ord(a)) & (two == ord(b))
    start[at[short | long] + 1] = False
    after = at[short | long] + np.where(short, 2, 3)[short | long]
    start[after] |= kind[after] == LETTER
    kept = kind != SPACE
    start &= kept
    points = points[kept]
    data = points.tobytes().decode("utf-32-le").encode()
    offsets = np.concatenate(([0], np.cumsum(1 + (points >= 0x80))))
    cuts = np.flatnonzero(start[kept])
    counts = np.diff(np.searchsorted(np.flatnonzero(start), places))
    return data, np.append(offsets[cuts], len(data)), counts


class Slice:
    """The distinct words of some texts, and the texts as numbers of them.

    Text d has the next ``counts[d]`` numbers of ``words``.
    """

    def __init__(self, documents: list[bytes], known: Vocabulary):
        latin = [not _odd(d, known.marker_start) for d in documents]
        data, offsets, counts = latin_pieces(
            [d.decode() for d, plain in zip(documents, latin, strict=True) if plain]
        )
        others = [known.pieces(d.decode()) for d, plain in zip(documents, latin, strict=True) if not plain]
        flat = [w for d in others for w in d]
        data += b"".join(flat)
        offsets = np.concatenate((offsets, offsets[-1] + np.cumsum([len(w) for w in flat], dtype=np.int64)))
        cells = pa.Array.from_buffers(
            pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
        ).dictionary_encode()
        self.distinct = cells.dictionary
        numbers = cells.indices.to_numpy()
        sizes = np.empty(len(documents), np.int64)
        latin = np.array(latin, bool)
        sizes[latin], sizes[~latin] = counts, [len(d) for d in others]
        # Latin texts were cut first; bring the numbers back to the order of the texts.
        first = np.empty(len(documents), np.int64)
        order = np.concatenate((np.flatnonzero(latin), np.flatnonzero(~latin)))
        first[order] = np.cumsum(sizes[order]) - sizes[order]
        self.words = numbers[spans(first, sizes)] if len(flat) else numbers
        self.counts = sizes

    def buffers(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the distinct words and where each starts in them."""
        _, offsets, data = self.distinct.buffers()
        offsets = np.frombuffer(offsets, np.int64)[: len(self.distinct) + 1]
        return np.frombuffer(data or b"", np.uint8), offsets

    def uses(self) -> np.ndarray:
        return np.bincount(self.words, minlength=len(self.distinct))


_BEYOND = re.compile(rb"[\xc6-\xff]|\xc4\xb0")


def _odd(text: bytes, marker: bytes) -> bool:
    """Whether a text has a character beyond the table, one that grows in lower case, or a marker."""
    return not text.isascii() and bool(_BEYOND.search(text)) or marker in text


def encoded(part: Slice, lexicon: Transducer, known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the slice's texts, one after the other, and their number for each text."""
    row = lexicon.rows(*part.buffers())
    unseen = np.flatnonzero(row < 0)
    more, cuts = known.ids([w.decode() for w in part.distinct.take(pa.array(unseen)).to_pylist()])
    start, size = np.empty(len(row), np.int64), np.empty(len(row), np.int64)
    seen = row >= 0
    start[seen] = lexicon.starts[row[seen]]
    size[seen] = lexicon.starts[row[seen] + 1] - start[seen]
    start[unseen], size[unseen] = cuts[:-1] + len(lexicon.ids), np.diff(cuts)
    ids = np.concatenate((lexicon.ids, more))[spans(start[part.words], size[part.words])]
    ends = np.concatenate(([0], np.cumsum(size[part.words])))
    edges = np.concatenate(([0], np.cumsum(part.counts)))
    return ids, np.diff(ends[edges])


def word_counts(docs: DataFrame, path: str) -> DataFrame:
    """How often each word, as the vocabulary cuts and normalizes it, stands in all texts."""
    schema = pa.schema([("word", pa.binary()), ("uses", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for _, documents in texts(batches, STEP):
            part = Slice(documents, known)
            yield emit(schema, word=part.distinct.cast(pa.binary()), uses=part.uses())

    found = docs.select("text").mapInArrow(count, "word binary, uses long")
    return found.groupBy("word").agg(F.sum("uses").alias("uses"))


def frequent_words(counts: DataFrame, limit: int) -> list[bytes]:
    """At most ``limit`` words, whole classes of like frequency from the top; no word of one use."""
    ranked = cut(
        counts.where("uses > 1").withColumn("rank", F.floor(F.log2("uses") * CLASSES)), "bpe-words"
    )
    total, least = 0, None
    for row in ranked.groupBy("rank").count().orderBy(F.desc("rank")).collect():
        total += row["count"]
        if total > limit:
            break
        least = row["rank"]
    if least is None:
        return []
    return sorted(ranked.where(F.col("rank") >= least).select("word").toArrow()["word"].to_pylist())


def fitted(docs: DataFrame, path: str, limit: int = LEXICON) -> dict[str, str]:
    """Files of a transducer over the frequent words of the documents."""
    words = frequent_words(word_counts(docs, path), limit)
    ids, starts = vocabulary(path).ids([w.decode() for w in words])
    arrays = compiled(words) | {"ids": ids, "starts": starts}
    return save(arrays, work_folder(docs.sparkSession, "bpe-lexicon"))


def encode(docs: DataFrame, path: str, files: dict[str, str]) -> DataFrame:
    """One row for each document: ``doc_id`` and ``ids``, little-endian 32-bit numbers.

    ``files`` are those of ``fitted``; they decide the speed only. Markers that were
    counted as words are looked up like any other.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])
    mapping = tuple(files.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, lexicon = vocabulary(path), mapped(mapping)
        for batch, documents in texts(batches, STEP):
            ids, sizes = encoded(Slice(documents, known), lexicon, known)
            data = ids.astype("<u4").tobytes()
            ends = np.cumsum(sizes) * 4
            yield emit(
                schema,
                doc_id=batch.column("doc_id").cast(pa.int64()),
                ids=[data[b - n : b] for b, n in zip(ends.tolist(), (sizes * 4).tolist(), strict=True)],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids binary")


def decode(rows: DataFrame, path: str) -> DataFrame:
    """The rows' ``doc_id`` and ``ids`` with the ``text`` the library decodes them to, markers kept."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary(path)
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                sizes = np.asarray(pa.compute.binary_length(batch.column("ids").slice(start)), np.int64)
                n = max(1, int(np.searchsorted(np.cumsum(sizes), STEP, "right")))
                piece = batch.slice(start, n)
                ids = np.frombuffer(b"".join(piece.column("ids").to_pylist()), "<u4")
                found = known.text(ids, sizes[:n] // 4)
                text = pa.array(found, pa.binary()).cast(pa.string())
                yield emit(schema, doc_id=piece.column("doc_id"), ids=piece.column("ids"), text=text)
                start += n

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = table(spark, sf_dir, "documents"), default_path()
    decoded = decode(encode(docs, path, fitted(docs, path)), path)
    return decoded.select(
        "doc_id",
        F.expr("cast(octet_length(ids) div 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )
