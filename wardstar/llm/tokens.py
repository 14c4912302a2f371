"""Token ids of whole texts by a byte-level BPE file of the tokenizers library.

A byte-level BPE of this kind never joins a space that stands right before a visible
character to what comes before it, nor a single line break between visible
characters to either side. So texts are cut there, a slice of them at once; the
distinct pieces are looked up or given to the library, and the ids of a text are those
of its pieces, one after the other.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from wardstar.llm.common import spans, texts

#: Bytes of text encoded in one step: the more, the fewer pieces are looked up again, but
#: an executor holds a step for each of its cores beside a heap that may be full.
ENCODED_BYTES = 4 << 20
#: Pieces given to the library at once; its result takes some 100 bytes for each id.
AT_ONCE = 1 << 13
#: Marks that often follow a word.
MARKS = b".,;:!?"
#: What a byte is: a visible ASCII character, the first byte of a two-byte Latin letter, a
#: space or a line break. What is none of them is not cut at, which is always right.
VISIBLE, LATIN, SPACE, BREAK = 1, 2, 4, 8
KINDS = bytes(
    VISIBLE * (0x21 <= b < 0x7F) | LATIN * (0xC3 <= b < 0xCA) | SPACE * (b == 0x20) | BREAK * (b == 0x0A)
    for b in range(256)
)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def piece_starts(data: bytes) -> np.ndarray:
    """Where a new piece begins: good spaces, and single line breaks with what follows."""
    kinds = np.frombuffer(data.translate(KINDS), np.uint8)
    after = np.zeros(len(kinds), bool)
    after[:-1] = kinds[1:] & (VISIBLE | LATIN) != 0
    # A visible character ends before a place: ASCII, or the second byte of a Latin one.
    before = np.zeros(len(kinds), bool)
    before[1:] = kinds[:-1] & VISIBLE != 0
    before[2:] |= kinds[:-2] & LATIN != 0
    breaks = (kinds & BREAK != 0) & before & after
    starts = ((kinds & SPACE != 0) & after) | breaks
    starts[1:] |= breaks[:-1]
    return starts


def _values(pieces: pa.LargeBinaryArray) -> list[bytes]:
    """The pieces of a whole array, cut from its buffer: ``to_pylist`` makes a scalar of each."""
    _, offsets, data = pieces.buffers()
    edges = np.frombuffer(offsets, np.int64, len(pieces) + 1).tolist()
    held = data.to_pybytes()
    return [held[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


class Encoder:
    """Ids as little-endian 32-bit bytes, with a bounded memo by piece.

    The memo has two generations of ``size`` pieces; a piece that is met again
    moves to the newer one, so common pieces outlive the rare ones.
    """

    def __init__(self, path: str, size: int = 250_000):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True  # their strings are ordinary text
        # In a byte-level vocabulary each character of an entry stands for a byte.
        self.lengths = np.zeros(self.library.get_vocab_size() + 1, np.int64)
        for piece, i in self.library.get_vocab().items():
            self.lengths[i] = len(piece)
        self.size = size
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.marks = {m: self._library([chr(m)])[0] for m in MARKS}

    def forget(self) -> None:
        """Empty the memo, and give back what Arrow keeps of memory it no longer uses."""
        self.memo, self.older = {}, {}
        pa.default_memory_pool().release_unused()

    def encode(self, text: str) -> bytes:
        return self.encode_all([text.encode()])[0]

    def encode_all(self, documents: list[bytes]) -> list[bytes]:
        """The ids of each text in UTF-8; the library is called for pieces not met before."""
        sizes = np.array([len(d) for d in documents], np.int64)
        edges = np.concatenate(([0], np.cumsum(sizes)))
        if not edges[-1]:
            return [b""] * len(documents)
        data = b"".join(documents)
        spread = np.frombuffer(data, np.uint8)
        starts = piece_starts(data)
        # A space that ends a text stands before nothing, whatever the next text begins with.
        ends = edges[1:][sizes > 0] - 1
        starts[ends] &= spread[ends] != 0x20
        starts[edges[:-1][sizes > 0]] = True
        cuts = np.flatnonzero(starts)
        offsets = np.append(cuts, edges[-1])
        pieces = pa.Array.from_buffers(
            pa.large_binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
        ).dictionary_encode()
        ids = self._distinct(_values(pieces.dictionary))
        numbers = pieces.indices.to_numpy()
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        length = size[numbers]
        found = flat[spans((np.cumsum(size) - size)[numbers], length)].tobytes()
        ends = np.concatenate(([0], np.cumsum(length)))[np.searchsorted(cuts, edges)] * 4
        return [found[a:b] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]

    def _distinct(self, pieces: list[bytes]) -> list[bytes]:
        found = list(map(self.memo.get, pieces))
        new = [p for p, ids in zip(pieces, found, strict=True) if ids is None]
        if not new:
            return found
        if len(self.memo) + len(new) > self.size:
            self.memo, self.older = {}, self.memo
        self._learn(new)
        memo = self.memo
        return [memo[p] if ids is None else ids for p, ids in zip(pieces, found, strict=True)]

    def _library(self, texts: list[str]) -> list[bytes]:
        return [
            np.array(e.ids, "<u4").tobytes()
            for e in self.library.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _learn(self, pieces: list[bytes]) -> None:
        memo, older = self.memo, self.older
        left = []
        for piece in pieces:
            if (known := older.get(piece)) is not None:
                memo[piece] = known
            else:
                left.append(piece)
        # A mark right after a letter is a piece of its own.
        marked = [p for p in left if p[-1] in MARKS and p[-2:-1].isalpha()]
        bases = {p[:-1] for p in marked} | set(left).difference(marked)
        bases.difference_update(memo.keys() & bases)
        # What stands before a mark may be known from the older generation.
        for base in older.keys() & bases:
            memo[base] = older[base]
            bases.remove(base)
        after_space = [b for b in bases if b[0] == 0x20]
        for k in range(0, len(after_space), AT_ONCE):
            self._encode_joined(after_space[k : k + AT_ONCE], b"")
        plain = [b for b in bases if 0x21 <= b[0] < 0x7F and 0x21 <= b[-1] < 0x7F]
        for k in range(0, len(plain), AT_ONCE):
            self._encode_joined(plain[k : k + AT_ONCE], b"\n")
        rest = list(bases.difference(after_space, plain))
        for k in range(0, len(rest), AT_ONCE):
            some = rest[k : k + AT_ONCE]
            memo.update(zip(some, self._library([p.decode() for p in some]), strict=True))
        for piece in marked:
            memo[piece] = memo[piece[:-1]] + self.marks[piece[-1]]

    def _encode_joined(self, pieces: list[bytes], between: bytes) -> None:
        """Encode the pieces as one text, cut at the places a text may be cut."""
        ids = np.frombuffer(self._library([between.join(pieces).decode()])[0], "<u4")
        ends = np.cumsum(self.lengths[ids])
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces)) + len(between)
        stops = np.cumsum(sizes) - len(between)
        lasts = np.searchsorted(ends, stops, "right") * 4
        firsts = np.searchsorted(ends, stops - sizes + len(between), "right") * 4
        data = ids.tobytes()
        cuts = map(slice, firsts.tolist(), lasts.tolist())
        self.memo.update(zip(pieces, map(data.__getitem__, cuts), strict=True))


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return Encoder(path)


def encoded(
    batches: Iterator[pa.RecordBatch], path: str
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of a task's batches, and the ids of each text of column ``text`` (null: empty).

    The memo lasts for the task: a worker outlives it, and would hold the memo beside
    the executor's heap while other stages use that to the full.
    """
    known = encoder(path)
    try:
        for batch, found in texts(batches, ENCODED_BYTES):
            yield batch, known.encode_all(found)
    finally:
        known.forget()
