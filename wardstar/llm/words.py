"""Words of texts as 64-bit hashes, computed for a whole slice at a time."""

from __future__ import annotations

import functools

import numpy as np

_RANDOM = np.random.default_rng(20240229)
#: A random number for each byte, the base of the polynomial, and its inverse.
BYTE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Space, tab, line feed, vertical tab, form feed and carriage return.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Each byte, A to Z as a to z.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32
REACH = 1 << 20


def powers(base: int, n: int) -> np.ndarray:
    """The powers 0 up to n of a base, modulo 2^64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_UP, _DOWN = powers(BASE, REACH + 1), powers(INVERSE, REACH + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer; every bit of the result depends on every bit given."""
    x = np.asarray(x, np.uint64)
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """The words of some documents, one after the other.

    ``hashes`` by word; ``starts`` and ``ends`` are byte places in ``data``, the
    documents joined by line feeds; document d has the words ``first[d]`` up to
    ``first[d + 1]``.
    """

    def __init__(self, documents: list[bytes], lower: bool, space: np.ndarray = SPACE):
        raw = np.frombuffer(b"\n".join(documents), np.uint8)
        self.data = LOWER[raw] if lower else raw
        space = space[self.data]
        edge = np.diff(np.concatenate(([True], space, [True])).view(np.int8))
        self.starts = np.flatnonzero(edge == -1)
        self.ends = np.flatnonzero(edge == 1)
        places = np.cumsum([0, *(len(d) + 1 for d in documents)])
        self.places = places
        self.first = np.searchsorted(self.starts, places)

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        """A polynomial in the bytes for each word, finalized with its length.

        Computed when first asked for: who only cuts texts at words needs none.
        """
        out = np.empty(len(self.starts), np.uint64)
        i = 0
        while i < len(out):
            base = self.starts[i]
            j = max(i + 1, int(np.searchsorted(self.ends, base + REACH, "right")))
            n = int(self.ends[j - 1] - base)
            up, down = (_UP, _DOWN) if n <= REACH else (
                powers(BASE, n + 1), powers(INVERSE, n + 1)
            )
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(BYTE[self.data[base : base + n]] * up[:n], out=sums[1:])
            s, e = self.starts[i:j] - base, self.ends[i:j] - base
            out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
            i = j
        return mix(out)

    def prefixes(self, n: int) -> np.ndarray:
        """A hash of the first ``n`` bytes of each word; 0 for words not longer than that."""
        longer = np.flatnonzero(self.ends - self.starts > n)
        total = np.full(len(longer), n, np.uint64)
        for k in range(n):
            total += BYTE[self.data[self.starts[longer] + k]] * _UP[k + 1]
        out = np.zeros(len(self.starts), np.uint64)
        out[longer] = mix(total)
        return out

    def __len__(self) -> int:
        return len(self.first) - 1

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def documents(self) -> np.ndarray:
        """For each word the number of its document here."""
        return np.repeat(np.arange(len(self)), self.counts())


def ngrams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash for each n values in a row; shorter input gives none.

    The polynomial of 2 m values follows from two of m, so it takes about log n steps.
    """
    size = max(0, len(hashes) - n + 1)
    total = np.zeros(size, np.uint64)
    if not size:
        return total
    sums, width, done = hashes * np.uint64(BASE), 1, 0
    while True:
        if n & width:
            total += sums[done : done + size] * np.uint64(pow(BASE, done, 1 << 64))
            done += width
        if done == n:
            return mix(total)
        sums = sums[:-width] + sums[width:] * np.uint64(pow(BASE, width, 1 << 64))
        width *= 2


#: White space and every ASCII character that is no letter, digit or apostrophe.
MARKED = SPACE.copy()
MARKED[[b for b in range(128) if not chr(b).isalnum() and chr(b) != "'"]] = True
