"""A minimal acyclic transducer from words to rows of a table, in flat arrays.

Words that end alike share states. The weights along a word's arcs add up to its
place in sorted order, which is the row of its output. The arrays are written as
separate files that every worker maps into memory, so workers of one machine share
the pages and nothing is unpickled.
"""

from __future__ import annotations

import functools
import io
import os
import tempfile

import numpy as np
from pyarrow import fs

from wardstar.llm.files import opened, write_file

ARRAYS = ("keys", "targets", "weights", "finals", "root", "starts", "ids")


def compiled(words: list[bytes]) -> dict[str, np.ndarray]:
    """The automaton of distinct words in ascending order.

    An arc leaves state ``key >> 8`` with byte ``key & 255``. A state is closed once
    no later word can pass through it; of equal closed states one is kept.
    """
    register: dict[tuple, int] = {}
    size: list[int] = []
    path: list[tuple[list[bool], list[tuple[int, int]]]] = [([False], [])]
    previous = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            state = closed()
            path[-1][1].append((previous[len(path) - 1], state))

    def closed() -> int:
        final, arcs = path.pop()
        form = (final[0], *arcs)
        if form not in register:
            register[form] = len(register)
            size.append(final[0] + sum(size[t] for _, t in arcs))
        return register[form]

    for word in words:
        close(len(os.path.commonprefix((previous, word))))
        path.extend(([False], []) for _ in range(len(word) - len(path) + 1))
        path[-1][0][0] = True
        previous = word
    close(0)
    root = closed()
    keys, targets, weights = [], [], []
    for (final, *arcs), state in register.items():
        passed = int(final)
        for byte, target in arcs:
            keys.append(state << 8 | byte)
            targets.append(target)
            weights.append(passed)
            passed += size[target]
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    return {
        "keys": np.array(keys, np.int64)[order],
        "targets": np.array(targets, np.int32)[order],
        "weights": np.array(weights, np.int32)[order],
        "finals": np.array([form[0] for form in register], bool),
        "root": np.array([root], np.int64),
    }


class Transducer:
    """Arrays of ``compiled`` with outputs: row r has ``ids[starts[r]:starts[r + 1]]``."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.keys, self.targets, self.weights = (arrays[n] for n in ARRAYS[:3])
        self.finals, self.root = arrays["finals"], int(arrays["root"][0])
        self.starts, self.ids = arrays["starts"], arrays["ids"]

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """For each word of bytes ``offsets[i]`` to ``offsets[i + 1]`` its row, or -1.

        All words take their next step at once; a word leaves at its end or where
        no arc goes on.
        """
        lengths = np.diff(offsets)
        state = np.full(len(lengths), self.root, np.int64)
        row = np.zeros(len(lengths), np.int64)
        live = np.flatnonzero(lengths > 0)
        depth = 0
        while len(live) and len(self.keys):
            wanted = state[live] << 8 | data[offsets[live] + depth]
            arc = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            found = self.keys[arc] == wanted
            state[live[~found]] = -1
            live, arc = live[found], arc[found]
            row[live] += self.weights[arc]
            state[live] = self.targets[arc]
            depth += 1
            live = live[lengths[live] > depth]
        known = (state >= 0) & self.finals[state]
        return np.where(known, row, -1)


def save(arrays: dict[str, np.ndarray], folder: str) -> dict[str, str]:
    """Write each array to a file of its own; the paths by name."""
    paths = {}
    for name in ARRAYS:
        out = io.BytesIO()
        np.save(out, arrays[name])
        paths[name] = write_file(folder, name, out.getvalue())
    return paths


@functools.lru_cache(maxsize=2)
def mapped(paths: tuple[tuple[str, str], ...]) -> Transducer:
    """The transducer over memory maps, opened once in each worker process.

    Files of a remote store are first copied to the worker's own temporary folder.
    """
    arrays = {}
    for name, path in paths:
        system, place = opened(path)
        if not isinstance(system, fs.LocalFileSystem):
            copy = tempfile.NamedTemporaryFile(delete=False, suffix=".npy")
            with system.open_input_stream(place) as data, copy:
                while block := data.read(1 << 20):
                    copy.write(block)
            place = copy.name
        arrays[name] = np.load(place, mmap_mode="r")
    return Transducer(arrays)
