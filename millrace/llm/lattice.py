"""The lattice of all ways to cut words into vocabulary pieces, in numpy, many words at a time.

A word is bytes with a mark (a blank) before it. Pieces are byte strings, kept in a trie as one table of transitions.
From every place in turn the words of a group walk the trie together; each piece they pass is an arc
to the place where it ends. Sums over arcs run in logarithms.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Cells (words times places) worked on at a time.
CELLS = 1 << 20
#: Logarithms of masses down to minus this are plain floats with room to spare.
SAFE_LOG = 500.0


class Trie:
    """Pieces by their bytes: ``step[node, byte class]`` is the next node, ``piece[node]`` the piece that ends there or -1."""

    def __init__(self, pieces: list[bytes]):
        used = np.unique(np.frombuffer(b"".join(pieces), np.uint8)) if pieces else np.zeros(0, np.uint8)
        self.of = np.zeros(256, np.int64)  # class 0: in no piece
        self.of[used] = np.arange(1, len(used) + 1)
        size = np.array([len(p) for p in pieces], np.int64)
        table = np.zeros((len(pieces), max(1, size.max(initial=0))), np.int64)
        for i, p in enumerate(pieces):
            table[i, : len(p)] = self.of[np.frombuffer(p, np.uint8)]
        width, at, made, rows, ends = len(used) + 1, np.zeros(len(pieces), np.int64), 1, [], []
        for k in range(table.shape[1]):
            here = np.flatnonzero(size > k)
            key, to = np.unique(at[here] * width + table[here, k], return_inverse=True)
            rows.append((key, made + np.arange(len(key))))
            at[here] = made + to
            made += len(key)
            last = here[size[here] == k + 1]
            ends.append((at[last], last))
        step = np.zeros(made * width, np.int32)
        for key, to in rows:
            step[key] = to
        self.step, self.width = step, width
        self.piece = np.full(made, -1, np.int32)
        for node, last in ends:
            self.piece[node] = last


def _groups(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(rows, table)``: words of equal length as a table of bytes, a bounded number of cells at a time."""
    words = words.combine_chunks() if isinstance(words, pa.ChunkedArray) else words
    words = words.cast(pa.large_binary())
    offs = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8) if words.buffers()[2] is not None else np.zeros(0, np.uint8)
    size = np.diff(offs)
    order = np.argsort(size, kind="stable")
    cuts = np.flatnonzero(np.diff(size[order])) + 1
    for rows in np.split(order, cuts):
        if not len(rows):
            continue
        n = int(size[rows[0]])
        for lo in range(0, len(rows), max(1, CELLS // (n + 1))):
            part = rows[lo : lo + max(1, CELLS // (n + 1))]
            yield part, data[offs[part][:, None] + np.arange(n)]


def _arcs(trie: Trie, classes: np.ndarray, i: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(end, rows, pieces)`` of the arcs that start at place ``i``."""
    rows, node = np.arange(len(classes)), trie.step[classes[:, i]]
    for j in range(i, classes.shape[1]):
        if j > i:
            node = trie.step[node * trie.width + classes[rows, j]]
        alive = np.flatnonzero(node)
        if len(alive) < len(node):
            rows, node = rows[alive], node[alive]
        if not len(rows):
            return
        piece = trie.piece[node]
        found = np.flatnonzero(piece >= 0)
        if len(found):
            yield j + 1, rows[found], piece[found]


def _forward(trie: Trie, classes: np.ndarray, weights: np.ndarray, keep: list | None = None) -> np.ndarray:
    """Log mass of all ways from the start to each place, place by place, ``(weights, places, words)``; arcs go to ``keep`` if given."""
    mass = np.full((len(weights), classes.shape[1] + 1, len(classes)), -np.inf)
    mass[:, 0] = 0.0
    for i in range(classes.shape[1]):
        for end, rows, piece in _arcs(trie, classes, i):
            for m, weight in zip(mass, weights, strict=True):
                m[end, rows] = np.logaddexp(m[end, rows], m[i, rows] + weight[piece])
            if keep is not None:
                keep.append((i, end, rows, piece))
    return mass


def word_masses(trie: Trie, weights: np.ndarray, words: pa.Array) -> np.ndarray:
    """Natural logarithm of the summed weight of all segmentations of each word, ``(weights, words)``; one walk serves all weights."""
    out = np.zeros((len(weights), len(words)))
    for rows, table in _groups(words):
        out[:, rows] = _forward(trie, trie.of[table], weights)[:, -1]
    return out


def expected_pieces(trie: Trie, weight: np.ndarray, words: pa.Array, counts: np.ndarray) -> np.ndarray:
    """How often each piece is used, every segmentation counted by its share of the word's mass.

    No place has less mass than the way over single bytes. Where that is far from the least number a float holds,
    plain sums do; longer words are summed in logarithms.
    """
    out = np.zeros(len(weight))
    single = trie.piece[trie.step[1 : trie.width]]
    least = weight[single[single >= 0]].min(initial=0.0)
    plain = np.exp(weight)
    for rows, table in _groups(words):
        if (single >= 0).all() and table.shape[1] * -least < SAFE_LOG:
            _plain_expected(trie, plain, trie.of[table], counts[rows], out)
            continue
        arcs: list = []
        mass = _forward(trie, trie.of[table], weight[None], arcs)[0]
        back = np.full(mass.shape, -np.inf)
        back[-1] = 0.0
        times = counts[rows]
        for i, end, at, piece in reversed(arcs):
            after = weight[piece] + back[end, at]
            back[i, at] = np.logaddexp(back[i, at], after)
            out += np.bincount(piece, times[at] * np.exp(mass[i, at] + after - mass[-1, at]), len(out))
    return out


def _plain_expected(trie: Trie, weight: np.ndarray, classes: np.ndarray, times: np.ndarray, out: np.ndarray) -> None:
    """Add the expected uses of pieces to ``out``, without logarithms."""
    mass = np.zeros((classes.shape[1] + 1, len(classes)))
    mass[0] = 1.0
    arcs, pieces, uses = [], [], []
    for i in range(classes.shape[1]):
        for end, rows, piece in _arcs(trie, classes, i):
            way = weight[piece]
            mass[end, rows] += mass[i, rows] * way
            arcs.append((i, end, rows, piece, way))
    back = np.zeros(mass.shape)
    back[-1] = times / mass[-1]
    for i, end, rows, piece, way in reversed(arcs):
        after = way * back[end, rows]
        back[i, rows] += after
        pieces.append(piece)
        uses.append(mass[i, rows] * after)
    if pieces:
        out += np.bincount(np.concatenate(pieces), np.concatenate(uses), len(out))
