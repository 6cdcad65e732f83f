"""Hierarchical index over 64-bit fingerprints in Gray order.

Neighbours in Gray order differ in few bits, so a run of them agrees in many.  A node keeps
the bits in which all its fingerprints agree (``shared``) and their values (``pattern``); its
parent keeps those that its children agree in.  Two subtrees differ at least in the bits that
both share with different values.  Going down, only the newly shared bits are compared and
their differences are added; a pair of subtrees is left as soon as the sum exceeds the limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LEAF = 16  # fingerprints of a leaf
FAN = 8  # children of an upper node
CHUNK = 1 << 15  # pairs of nodes looked at together


class GrayIndex:
    def __init__(self, fingerprints: np.ndarray):
        """``fingerprints``: uint64 in Gray order, not empty."""
        self.values = fingerprints
        every, some = self._merge(fingerprints, fingerprints, LEAF)
        self.levels = [(every, some)]
        while len(every) > 1:
            every, some = self._merge(every, some, FAN)
            self.levels.append((every, some))
        self.pattern = [e for e, _ in self.levels]
        self.shared = [~(e ^ s) for e, s in self.levels]

    @staticmethod
    def _merge(every: np.ndarray, some: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        starts = np.arange(0, len(every), width)
        return np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(some, starts)


def _children(nodes: np.ndarray, width: int, limit: int) -> tuple[np.ndarray, np.ndarray]:
    below = nodes[:, None] * width + np.arange(width)
    return below, below < limit


def close_pairs(left: GrayIndex, right: GrayIndex, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions ``(i, j)`` of all fingerprints within ``limit`` bits, in chunks; with
    ``left is right`` only ``i < j``."""
    same = left is right
    top = max(len(left.levels), len(right.levels)) - 1

    def at(tree: GrayIndex, level: int) -> int:
        return min(level, len(tree.levels) - 1)

    root = np.zeros(1, dtype=np.int64)
    # a chunk of pairs of nodes at a level, with the bits compared so far and the differences
    stack = [(top, root, root, np.zeros(1, np.uint64), np.zeros(1, np.int64))]
    while stack:
        level, i, j, compared, found = stack.pop()
        a, b = at(left, level), at(right, level)
        common = left.shared[a][i] & right.shared[b][j]
        differ = (left.pattern[a][i] ^ right.pattern[b][j]) & common & ~compared
        found = found + np.bitwise_count(differ)
        keep = found <= limit
        i, j, compared, found = i[keep], j[keep], common[keep], found[keep]
        if not len(i):
            continue
        if level == 0:
            for s in range(0, len(i), CHUNK // (LEAF * LEAF) * 8):
                part = slice(s, s + CHUNK // (LEAF * LEAF) * 8)
                yield from _leaf_pairs(left, right, i[part], j[part], limit, same)
            continue
        # a tree that is lower than the other stays at its root until the other has come down
        down_left, down_right = at(left, level - 1) < a, at(right, level - 1) < b
        ci, oki = _children(i, FAN, len(left.pattern[a - 1])) if down_left else (i[:, None], np.ones((len(i), 1), bool))
        cj, okj = _children(j, FAN, len(right.pattern[b - 1])) if down_right else (j[:, None], np.ones((len(j), 1), bool))
        ok = oki[:, :, None] & okj[:, None, :]
        if same:
            ok &= ci[:, :, None] <= cj[:, None, :]
        row, x, y = np.nonzero(ok)
        ni, nj, nc, nf = ci[row, x], cj[row, y], compared[row], found[row]
        for s in range(0, len(ni), CHUNK):
            stack.append((level - 1, ni[s : s + CHUNK], nj[s : s + CHUNK], nc[s : s + CHUNK], nf[s : s + CHUNK]))


def _leaf_pairs(
    left: GrayIndex, right: GrayIndex, i: np.ndarray, j: np.ndarray, limit: int, same: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    ci, oki = _children(i, LEAF, len(left.values))
    cj, okj = _children(j, LEAF, len(right.values))
    a = left.values[np.minimum(ci, len(left.values) - 1)]
    b = right.values[np.minimum(cj, len(right.values) - 1)]
    near = np.bitwise_count(a[:, :, None] ^ b[:, None, :]) <= limit
    near &= oki[:, :, None] & okj[:, None, :]
    if same:
        near &= ci[:, :, None] < cj[:, None, :]
    row, x, y = np.nonzero(near)
    if len(row):
        yield ci[row, x], cj[row, y]


class Forest:
    """Groups of positions, merged pair by pair; the smallest position names a group."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def merge(self, i: np.ndarray, j: np.ndarray) -> None:
        label = self.label
        while True:
            a, b = label[i], label[j]
            open_ = a != b
            if not open_.any():
                break
            i, j, a, b = i[open_], j[open_], a[open_], b[open_]
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
            while True:
                jumped = label[label]
                if np.array_equal(jumped, label):
                    break
                label[:] = jumped

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Every position that does not name its group, with the one that does."""
        child = np.nonzero(self.label != np.arange(len(self.label)))[0]
        return child, self.label[child]


def forest_within(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    tree, forest = GrayIndex(values), Forest(len(values))
    for i, j in close_pairs(tree, tree, limit):
        forest.merge(i, j)
    return forest.edges()


def forest_between(first: np.ndarray, second: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions count on from ``first`` into ``second``."""
    forest = Forest(len(first) + len(second))
    for i, j in close_pairs(GrayIndex(first), GrayIndex(second), limit):
        forest.merge(i, j + len(first))
    return forest.edges()
