"""Double-array tries over numbered symbols, built and walked with numpy.

A node is a cell of two arrays: its child by digit c is cell ``base[node] + c``, which is
a child of this node only if ``check`` of that cell names the node; the base of a leaf is the number of
its path. A symbol is written as two digits of a base near the root of the number of symbols, so
that a node's children lie close together and nodes fill each other's gaps. Nodes are placed level by
level: those with many children one by one, the largest first, among random places tried at
once; the others all together, again and again for those that met another's cells.
"""

from __future__ import annotations

from math import isqrt

import numpy as np

#: Nodes with more children are placed one by one.
FEW = 8
#: Cells for each node; places tried at once.
ROOM, TRIES = 2, 64


class Trie:
    """Paths of equal length over symbols 0, 1, 2...; ``paths`` must be distinct rows."""

    def __init__(self, paths: np.ndarray, symbols: int):
        n, length = paths.shape
        self.digits = isqrt(max(1, symbols)) + 1
        paths = np.stack(np.divmod(paths, self.digits), axis=2).reshape(n, 2 * length)
        order = np.lexsort(paths.T[::-1]) if n else np.zeros(0, np.int64)
        paths = paths[order]
        new = np.ones(paths.shape, bool)  # where a path leaves the path before it
        new[1:] = np.logical_or.accumulate(paths[1:] != paths[:-1], axis=1)
        cells = 2 * self.digits + ROOM * (int(new.sum()) + 16)
        self.base, self.check = np.zeros(cells, np.int32), np.full(cells, -1, np.int32)
        self.check[0] = 0  # the root, which is no child
        rnd = np.random.default_rng(n)
        at = np.zeros(n, np.int64)  # cell of each path's prefix
        for level in range(2 * length if n else 0):
            first = np.flatnonzero(new[:, level])  # one path for each child
            child = self._place(at[first], paths[first, level].astype(np.int64), rnd)
            at = child[np.cumsum(new[:, level]) - 1]
        self.base[at] = order
        self._grow(self.digits)  # so that every digit leads to a cell

    def _grow(self, more: int) -> None:
        self.base = np.concatenate([self.base, np.zeros(more, np.int32)])
        self.check = np.concatenate([self.check, np.full(more, -1, np.int32)])

    def _place(self, parent: np.ndarray, digit: np.ndarray, rnd: np.random.Generator) -> np.ndarray:
        """Cells for the children (parent, digit) of one level; a parent's children follow each other."""
        starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]]))
        sizes = np.diff(np.concatenate([starts, [len(parent)]]))
        child = np.zeros(len(parent), np.int64)
        many = np.flatnonzero(sizes > FEW)
        for i in many[np.argsort(-sizes[many], kind="stable")].tolist():
            mine = slice(starts[i], starts[i] + sizes[i])
            cell = rnd.integers(1, len(self.base) - self.digits, TRIES)[:, None] + digit[mine][None, :]
            free = ~(self.check[cell] >= 0).any(axis=1)
            if free.any():
                cell = cell[int(free.argmax())]
            else:
                cell = len(self.base) + digit[mine]
                self._grow(self.digits)
            child[mine] = cell
            self.base[parent[starts[i]]] = cell[0] - digit[starts[i]]
            self.check[cell] = parent[starts[i]]
        todo = np.flatnonzero(sizes <= FEW)
        scratch = np.zeros(len(self.base), np.int32)
        while len(todo):
            size = sizes[todo]
            owner = np.repeat(np.arange(len(todo), dtype=np.int32), size)
            begins = np.cumsum(size) - size
            mine = np.repeat(starts[todo] - begins, size) + np.arange(len(owner))
            base = rnd.integers(1, len(self.base) - self.digits, len(todo))
            cell = base[owner] + digit[mine]
            scratch[cell] = owner
            fits = np.logical_and.reduceat((self.check[cell] < 0) & (scratch[cell] == owner), begins)
            good = fits[owner]
            child[mine[good]] = cell[good]
            self.base[parent[starts[todo[fits]]]] = base[fits]
            self.check[cell[good]] = parent[mine[good]]
            todo = todo[~fits]
        return child

    def count(self, text: np.ndarray, length: int, paths: int, at: np.ndarray | None = None, times: np.ndarray | None = None) -> np.ndarray:
        """How often each path of ``length`` symbols occurs in a row of them (-1: none); all places advance together.
        With ``at`` and ``times``, only the paths that begin at those places count, as often as it says for each."""
        if at is None:
            at = np.flatnonzero(text[:max(0, len(text) - length + 1)] >= 0)
        which, state = np.arange(len(at)), np.zeros(len(at), np.int64)
        for step in range(length):
            symbol = text[at[which] + step]
            which, state, symbol = which[symbol >= 0], state[symbol >= 0], symbol[symbol >= 0]
            for part in (0, 1):
                cell = self.base[state] + (symbol % self.digits if part else symbol // self.digits)
                alive = (self.check[cell] == state) & (cell > 0)
                which, state, symbol = which[alive], cell[alive], symbol[alive]
        return np.bincount(self.base[state], None if times is None else times[which], paths).astype(np.int64)
