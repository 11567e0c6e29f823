"""A forest as balanced parentheses with a range min-max tree over its excess."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 64


class Parentheses:
    """Parentheses as a boolean array, True for an opening one, in preorder of the nodes.

    ``opens[i]`` is where node i opens. Levels of block minima of the excess, each half as long as
    the one below, find the closing parentheses of many nodes at once in logarithmic steps.
    """

    def __init__(self, bits: np.ndarray):
        self.bits = np.asarray(bits, bool)
        self.opens = np.flatnonzero(self.bits)
        self.excess = np.cumsum(np.where(self.bits, 1, -1))
        blocks = max(1, -(-len(self.bits) // BLOCK))
        width = 1 << (blocks - 1).bit_length()
        padded = np.full(width * BLOCK, np.iinfo(np.int64).max)
        padded[: len(self.bits)] = self.excess
        self._cells = padded.reshape(width, BLOCK)
        self.minima = [self._cells.min(axis=1)]
        while len(self.minima[-1]) > 1:
            self.minima.append(self.minima[-1].reshape(-1, 2).min(axis=1))

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """Positions of the parentheses that close those at ``at``."""
        at = np.asarray(at, np.int64)
        below = self.excess[at]  # the first later position whose excess is smaller closes it
        found = np.full(len(at), -1)
        block = at // BLOCK
        for begin in range(0, len(at), 8192):  # within their own blocks
            part = slice(begin, begin + 8192)
            cells = self._cells[block[part]]
            hit = (cells < below[part, None]) & (np.arange(BLOCK) > (at[part] % BLOCK)[:, None])
            some = hit.any(axis=1)
            found[part] = np.where(some, block[part] * BLOCK + hit.argmax(axis=1), -1)
        open_ = np.flatnonzero(found < 0)
        node, level = block[open_], np.zeros(len(open_), np.int64)
        climbing = np.ones(len(open_), bool)
        for depth in range(len(self.minima)):  # up, until a right sibling holds a smaller excess
            row = self.minima[depth]
            who = np.flatnonzero(climbing)
            right = node[who] ^ 1
            fits = (node[who] % 2 == 0) & (right < len(row))
            fits[fits] = row[right[fits]] < below[open_[who[fits]]]
            node[who[fits]], level[who[fits]] = right[fits], depth
            climbing[who[fits]] = False
            node[who[~fits]] >>= 1
        if climbing.any():
            raise ValueError("the parentheses are not balanced")
        for depth in range(len(self.minima) - 1, 0, -1):  # down to the leftmost such block
            who = np.flatnonzero(level == depth)
            left = node[who] * 2
            node[who] = np.where(self.minima[depth - 1][left] < below[open_[who]], left, left + 1)
            level[who] = depth - 1
        for begin in range(0, len(open_), 8192):
            part = slice(begin, begin + 8192)
            hit = self._cells[node[part]] < below[open_[part], None]
            found[open_[part]] = node[part] * BLOCK + hit.argmax(axis=1)
        return found

    def subtree_sizes(self) -> np.ndarray:
        """Number of nodes of each node's subtree, itself included."""
        return (self.find_close(self.opens) - self.opens + 1) // 2

    def leaves(self) -> np.ndarray:
        """Of each node whether it is a pair "()"."""
        after = np.append(self.bits, False)[self.opens + 1]
        return ~after
