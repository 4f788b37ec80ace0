"""Balanced parentheses of ordered trees, with range min-max excess blocks.

A tree is its walk: an opening parenthesis where a node is entered, a closing
one where it is left.  The excess is the number of open ones.  Blocks of BLOCK
parentheses keep the least excess in them, and a pyramid over the blocks the
least of two below, so the closing partner of a parenthesis is found by one
scan of its block, a climb, a descent, and one scan of another block.
All queries take and give numpy arrays.
"""

from __future__ import annotations

import numpy as np

BLOCK = 64


class Parentheses:
    def __init__(self, opens: np.ndarray):
        """``opens``: True for an opening and False for a closing parenthesis."""
        self.bits = np.packbits(opens)
        self.n = len(opens)
        excess = np.cumsum(np.where(opens, 1, -1))
        blocks = max(1, -(-self.n // BLOCK))
        size = 1 << (blocks - 1).bit_length()
        top = np.iinfo(np.int64).max
        padded = np.full(size * BLOCK, top)
        padded[:self.n] = excess
        self.excess = padded.reshape(size, BLOCK)
        self.least = [self.excess.min(1)]                   # of blocks, of pairs of blocks, ...
        while len(self.least[-1]) > 1:
            self.least.append(self.least[-1].reshape(-1, 2).min(1))
        opened = np.concatenate([[0], np.cumsum(opens)])
        self._opened = opened
        pairs = np.zeros(self.n + 1, np.int64)
        if self.n > 1:
            pairs[2:] = np.cumsum(opens[:-1] & ~opens[1:])
        self._pairs = pairs

    def rank(self, positions: np.ndarray) -> np.ndarray:
        """Opening parentheses before each position."""
        return self._opened[positions]

    def pair_rank(self, positions: np.ndarray) -> np.ndarray:
        """Leaf pairs ``()`` that end before each position."""
        return self._pairs[positions]

    def select(self) -> np.ndarray:
        """Positions of the opening parentheses, in order."""
        return np.flatnonzero(np.unpackbits(self.bits, count=self.n))

    def findclose(self, positions: np.ndarray, at_once: int = 4096) -> np.ndarray:
        """The position of the partner of each opening parenthesis."""
        out = np.empty(len(positions), np.int64)
        for i in range(0, len(positions), at_once):
            out[i:i + at_once] = self._findclose(positions[i:i + at_once])
        return out

    def _findclose(self, positions: np.ndarray) -> np.ndarray:
        block, place = np.divmod(positions, BLOCK)
        want = self.excess[block, place] - 1                # first later position whose excess falls to this
        here = (self.excess[block] <= want[:, None]) & (np.arange(BLOCK) > place[:, None])
        inside = here.any(1)
        at = np.where(inside, block * BLOCK + here.argmax(1), -1)
        left = np.flatnonzero(~inside)
        node, goal, level = block[left], want[left], 0
        found = np.zeros(len(left), np.int64)               # level at which the climb ended
        climbing = np.ones(len(left), bool)
        while climbing.any():
            some = np.flatnonzero(climbing)
            sibling = node[some] ^ 1
            fits = (sibling > node[some]) & (self.least[level][np.minimum(sibling, len(self.least[level]) - 1)] <= goal[some])
            node[some] = np.where(fits, sibling, node[some] >> 1)
            found[some[fits]] = level
            climbing[some[fits]] = False
            level += 1
        for level in range(len(self.least) - 1, 0, -1):
            some = np.flatnonzero(found >= level)
            child = 2 * node[some]
            node[some] = np.where(self.least[level - 1][child] <= goal[some], child, child + 1)
        if len(left):
            at[left] = node * BLOCK + (self.excess[node] <= goal[:, None]).argmax(1)
        return at
