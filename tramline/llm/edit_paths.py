"""Many strings of edits that share their beginnings, and their order.

Each string is a node: its last letter, and a link to the node of the string
before it. Nodes are never changed, so strings share all they have in common.
A node keeps its ancestors at distances 1, 2, 4, … and a rolling hash of its
whole string. Two strings are compared at the letter behind their longest
common prefix, which lies where the hashes of their ancestors part: a search
over the doubled distances, not a walk.

Equal strings are one node here (``add`` is asked once for a node and letter
that are kept), so a hash is verified by comparing nodes; after a collision the
search is done again over the nodes themselves.
"""

from __future__ import annotations

from array import array

import numpy as np

ROOT = 0
PRIME = (1 << 61) - 1
BASE = 0x5851F42D4C957F2D % PRIME
COLLECT_AT = 1 << 20  # nodes; beyond that, those no live string needs are dropped


class EditPaths:
    def __init__(self, base: int = BASE, prime: int = PRIME, collect_at: int = COLLECT_AT):
        self.base, self.prime, self.collect_at = base, prime, collect_at
        self.clear()

    def clear(self) -> None:
        """Only the empty string is left."""
        self.letter = array("B", [0])
        self.depth = array("q", [0])
        self.hash = array("Q", [0])
        self.up = [array("q", [ROOT])]  # up[k][node]: the ancestor 2^k letters before it
        self.limit = self.collect_at

    def __len__(self) -> int:
        return len(self.letter)

    def add(self, node: int, letter: int) -> int:
        """The string of ``node`` with one more letter (a byte)."""
        new, depth = len(self.letter), self.depth[node] + 1
        self.letter.append(letter)
        self.depth.append(depth)
        self.hash.append((self.hash[node] * self.base + letter) % self.prime)
        if depth >> len(self.up):
            self.up.append(array("q", bytes(8 * new)))
        at = node
        for table in self.up:
            table.append(at)
            at = table[at]
        return new

    def ancestor(self, node: int, depth: int) -> int:
        """The beginning of the string that has ``depth`` letters."""
        above = self.depth[node] - depth
        k = 0
        while above:
            if above & 1:
                node = self.up[k][node]
            above >>= 1
            k += 1
        return node

    def _part(self, x: int, y: int, names) -> tuple[int, int]:
        """The shortest beginnings of two strings of one length that have different names."""
        for table in reversed(self.up):
            a, b = table[x], table[y]
            if names[a] != names[b]:
                x, y = a, b
        return x, y

    def less(self, a: int, b: int) -> bool:
        """If the string of ``a`` comes first in the order of bytes; a beginning comes before the whole."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.ancestor(a, depth), self.ancestor(b, depth)
        if x == y:
            return self.depth[a] < self.depth[b]
        first = self._part(x, y, self.hash)
        if first[0] == first[1] or self.up[0][first[0]] != self.up[0][first[1]]:  # a collision
            first = self._part(x, y, range(len(self)))
        return self.letter[first[0]] < self.letter[first[1]]

    def string(self, node: int) -> bytes:
        out = bytearray()
        while node != ROOT:
            out.append(self.letter[node])
            node = self.up[0][node]
        out.reverse()
        return bytes(out)

    def collect(self, live: list[int]) -> list[int]:
        """Drop all nodes that no live string needs; returns the live nodes' new numbers."""
        keep = np.zeros(len(self), dtype=bool)
        keep[ROOT] = True
        for node in live:
            while not keep[node]:
                keep[node] = True
                node = self.up[0][node]
        number = np.cumsum(keep) - 1
        tables = []
        for table in self.up:
            tables.append(array("q", number[np.frombuffer(table, np.int64)[keep]].astype(np.int64).tobytes()))
        self.letter = array("B", np.frombuffer(self.letter, np.uint8)[keep].tobytes())
        self.depth = array("q", np.frombuffer(self.depth, np.int64)[keep].tobytes())
        self.hash = array("Q", np.frombuffer(self.hash, np.uint64)[keep].tobytes())
        self.up = tables
        self.limit = max(self.collect_at, 2 * len(self))
        return [int(number[node]) for node in live]
