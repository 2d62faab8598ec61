"""Signature trees over shingle sets and their dual traversal."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

BITS = 4096
LEAF = 4


def linked(a: np.ndarray, b: np.ndarray, share: int = 75) -> bool:
    """100 * intersection >= ``share`` * union, for sorted arrays of distinct hashes."""
    if not len(a) or not len(b):
        return False
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < share * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= share * (len(a) + len(b) - both)


class Node:
    """OR of the members' bitmaps, range of their sizes, and the most tokens that share a bit with another."""

    __slots__ = ("members", "left", "right", "bitmap", "low", "high", "excess", "same")

    def __init__(self, members, left=None, right=None):
        self.members, self.left, self.right, self.same = members, left, right, len(members) == 1


def _bitmap(tokens: np.ndarray) -> np.ndarray:
    flags = np.zeros(BITS, np.uint8)
    flags[(tokens >> np.uint64(7)).astype(np.int64) % BITS] = 1
    return np.packbits(flags).view(np.uint64)


def build(sets: Sequence[np.ndarray], members: Sequence[int]) -> Node | None:
    """Tree over the members; neighbours in the order of smallest hash and size are likely similar."""
    order = sorted(members, key=lambda i: (int(sets[i][0]), len(sets[i]), i))
    level = []
    for at in range(0, len(order), LEAF):
        node = Node(order[at : at + LEAF])
        maps = [_bitmap(sets[i]) for i in node.members]
        sizes = [len(sets[i]) for i in node.members]
        node.bitmap = np.bitwise_or.reduce(maps)
        node.low, node.high = min(sizes), max(sizes)
        node.excess = max(s - int(np.bitwise_count(m).sum()) for s, m in zip(sizes, maps))
        level.append(node)
    while len(level) > 1:
        up = []
        for at in range(0, len(level), 2):
            if at + 1 == len(level):
                up.append(level[at])
                continue
            x, y = level[at : at + 2]
            node = Node(x.members + y.members, x, y)
            node.bitmap = x.bitmap | y.bitmap
            node.low, node.high, node.excess = min(x.low, y.low), max(x.high, y.high), max(x.excess, y.excess)
            up.append(node)
        level = up
    return level[0] if level else None


class Join:
    """Finds links that span the same components as all links do: pairs already connected are not compared."""

    def __init__(self, sets: Sequence[np.ndarray], share: int = 75):
        self.sets, self.share = sets, share
        self.parent = list(range(len(sets)))
        self.links: list[tuple[int, int]] = []
        self.compared = 0

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def _one_component(self, node: Node) -> bool:
        if not node.same:
            if node.left is None:
                first = self.find(node.members[0])
                node.same = all(self.find(i) == first for i in node.members)
            else:
                inner = self._one_component(node.left) and self._one_component(node.right)
                node.same = inner and self.find(node.left.members[0]) == self.find(node.right.members[0])
        return node.same

    def _possible(self, x: Node, y: Node) -> bool:
        share = self.share
        if 100 * x.high < share * y.low or 100 * y.high < share * x.low:
            return False
        if self._one_component(x) and self._one_component(y) and self.find(x.members[0]) == self.find(y.members[0]):
            return False
        overlap = int(np.bitwise_count(x.bitmap & y.bitmap).sum()) + min(x.excess, y.excess)
        return (100 + share) * overlap >= share * (x.low + y.low)

    def _compare(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        if a != b:
            self.compared += 1
            if linked(self.sets[i], self.sets[j], self.share):
                self.parent[max(a, b)] = min(a, b)
                self.links.append((i, j))

    def within(self, node: Node | None) -> None:
        """All pairs of a tree with itself."""
        if node is None:
            return
        if node.left is None:
            for k, i in enumerate(node.members):
                for j in node.members[k + 1 :]:
                    self._compare(i, j)
            return
        self.within(node.left)
        self.within(node.right)
        self.between(node.left, node.right)

    def between(self, x: Node | None, y: Node | None) -> None:
        """All pairs of two trees; the larger node is opened first."""
        stack = [(x, y)] if x is not None and y is not None else []
        while stack:
            x, y = stack.pop()
            if not self._possible(x, y):
                continue
            if x.left is None and y.left is None:
                for i in x.members:
                    for j in y.members:
                        self._compare(i, j)
            elif y.left is None or (x.left is not None and len(x.members) >= len(y.members)):
                stack += [(x.right, y), (x.left, y)]
            else:
                stack += [(x, y.right), (x, y.left)]
