"""Vantage-point trees over 64-bit fingerprints: all pairs within a Hamming radius, exactly.

A node holds a vantage point and a cut: fingerprints nearer than the cut go left, the others right.
By the triangle inequality a pair that the cut separates has its left member within `radius` of the
cut, so left members there visit the right half too; visitors go on into every half they may have
partners in. Each pair meets once, as (visitor, resident) or as two residents of one leaf.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Comparisons done at once.
BLOCK = 1 << 18


class Tree(NamedTuple):
    point: np.ndarray  # uint64 by node; children of node i are 2i+1 and 2i+2
    cut: np.ndarray  # -1: a leaf


def plant(sample: np.ndarray, depth: int) -> Tree:
    """A tree of at most `depth` levels from a sample of distinct fingerprints."""
    size = 2 ** (depth + 1) - 1
    tree = Tree(np.zeros(size, dtype=np.uint64), np.full(size, -1, dtype=np.int16))
    waiting = [(0, np.sort(sample), depth)]
    while waiting:
        node, own, levels = waiting.pop()
        if levels == 0 or len(own) < 4:
            continue
        point = own[len(own) // 2]
        far = np.bitwise_count(own ^ point)
        cut = int(np.median(far))
        right = far >= max(cut, 1)
        tree.point[node], tree.cut[node] = point, max(cut, 1)
        waiting += [(2 * node + 1, own[~right], levels - 1), (2 * node + 2, own[right], levels - 1)]
    return tree


def route(tree: Tree, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf, visitor or not, index into prints): where every fingerprint lives and visits."""
    leaves, roles, who = [], [], []
    node = np.zeros(len(prints), dtype=np.int64)
    visiting = np.zeros(len(prints), dtype=bool)
    index = np.arange(len(prints))
    while len(index):
        cut = tree.cut[node].astype(np.int64)
        done = cut < 0
        leaves.append(node[done])
        roles.append(visiting[done])
        who.append(index[done])
        node, visiting, index, cut = node[~done], visiting[~done], index[~done], cut[~done]
        far = np.bitwise_count(prints[index] ^ tree.point[node]).astype(np.int64)
        left = np.where(visiting, far <= cut - 1 + radius, far < cut)
        right = np.where(visiting, far >= cut - radius, far >= cut)
        over = ~visiting & left & (far >= cut - radius)
        node = np.concatenate([2 * node[left] + 1, 2 * node[right] + 2, 2 * node[over] + 2])
        index = np.concatenate([index[left], index[right], index[over]])
        visiting = np.concatenate([visiting[left], visiting[right], np.ones(int(over.sum()), bool)])
    return np.concatenate(leaves), np.concatenate(roles), np.concatenate(who)


def union(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the sets of a[i] and b[i] in place; root[x] is the smallest member of x's set."""
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while True:
            above = root[root]
            if np.array_equal(above, root):
                break
            root[:] = above


class Leaf:
    """The residents of one leaf; links are kept as sets, never as a list of pairs."""

    def __init__(self, residents: np.ndarray, radius: int):
        self.prints, self.radius = residents, radius
        self.root = np.arange(len(residents))
        self._among(np.arange(len(residents)))

    def visit(self, visitors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of a visitor, resident that it is linked to), one for each linked visitor."""
        n = len(self.prints)
        self.prints = np.concatenate([self.prints, visitors])
        self.root = np.concatenate([self.root, n + np.arange(len(visitors))])
        self._between(np.arange(n), n + np.arange(len(visitors)))
        linked = np.flatnonzero(self.root[n:] < n)
        partner = self.prints[self.root[n + linked]]
        self.prints, self.root = self.prints[:n], self.root[:n]
        return linked, partner

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(resident, smallest resident of its set) for all that aren't the smallest themselves."""
        own = np.flatnonzero(self.root != np.arange(len(self.root)))
        return self.prints[own], self.prints[self.root[own]]

    def _cut(self, members: np.ndarray) -> tuple[np.uint64, int] | None:
        point = self.prints[members[len(members) // 2]]
        far = np.bitwise_count(self.prints[members] ^ point)
        cut = max(int(np.median(far)), 1)
        right = int((far >= cut).sum())
        return (point, cut) if 0 < right < len(members) else None

    def _among(self, members: np.ndarray) -> None:
        split = self._cut(members) if len(members) > 256 else None
        if split is None:
            self._compare(members, members)
            return
        far = np.bitwise_count(self.prints[members] ^ split[0]).astype(np.int64)
        left, right = members[far < split[1]], members[far >= split[1]]
        over = members[(far < split[1]) & (far >= split[1] - self.radius)]
        self._among(left)
        self._among(right)
        self._between(right, over)

    def _between(self, members: np.ndarray, visitors: np.ndarray) -> None:
        if not len(members) or not len(visitors):
            return
        small = len(members) <= 64 or len(members) * len(visitors) <= BLOCK // 8
        split = None if small else self._cut(members)
        if split is None:
            self._compare(members, visitors)
            return
        far = np.bitwise_count(self.prints[members] ^ split[0]).astype(np.int64)
        seen = np.bitwise_count(self.prints[visitors] ^ split[0]).astype(np.int64)
        self._between(members[far < split[1]], visitors[seen <= split[1] - 1 + self.radius])
        self._between(members[far >= split[1]], visitors[seen >= split[1] - self.radius])

    def _compare(self, members: np.ndarray, visitors: np.ndarray) -> None:
        step = max(1, BLOCK // len(members))
        for lo in range(0, len(visitors), step):
            some = visitors[lo:lo + step]
            bits = np.bitwise_count(self.prints[some][:, None] ^ self.prints[members][None, :])
            i, j = np.nonzero(bits <= self.radius)
            if len(i):
                union(self.root, some[i], members[j])
