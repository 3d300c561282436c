"""Counting the boxes around points without listing the pairs: a k-d tree over points that boxes descend.

A node whose points all lie in a box takes the box as a whole (its count and smallest id stay at the node), a node that
the box misses takes nothing, and only the leaves that a box cuts compare point by point.  All bounds are inclusive.
"""

from __future__ import annotations

import numpy as np

PIECE = 1 << 17  # (box, node) pairs looked at together


class PointTree:
    """k-d tree over the rows of ``pts``; leaves hold at most ``leaf`` rows unless the rows are equal.  A node is split on
    the axis that is long against the usual side of the boxes (``sides``), at its median."""

    def __init__(self, pts: np.ndarray, sides: np.ndarray, leaf: int = 64):
        self.order = np.arange(len(pts))
        self.axis, self.cut, self.left, self.right, self.start, self.stop = [], [], [], [], [], []
        sides = np.maximum(np.nan_to_num(sides, nan=0.0), 1e-12)
        todo = [(0, len(pts), -1, False)]
        while todo:
            a, b, parent, is_right = todo.pop()
            node = len(self.axis)
            if parent >= 0:
                (self.right if is_right else self.left)[parent] = node
            for x, v in ((self.axis, -1), (self.cut, 0.0), (self.left, -1), (self.right, -1), (self.start, a), (self.stop, b)):
                x.append(v)
            if b - a <= leaf:
                continue
            rows = self.order[a:b]
            some = pts[rows]
            low, high = some.min(0), some.max(0)
            with np.errstate(invalid="ignore", over="ignore"):
                axis = int(np.argmax(np.where(high > low, (high - low) / sides, -1.0)))
            if not high[axis] > low[axis]:
                continue
            col = some[:, axis]
            cut = np.partition(col, (b - a - 1) // 2)[(b - a - 1) // 2]
            if cut == high[axis]:
                cut = col[col < cut].max()
            small = col <= cut
            self.order[a:b] = np.concatenate([rows[small], rows[~small]])
            m = a + int(small.sum())
            self.axis[node], self.cut[node] = axis, cut
            todo += [(a, m, node, False), (m, b, node, True)]
        self.axis, self.left, self.right, self.start, self.stop = (
            np.array(x, np.int64) for x in (self.axis, self.left, self.right, self.start, self.stop))
        self.cut = np.array(self.cut, np.float64)
        self.leaves = np.flatnonzero(self.left < 0)
        self.low = np.full((len(self.axis), pts.shape[1]), np.inf)
        self.high = -self.low
        if len(pts):
            self.set_bounds(self.leaves, np.stack([pts[self.order[self.start[i]:self.stop[i]]].min(0) for i in self.leaves]),
                            np.stack([pts[self.order[self.start[i]:self.stop[i]]].max(0) for i in self.leaves]))

    def set_bounds(self, leaves, low: np.ndarray, high: np.ndarray) -> None:
        """Bounds of the points in ``leaves`` (other leaves: none), and from them those of all nodes."""
        self.low[:], self.high[:] = np.inf, -np.inf
        self.low[leaves], self.high[leaves] = low, high
        for i in range(len(self.axis) - 1, -1, -1):  # children come after their parent
            if self.left[i] >= 0:
                self.low[i] = np.minimum(self.low[self.left[i]], self.low[self.right[i]])
                self.high[i] = np.maximum(self.high[self.left[i]], self.high[self.right[i]])

    def leaf_of(self, pts: np.ndarray) -> np.ndarray:
        at = np.zeros(len(pts), np.int64)
        while True:
            live = np.flatnonzero(self.left[at] >= 0)
            if not len(live):
                return at
            n = at[live]
            at[live] = np.where(pts[live, self.axis[n]] <= self.cut[n], self.left[n], self.right[n])

    def meet(self, low: np.ndarray, high: np.ndarray):
        """Pairs of boxes and nodes in pieces ``(box, node, whole)``: ``whole`` nodes lie in the box, the other pairs are
        leaves that the box cuts.  A point of a box is in exactly one of the pair's nodes."""
        todo = [(np.arange(a, min(a + PIECE, len(low))), np.zeros(min(PIECE, len(low) - a), np.int64))
                for a in range(0, len(low), PIECE)]
        while todo:
            box, node = todo.pop()
            touch = ((low[box] <= self.high[node]) & (high[box] >= self.low[node])).all(1)
            box, node = box[touch], node[touch]
            whole = ((low[box] <= self.low[node]) & (high[box] >= self.high[node])).all(1)
            done = whole | (self.left[node] < 0)
            yield box[done], node[done], whole[done]
            box, node = box[~done], node[~done]
            if len(box):
                box, node = np.concatenate([box, box]), np.concatenate([self.left[node], self.right[node]])
                todo += [(box[a:a + PIECE], node[a:a + PIECE]) for a in range(0, len(box), PIECE)]


def stab(pts: np.ndarray, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per point the number of boxes that hold it and the smallest ``rank`` (0 to len(low) - 1) among them (len(low): none)."""
    none = len(low)
    hits, best = np.zeros(len(pts), np.int64), np.full(len(pts), none, np.int64)
    if not len(pts) or not none:
        return hits, best
    tree = PointTree(pts, (high - low).mean(0))
    n = len(tree.axis)
    node_hits, node_best = np.zeros(n, np.int64), np.full(n, none, np.int64)
    for box, node, whole in tree.meet(low, high):
        node_hits += np.bincount(node[whole], minlength=n)
        np.minimum.at(node_best, node[whole], rank[box[whole]])
        box, node = box[~whole], node[~whole]
        size = tree.stop[node] - tree.start[node]
        cuts = np.concatenate([[0], np.cumsum(size)])
        a = 0
        while a < len(box):  # a piece has about PIECE points, at least one leaf
            b = max(a + 1, int(np.searchsorted(cuts, cuts[a] + 8 * PIECE, "right")) - 1)
            row = tree.order[np.arange(cuts[b] - cuts[a]) - np.repeat(cuts[a:b] - cuts[a] - tree.start[node[a:b]], size[a:b])]
            of = np.repeat(box[a:b], size[a:b])
            held = np.ones(len(row), bool)
            for d in range(pts.shape[1]):
                x = pts[row, d]
                held &= (x >= low[of, d]) & (x <= high[of, d])
            hits += np.bincount(row[held], minlength=len(pts))
            np.minimum.at(best, row[held], rank[of[held]])
            a = b
    for i in range(n):
        if tree.left[i] >= 0:
            for child in (tree.left[i], tree.right[i]):
                node_hits[child] += node_hits[i]
                node_best[child] = min(node_best[child], node_best[i])
    for i in tree.leaves:
        rows = tree.order[tree.start[i]:tree.stop[i]]
        hits[rows] += node_hits[i]
        best[rows] = np.minimum(best[rows], node_best[i])
    return hits, best
