"""Cover trees over norm-augmented vectors, for inner-product search inside score windows.

With one more component, sqrt(M^2 - |x|^2), all candidates get the norm M, and
with 0 there an anchor keeps its own; then |a - x|^2 = |a|^2 + M^2 - 2 a.x, so a
node's covering radius bounds the inner products of everything below it from
both sides. A node's points lie within its radius; its children are picked
greedily so that they cover its points at a radius smaller by ``SHRINK``, level
by level, until few points (or only equal ones) are left.

``Search`` walks all anchors of a block together, each one best bound first. A
node is left alone if, for each of the anchor's windows, its best possible score
lies below the window (or below the anchor's last held score there) or its least
possible score above it. Points of leaves are scored exactly.
"""

from __future__ import annotations

import numpy as np

SHRINK = 0.7
LEAF = 24
# Pairs of an anchor and a node or point that are scored together.
PAIRS = 1 << 16
# Nodes that each anchor opens at once, and anchors that walk a tree together.
BEAM, TOGETHER = 8, 256
# Sums of products below this are whole numbers that doubles hold exactly.
EXACT = float(1 << 53)
NO_ID = np.iinfo(np.int64).max


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows of whole numbers, exact."""
    if not len(a):
        return np.zeros(0)
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < EXACT:
        return np.einsum("ij,ij->i", a, b)
    exact = [sum(int(x) * int(y) for x, y in zip(p, q)) for p, q in zip(a.tolist(), b.tolist())]
    if any(abs(x) >= EXACT for x in exact):
        raise ValueError("a score of 2^53 or more is not held exactly")
    return np.array(exact, float)


class Tree:
    """Nodes as arrays: centre (a point), radius, range of points in ``order``, first child and number of children."""

    def __init__(self, points: np.ndarray, packed: tuple[bytes, bytes] | None = None):
        self.points = points
        self.square = np.einsum("ij,ij->i", points, points)
        self.top = float(self.square.max(initial=0.0))
        if packed is None:
            self.lift = np.sqrt(np.maximum(self.top - self.square, 0.0))
            self.order = np.arange(len(points))
            self.nodes: list[list] = []
            self._grow()
            table = np.array(self.nodes, float)
        else:
            self.order = np.frombuffer(packed[0], np.int64)
            table = np.frombuffer(packed[1], float).reshape(-1, 6)
        self.table = table
        self.radius = table[:, 1]
        self.centre, self.start, self.stop, self.child, self.children = (table[:, k].astype(np.int64) for k in (0, 2, 3, 4, 5))

    def packed(self) -> tuple[bytes, bytes]:
        return self.order.tobytes(), self.table.tobytes()

    def distances(self, centre: int, among: np.ndarray) -> np.ndarray:
        """Distances in the lifted space; all lifted points have the norm M."""
        near = self.points[among] @ self.points[centre] + self.lift[among] * self.lift[centre]
        return np.sqrt(np.maximum(2 * (self.top - near), 0.0))

    def _grow(self) -> None:
        everything = self.order
        first = int(np.argmax(self.square)) if len(everything) else 0
        away = self.distances(first, everything)
        self.nodes.append([first, float(away.max(initial=0.0)), 0, len(everything), -1, 0])
        at = 0
        while at < len(self.nodes):  # level by level, as children are put behind
            centre, radius, start, stop, _, _ = self.nodes[at]
            if stop - start > LEAF and radius > 1e-9:
                self._split(at, centre, radius, start, stop)
            at += 1

    def _split(self, at: int, centre: int, radius: float, start: int, stop: int) -> None:
        rest = self.order[start:stop].copy()
        cover, parts = radius * SHRINK, []
        while len(rest):
            away = self.distances(centre, rest)
            inside = away <= cover
            inside[rest == centre] = True
            parts.append((centre, float(away[inside].max(initial=0.0)), rest[inside]))
            rest, away = rest[~inside], away[~inside]
            if len(rest):
                centre = int(rest[np.argmax(away)])
        self.nodes[at][4:] = [len(self.nodes), len(parts)]
        for centre, reach, members in parts:
            self.order[start : start + len(members)] = members
            self.nodes.append([centre, reach, start, start + len(members), -1, 0])
            start += len(members)


class Search:
    """The best ``keep`` candidates of each anchor in each of its windows, over any number of trees.

    ``windows`` has a pair of ends (lo, hi) for each anchor and window; NaN in a
    window that asks for nothing. Higher scores come first, then smaller ids.
    """

    def __init__(self, anchors: np.ndarray, ids: np.ndarray, labels: np.ndarray, windows: np.ndarray, keep: int, same_label: bool):
        self.anchors, self.ids, self.labels = anchors, ids, labels
        self.lo, self.hi = windows[..., 0], windows[..., 1]
        self.keep, self.same = keep, same_label
        self.square = np.einsum("ij,ij->i", anchors, anchors)
        shape = (*self.lo.shape, keep)
        self.scores = np.full(shape, -np.inf)
        self.found = np.full(shape, NO_ID, np.int64)
        self.have = np.zeros(self.lo.shape, np.int64)
        self.opened = self.scored = 0

    def floor(self) -> np.ndarray:
        """The least score that still matters in each window."""
        full = self.have >= self.keep
        return np.where(full, np.maximum(self.lo, self.scores[..., -1]), self.lo)

    def bounds(self, tree: Tree, anchor: np.ndarray, node: np.ndarray):
        """Least and greatest possible score below a node, for pairs of anchor and node."""
        centre = tree.centre[node]
        middle = np.empty(len(anchor))
        for k in range(0, len(anchor), PAIRS):
            part = slice(k, k + PAIRS)
            middle[part] = np.einsum("ij,ij->i", self.anchors[anchor[part]], tree.points[centre[part]])
        total = self.square[anchor] + tree.top
        away, radius = np.sqrt(np.maximum(total - 2 * middle, 0.0)), tree.radius[node]
        # Roots of differences that almost cancel are known to about 3e-8 of the norms.
        slack = 1e-6 * total + 1e-6
        return (total - (away + radius) ** 2) / 2 - slack, (total - np.maximum(away - radius, 0.0) ** 2) / 2 + slack

    def wanted(self, anchor: np.ndarray, least: np.ndarray, most: np.ndarray, floor: np.ndarray) -> np.ndarray:
        return ((most[:, None] >= floor[anchor]) & (least[:, None] <= self.hi[anchor])).any(1)

    def visit(self, tree: Tree, ids: np.ndarray, labels: np.ndarray) -> None:
        """Look through one tree; ``ids`` and ``labels`` belong to its points."""
        if not len(ids) or not len(self.anchors):
            return
        one = labels[0] if (labels == labels[0]).all() else None
        asking = np.flatnonzero(~np.isnan(self.lo).all(1))
        if one is not None:
            asking = asking[(self.labels[asking] == one) == self.same]
        for k in range(0, len(asking), TOGETHER):
            self.descend(tree, ids, labels, asking[k : k + TOGETHER])

    def descend(self, tree: Tree, ids: np.ndarray, labels: np.ndarray, asking: np.ndarray) -> None:
        anchor, node = asking, np.zeros(len(asking), np.int64)
        least, most = self.bounds(tree, anchor, node)
        while len(anchor):
            keep = self.wanted(anchor, least, most, self.floor())
            anchor, node, least, most = anchor[keep], node[keep], least[keep], most[keep]
            if not len(anchor):
                return
            by = np.lexsort((-most, anchor))
            anchor, node, least, most = anchor[by], node[by], least[by], most[by]
            first = np.concatenate(([True], anchor[1:] != anchor[:-1]))
            rank = np.arange(len(anchor)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            now = rank < BEAM
            a, n = anchor[now], node[now]
            self.opened += len(a)
            inner = tree.children[n] > 0
            self.leaves(tree, a[~inner], n[~inner], ids, labels)
            count = tree.children[n[inner]]
            new_a = np.repeat(a[inner], count)
            new_n = np.repeat(tree.child[n[inner]] - np.cumsum(count) + count, count) + np.arange(count.sum())
            new_least, new_most = self.bounds(tree, new_a, new_n)
            anchor, node = np.concatenate((anchor[~now], new_a)), np.concatenate((node[~now], new_n))
            least, most = np.concatenate((least[~now], new_least)), np.concatenate((most[~now], new_most))

    def leaves(self, tree: Tree, anchor: np.ndarray, node: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        """Score the points of leaves; leaves of equal points may be large, so pairs are taken in pieces."""
        count = (tree.stop - tree.start)[node]
        ends = np.cumsum(count)
        for first in range(0, int(ends[-1]) if len(ends) else 0, PAIRS):
            pair = np.arange(first, min(first + PAIRS, int(ends[-1])))
            which = np.searchsorted(ends, pair, "right")
            a = anchor[which]
            p = tree.order[tree.start[node[which]] + pair - (ends - count)[which]]
            fit = ((labels[p] == self.labels[a]) == self.same) & ~(self.same & (ids[p] == self.ids[a]))
            a, p = a[fit], p[fit]
            self.scored += len(a)
            self.take(a, dots(self.anchors[a], tree.points[p]), ids[p])

    def take(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        """Merge scored candidates into the lists of all windows."""
        floor = self.floor()
        for w in range(self.lo.shape[1]):
            fit = (score >= floor[anchor, w]) & (score <= self.hi[anchor, w])
            if not fit.any():
                continue
            a, s, i = anchor[fit], score[fit], ids[fit]
            touched = np.unique(a)
            held = np.arange(self.keep)[None, :] < np.minimum(self.have[touched, w], self.keep)[:, None]
            old = np.repeat(touched, held.sum(1))
            a = np.concatenate((old, a))
            s = np.concatenate((self.scores[touched, w][held], s))
            i = np.concatenate((self.found[touched, w][held], i))
            by = np.lexsort((i, -s, a))
            a, s, i = a[by], s[by], i[by]
            first = np.concatenate(([True], a[1:] != a[:-1]))
            rank = np.arange(len(a)) - np.flatnonzero(first)[np.cumsum(first) - 1]
            good = rank < self.keep
            self.scores[a[good], w, rank[good]] = s[good]
            self.found[a[good], w, rank[good]] = i[good]
            self.have[touched, w] = np.bincount(np.searchsorted(touched, a[good]), minlength=len(touched))

    def rows(self):
        """(anchor, window, score, id) of everything held."""
        held = np.arange(self.keep) < np.minimum(self.have, self.keep)[..., None]
        anchor, window, _ = np.nonzero(held)
        return anchor, window, self.scores[held], self.found[held]
