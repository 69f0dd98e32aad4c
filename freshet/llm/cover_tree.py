"""Cover trees over unit vectors, and the dual traversal of two of them.

A node of level k holds points within 2^(1-k) of its centre; its children, at half
that radius, are a net of its points whose first centre is its own. Nodes carry the
radius that really covers them. A pair of nodes is pruned when its centres are too far
apart for any link, and taken whole when they are so close that all their points link.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 24  # points below which a node is not divided
BLOCK = 1 << 17  # pairs of points that are compared at once rather than divided further
STEP = 1000  # pairs of points that are compared in the time of one step of the traversal
SLACK = 1e-6  # by which bounds must be met before they decide


def distance(cosine: np.ndarray) -> np.ndarray:
    """Euclidean distance of unit vectors by their cosine."""
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


@dataclass
class CoverTree:
    """Points in tree order, and per node its range of points, children, centre and radius."""

    points: np.ndarray  # unit vectors
    place: np.ndarray  # where each of them was before
    nodes: np.ndarray  # first point, last point + 1, first child, last child + 1, centre
    radius: np.ndarray

    @classmethod
    def of(cls, units: np.ndarray) -> CoverTree:
        order = np.arange(len(units))
        nodes, radii = [], []
        queue = [(0, len(units), 0, 2.0)]  # first point, last + 1, centre, radius of the level
        at = 0
        while at < len(queue):
            first, last, centre, reach = queue[at]
            at += 1
            members = order[first:last]
            away = distance(units[members] @ units[centre])
            radius = float(away.max()) if len(members) else 0.0
            children = len(queue)
            if len(members) > LEAF and radius > 0:
                # Levels that a node's points do not fill are passed over.
                half = reach / 2
                while half >= radius:
                    half /= 2
                parts, rest, seed = [], members, centre
                while len(rest):
                    near = distance(units[rest] @ units[seed]) <= half
                    near[rest == seed] = True
                    parts.append((seed, rest[near]))
                    rest = rest[~near]
                    seed = rest[0] if len(rest) else -1
                start = first
                for seed, part in parts:
                    order[start : start + len(part)] = part
                    queue.append((start, start + len(part), seed, half))
                    start += len(part)
            nodes.append((first, last, children, len(queue), centre))
            radii.append(radius)
        table = np.array(nodes, dtype=np.int64).reshape(-1, 5)
        where = np.empty(len(order), dtype=np.int64)
        where[order] = np.arange(len(order))
        table[:, 4] = where[table[:, 4]] if len(order) else 0
        return cls(units[order], order, table, np.array(radii))


class Links:
    """What a traversal finds: partners per point of either side, and local components."""

    def __init__(self, left: CoverTree, right: CoverTree, copies_left, copies_right, cosine: float):
        self.trees, self.cosine = (left, right), cosine
        self.same = left is right
        self.reach = float(distance(np.array(cosine)))
        # Copies in tree order: a link to a class is a link to each of its copies.
        self.copies = tuple(
            copies[tree.place].astype(np.float64)
            for copies, tree in ((copies_left, left), (copies_right, right))
        )
        self.partners = [np.zeros(len(left.points), dtype=np.int64)]
        self.partners.append(self.partners[0] if self.same else np.zeros(len(right.points), np.int64))
        self.shift = 0 if self.same else len(left.points)
        self.parent = np.arange(self.shift + len(right.points))

    def _root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = int(self.parent[x])
        return x

    def _join(self, x: int, y: int) -> None:
        x, y = self._root(x), self._root(y)
        if x != y:
            self.parent[max(x, y)] = min(x, y)

    def _block(self, a0: int, a1: int, b0: int, b1: int, linked: np.ndarray | None) -> None:
        """Count the links of two ranges of points; None means that all link."""
        if linked is None:
            linked = np.ones((a1 - a0, b1 - b0), dtype=bool)
        else:
            linked = linked.copy()
        mirrored = self.same and a0 == b0
        if mirrored:
            np.fill_diagonal(linked, False)
        if not linked.any():
            return
        self.partners[0][a0:a1] += (linked @ self.copies[1][b0:b1]).astype(np.int64)
        if not mirrored:
            self.partners[1][b0:b1] += (linked.T @ self.copies[0][a0:a1]).astype(np.int64)
        rows = np.flatnonzero(linked.any(axis=1))
        firsts = linked[rows].argmax(axis=1)
        for i, j in zip(rows.tolist(), firsts.tolist(), strict=True):
            self._join(a0 + i, self.shift + b0 + j)
        # Columns that share a row are in one component: join each with its first row.
        columns = np.flatnonzero(linked.any(axis=0))
        for j, i in zip(columns.tolist(), linked[:, columns].argmax(axis=0).tolist(), strict=True):
            self._join(a0 + i, self.shift + b0 + j)
        self._rest(linked, a0, b0)

    def _compare(self, a0: int, a1: int, b0: int, b1: int) -> None:
        left, right = self.trees
        self._block(a0, a1, b0, b1, left.points[a0:a1] @ right.points[b0:b1].T >= self.cosine)

    def _rest(self, linked: np.ndarray, a0: int, b0: int) -> None:
        """Join what first rows and columns left apart though some link connects it."""
        rows, columns = np.nonzero(linked)
        while True:
            left = np.array([self._root(a0 + i) for i in range(linked.shape[0])])
            right = np.array([self._root(self.shift + b0 + j) for j in range(linked.shape[1])])
            apart = np.flatnonzero(left[rows] != right[columns])
            if not len(apart):
                return
            pairs = np.unique(np.stack([left[rows[apart]], right[columns[apart]]]), axis=1)
            for x, y in pairs.T.tolist():
                self._join(x, y)

    def find(self) -> Links:
        left, right = self.trees
        stack = [(0, 0)]
        while stack:
            a, b = stack.pop()
            a0, a1, ac0, ac1, a_at = left.nodes[a].tolist()
            b0, b1, bc0, bc1, b_at = right.nodes[b].tolist()
            if self.same and a == b:
                apart = 0.0
            else:
                apart = float(distance(left.points[a_at] @ right.points[b_at]))
            cover = left.radius[a] + right.radius[b]
            if apart - cover > self.reach + SLACK:
                continue
            if apart + cover < self.reach - SLACK:
                self._block(a0, a1, b0, b1, None)
                continue
            divided = ac1 > ac0 or bc1 > bc0
            if not divided or (a1 - a0) * (b1 - b0) <= BLOCK:
                self._compare(a0, a1, b0, b1)
                continue
            a_kids = np.arange(ac0, ac1) if ac1 > ac0 else np.array([a])
            b_kids = np.arange(bc0, bc1) if bc1 > bc0 else np.array([b])
            between = distance(
                left.points[left.nodes[a_kids, 4]] @ right.points[right.nodes[b_kids, 4]].T
            )
            cover = left.radius[a_kids][:, None] + right.radius[b_kids]
            close = between - cover <= self.reach + SLACK
            if self.same and a == b:
                close &= a_kids[:, None] <= b_kids
            if close.sum() * STEP > (a1 - a0) * (b1 - b0):
                # Hardly anything is ruled out, as in a dense group: compare the points.
                self._compare(a0, a1, b0, b1)
                continue
            for i, j in zip(*np.nonzero(close), strict=True):
                stack.append((int(a_kids[i]), int(b_kids[j])))
        return self

    def found(self, ids_left: np.ndarray, ids_right: np.ndarray) -> list[tuple[int, int, int]]:
        """Per linked point: its id, its partners, and the smallest id of its component here."""
        ids = ids_left[self.trees[0].place]
        if not self.same:
            ids = np.concatenate([ids, ids_right[self.trees[1].place]])
        partners = self.partners[0] if self.same else np.concatenate(self.partners)
        linked = np.flatnonzero(partners)
        roots = np.array([self._root(int(x)) for x in linked], dtype=np.int64)
        least: dict[int, int] = {}
        for x, root in zip(linked.tolist(), roots.tolist(), strict=True):
            least[root] = min(least.get(root, int(ids[x])), int(ids[x]))
        return [
            (int(ids[x]), int(partners[x]), least[root])
            for x, root in zip(linked.tolist(), roots.tolist(), strict=True)
        ]
