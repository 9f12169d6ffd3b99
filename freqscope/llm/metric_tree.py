"""Metric trees by the anchors hierarchy, and nearest-entry assignment on them.

Built middle-out: about sqrt(n) anchors are chosen, each the point farthest from the
anchor of the widest ball; it takes over the points that are nearer to it, looking only at
those farther from their anchor than half the way to the new one.  The anchors' balls are
then merged in pairs, least radius first, up to one root, and each anchor's own points
are built on in the same way.  A ball caches the sum and number of its points.

Assignment goes down the tree level by level.  A ball inherits the entries that are
left for its parent and drops each entry that the ball's best one beats at every point of the
ball (strictly, so ties stay).  A ball with one entry left is wholly owned: its points
need not be looked at.  Only the points of leaves with several entries left are
compared, with integers, ties to the lower index.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAF = 32
#: relative slack of the float bounds, far above their rounding
SLACK = 1e-7


@dataclass
class Tree:
    """Node k holds the points ``order[lo[k]:hi[k]]``; the root is the last node,
    children come before their parents, -1 marks a leaf."""

    order: np.ndarray
    lo: np.ndarray
    hi: np.ndarray
    left: np.ndarray
    right: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    sums: np.ndarray


def _anchors(points: np.ndarray) -> np.ndarray:
    """The number of its anchor for each point."""
    n = len(points)
    norm = np.einsum("ij,ij->i", points, points)

    def distances(to: int, rows) -> np.ndarray:
        return np.sqrt(np.maximum(norm[rows] - 2 * (points[rows] @ points[to]) + norm[to], 0))

    owner = np.zeros(n, np.int64)
    far = distances(0, slice(None))
    pivots = [0]
    while len(pivots) < int(np.ceil(np.sqrt(n))):
        new = int(np.argmax(far))
        if far[new] == 0:
            break
        way = distances(new, np.array(pivots))
        look = np.flatnonzero(far >= way[owner] / 2)
        d = distances(new, look)
        taken = d < far[look]
        owner[look[taken]], far[look[taken]] = len(pivots), d[taken]
        owner[new], far[new] = len(pivots), 0
        pivots.append(new)
    return owner


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Tree over the rows of an integer matrix (as float64)."""
    order: list[np.ndarray] = []
    lo, hi, left, right = [], [], [], []
    size = 0

    def node(a: int, b: int, l: int = -1, r: int = -1) -> int:
        lo.append(a), hi.append(b), left.append(l), right.append(r)
        return len(lo) - 1

    def grow(rows: np.ndarray) -> tuple:
        """Nested pairs of leaves (arrays of rows)."""
        if len(rows) <= leaf:
            return (rows,)
        owner = _anchors(points[rows])
        groups = [rows[owner == k] for k in range(int(owner.max()) + 1)]
        groups = [g for g in groups if len(g)]
        if len(groups) == 1:
            return (rows,)
        kids = [grow(g) for g in groups]
        count = np.array([len(g) for g in groups], float)
        centre = np.array([points[g].mean(axis=0) for g in groups])
        radius = np.array([np.sqrt(((points[g] - c) ** 2).sum(axis=1).max()) for g, c in zip(groups, centre)])
        live = list(range(len(groups)))
        cost = np.full((len(groups), len(groups)), np.inf)

        def reach(k: int, others: np.ndarray) -> np.ndarray:
            share = (count[others] / (count[others] + count[k]))
            apart = np.sqrt(((centre[others] - centre[k]) ** 2).sum(axis=1))
            return np.maximum(share * apart + radius[k], (1 - share) * apart + radius[others])

        for k in live:
            rest = np.arange(k + 1, len(groups))
            cost[k, rest] = reach(k, rest)
        while len(live) > 1:
            a, b = divmod(int(np.argmin(cost)), len(groups))
            r = cost[a, b]
            kids[a] = (kids[a], kids[b])
            centre[a] = (centre[a] * count[a] + centre[b] * count[b]) / (count[a] + count[b])
            count[a] += count[b]
            radius[a] = r
            cost[b, :] = cost[:, b] = np.inf
            live.remove(b)
            rest = np.array([k for k in live if k != a], np.int64)
            if len(rest):
                c = reach(a, rest)
                cost[np.minimum(a, rest), np.maximum(a, rest)] = c
        return kids[live[0]]

    def lay(tree: tuple) -> int:
        nonlocal size
        todo, done = [(tree, False)], []
        while todo:
            t, ready = todo.pop()
            if len(t) == 1:
                order.append(t[0])
                done.append(node(size, size + len(t[0])))
                size += len(t[0])
            elif not ready:
                todo += [(t, True), (t[1], False), (t[0], False)]
            else:
                r, l = done.pop(), done.pop()
                done.append(node(lo[l], hi[r], l, r))
        return done[0]

    lay(grow(np.arange(len(points))))
    at = np.concatenate(order)
    placed = points[at]
    total = np.concatenate([np.zeros((1, points.shape[1])), np.cumsum(placed, axis=0)])
    a, b = np.array(lo), np.array(hi)
    sums = total[b] - total[a]
    centre = sums / (b - a)[:, None]
    radius = np.array([np.sqrt(((placed[x:y] - c) ** 2).sum(axis=1).max()) for x, y, c in zip(a, b, centre)])
    return Tree(at, a, b, np.array(left), np.array(right), centre, radius, sums)


def _squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances; exact for integers whose squares' sums stay below 2^53."""
    return (points * points).sum(axis=1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(axis=1)[None, :]


def assign(tree: Tree, points: np.ndarray, entries: np.ndarray, stats: dict | None = None):
    """(balls, owners, rows, nearest): balls wholly owned by one entry each, and the
    rows of all other points with their nearest entry."""
    apart = np.sqrt(np.maximum(_squares(entries, entries), 0))
    nodes = np.array([len(tree.lo) - 1])
    left = np.ones((1, len(entries)), bool)
    balls, owners, rows, nearest = [], [], [], []
    while len(nodes):
        d = _squares(tree.centre[nodes], entries)
        d[~left] = np.inf
        best = np.argmin(d, axis=1)
        mine = d[np.arange(len(nodes)), best][:, None]
        gap = d - mine - 2 * tree.radius[nodes][:, None] * apart[best]
        left &= gap <= SLACK * (1 + np.where(left, d, 0) + mine)
        if stats is not None:
            stats["tests"] = stats.get("tests", 0) + int(np.isfinite(d).sum())
        one = left.sum(axis=1) == 1
        balls.append(nodes[one])
        owners.append(best[one])
        leaf = ~one & (tree.left[nodes] < 0)
        for k in np.flatnonzero(leaf):
            here = tree.order[tree.lo[nodes[k]]:tree.hi[nodes[k]]]
            some = np.flatnonzero(left[k])
            rows.append(here)
            nearest.append(some[np.argmin(_squares(points[here], entries[some]), axis=1)])
            if stats is not None:
                stats["tests"] += len(here) * len(some)
        down = ~one & ~leaf
        nodes = np.concatenate([tree.left[nodes[down]], tree.right[nodes[down]]])
        left = np.concatenate([left[down], left[down]])
    flat = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return flat(balls), flat(owners), flat(rows), flat(nearest)


def entry_sums(tree: Tree, points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum of the points, number of points) of each entry, from cached sums where balls are owned."""
    balls, owners, rows, nearest = assign(tree, points, entries)
    sums, count = np.zeros(entries.shape), np.zeros(len(entries))
    np.add.at(sums, owners, tree.sums[balls])
    np.add.at(count, owners, tree.hi[balls] - tree.lo[balls])
    np.add.at(sums, nearest, points[rows])
    np.add.at(count, nearest, 1)
    return sums, count


def codes(tree: Tree, points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """The nearest entry of each point."""
    balls, owners, rows, nearest = assign(tree, points, entries)
    out = np.empty(len(points), np.int64)
    for b, o in zip(balls, owners):
        out[tree.order[tree.lo[b]:tree.hi[b]]] = o
    out[rows] = nearest
    return out
