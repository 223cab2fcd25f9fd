"""Metric trees by the anchors hierarchy, for assigning points to the nearest of a list of entries.

A block's points are first dealt to about sqrt(n) anchors: each new anchor is the point farthest from the anchor that
owns it, and takes from the others what lies nearer to it; an anchor's points are kept by falling distance, so taking
stops where the triangle inequality says that no further point can be nearer.  From this middle the tree grows up,
by joining the two balls that make the smallest one, and down, by anchors inside an anchor's points.  Every ball keeps
its centre, radius, count and sum.
"""

from __future__ import annotations

import numpy as np

#: A ball of at most so many points has no children.
LEAF = 24
#: Components of points and entries up to this size are handled exactly in floating point: a squared distance of up
#: to 2**8 of them stays below 2**53.
PLAIN = 1 << 21


def anchors(points: np.ndarray, k: int) -> list[np.ndarray]:
    """The points (numbers) of up to ``k`` anchors."""
    d = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    by = np.argsort(-d, kind="stable")
    owned, far, centre = [by], [d[by]], [points[0]]
    while len(owned) < k:
        widest = max(range(len(owned)), key=lambda i: far[i][0])
        if far[widest][0] == 0:
            break
        new = points[owned[widest][0]]
        apart = np.sqrt(((np.array(centre) - new) ** 2).sum(axis=1))
        mine, mine_far = [], []
        for i, gap in enumerate(apart):
            reach = int(np.searchsorted(-far[i], -gap / 2, side="right"))  # nearer to their anchor than half the gap: they stay
            if not reach:
                continue
            some = owned[i][:reach]
            to_new = np.sqrt(((points[some] - new) ** 2).sum(axis=1))
            take = to_new < far[i][:reach]
            if not take.any():
                continue
            mine.append(some[take]), mine_far.append(to_new[take])
            stay = np.r_[~take, np.ones(len(owned[i]) - reach, bool)]
            owned[i], far[i] = owned[i][stay], far[i][stay]
        mine, mine_far = np.concatenate(mine), np.concatenate(mine_far)
        by = np.argsort(-mine_far, kind="stable")
        owned.append(mine[by]), far.append(mine_far[by]), centre.append(new)
    return owned


class BallTree:
    """``order``: the points' numbers, so that ball i holds ``order[first[i]:past[i]]``; ``children`` bounds the
    balls right below it, which lie side by side (none: a leaf).  Ball 0 holds all points."""

    def __init__(self, points: np.ndarray):
        self.order = np.arange(len(points))
        self.first, self.past, self.below = [0], [len(points)], [(0, 0)]
        if len(points) > LEAF and np.abs(points).max(initial=0) <= PLAIN:
            self._grow(points.astype(np.float64))
        self.first, self.past = np.array(self.first, np.int32), np.array(self.past, np.int32)
        self.children = np.array(self.below, np.int32).reshape(-1, 2)
        held = points[self.order]
        size = (self.past - self.first).astype(np.int64)
        if np.abs(points).max(initial=0) <= PLAIN:
            sums = np.concatenate([np.zeros((1, points.shape[1]), np.int64), np.cumsum(held.astype(np.int64), axis=0)])
            self.sums = sums[self.past] - sums[self.first]
            self.centre = self.sums / np.maximum(size, 1)[:, None]
            self.radius = np.array([np.sqrt(((held[a:b] - c) ** 2).sum(axis=1).max(initial=0.0)) for a, b, c in zip(self.first, self.past, self.centre, strict=True)])
        else:  # one ball of any reach; its sums are never taken whole
            self.sums, self.centre = np.zeros((1, points.shape[1]), np.int64), np.zeros((1, points.shape[1]))
            self.radius = np.array([np.inf])

    def _grow(self, points: np.ndarray) -> None:
        middle = anchors(points, int(np.ceil(np.sqrt(len(points)))))
        if len(middle) < 2:
            return
        # upwards: a ball over two balls has the radius (r + s + distance) / 2, or that of the one that holds the other
        nodes: list = [(m, None) for m in middle]
        centre = np.array([points[m].mean(axis=0) for m in middle])
        radius = np.array([np.sqrt(((points[m] - c) ** 2).sum(axis=1).max()) for m, c in zip(middle, centre, strict=True)])
        gap = np.sqrt(np.maximum(((centre[:, None] - centre[None]) ** 2).sum(axis=2), 0))
        cost = np.maximum((gap + radius[:, None] + radius[None]) / 2, np.maximum(radius[:, None], radius[None]))
        np.fill_diagonal(cost, np.inf)
        count = np.array([len(m) for m in middle], float)
        top = 0
        for _ in range(len(middle) - 1):
            i, j = np.unravel_index(np.argmin(cost), cost.shape)
            nodes[i] = (None, (nodes[i], nodes[j]))
            centre[i] = (centre[i] * count[i] + centre[j] * count[j]) / (count[i] + count[j])
            radius[i], count[i] = cost[i, j], count[i] + count[j]
            cost[j], cost[:, j], radius[j] = np.inf, np.inf, np.inf
            far = np.sqrt(((centre - centre[i]) ** 2).sum(axis=1))
            row = np.maximum((far + radius + radius[i]) / 2, np.maximum(radius, radius[i]))
            row[i] = np.inf
            cost[i], cost[:, i], top = row, row, i
        # downwards, level by level, so that the children of a ball lie side by side
        held: list[np.ndarray] = []
        self._layout(points, nodes[top], held)

    def _layout(self, points: np.ndarray, root, out: list) -> None:
        def members(node):
            stack, found = [node], []
            while stack:
                own, pair = stack.pop()
                if pair is None:
                    found.append(own)
                else:
                    stack += [pair[1], pair[0]]
            return np.concatenate(found)

        self.order = members(root)
        level = [(0, root)]
        while level:
            nxt = []
            for i, (own, pair) in level:
                if pair is None:
                    if len(own) <= LEAF:
                        continue
                    parts = anchors(points[own], int(np.ceil(np.sqrt(len(own)))))
                    if len(parts) < 2:
                        continue
                    kids = [(own[p], None) for p in parts]
                    self.order[self.first[i]:self.past[i]] = np.concatenate([k for k, _ in kids])
                else:
                    kids = list(pair)
                begin, at = len(self.first), self.first[i]
                for kid in kids:
                    n = len(kid[0]) if kid[1] is None else len(members(kid))
                    self.first.append(at), self.past.append(at + n), self.below.append((0, 0))
                    nxt.append((len(self.first) - 1, kid))
                    at += n
                self.below[i] = (begin, len(self.first))
            level = nxt


def _exact(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) with whole numbers of any size; ties to the first."""
    best, least = np.zeros(len(points), np.int64), np.zeros(len(points), object)
    entries = [[int(x) for x in e] for e in entries]
    for i, p in enumerate(points):
        p = [int(x) for x in p]
        d = [sum((a - b) ** 2 for a, b in zip(p, e, strict=True)) for e in entries]
        least[i] = min(d)
        best[i] = d.index(least[i])
    return best, least


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest entry, squared distance) of each point, exactly; ties to the smaller number."""
    if max(np.abs(points).max(initial=0), np.abs(entries).max(initial=0)) > PLAIN:
        return _exact(points, entries)
    p, e = points.astype(np.float64), entries.astype(np.float64)
    d = (p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)[None]
    best = d.argmin(axis=1)
    return best, d[np.arange(len(p)), best].astype(np.int64)


def owners(tree: BallTree, points: np.ndarray, entries: np.ndarray, ball, each) -> None:
    """Hand the tree's points to their nearest entries, ball by ball: ``ball(i, entry)`` where a whole ball has one
    owner, else ``each(numbers of points, entries, squared distances)`` for a leaf.

    A ball inherits the entries that may own points of the ball above; those whose distance to its centre passes the
    least by two radii leave the list.  Bounds are widened by what rounding can do, so ties stay on the list."""
    e = np.clip(entries.astype(np.float64), -1e100, 1e100)
    wide = np.sqrt((e * e).sum(axis=1))
    level = [(0, np.arange(len(entries)))]
    while level:
        nxt = []
        for i, some in level:
            if len(some) > 1:
                centre, radius = tree.centre[i], tree.radius[i]
                far = np.sqrt(((e[some] - centre) ** 2).sum(axis=1))
                slack = 1e-9 * (1 + wide[some] + np.sqrt((centre * centre).sum()))
                some = some[far - slack - radius <= (far + slack).min() + radius]
            a, b = tree.children[i]
            if len(some) == 1 and np.isfinite(tree.radius[i]):
                ball(i, int(some[0]))
            elif a == b:
                at = tree.order[tree.first[i]:tree.past[i]]
                best, d = nearest(points[at], entries[some])
                each(at, some[best], d)
            else:
                nxt += [(k, some) for k in range(a, b)]
        level = nxt
