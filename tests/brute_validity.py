"""Validity by comparing all segments of a geometry with all: what the edge joins must give."""

import numpy as np

from trowel.functions.planar import _cross, inside, touching
from trowel.functions.wkb import HOLE, LINE, SHELL

COLLECTION = 7


def _share_a_line(p: np.ndarray, q: np.ndarray) -> bool:
    """Whether any of the touching segment pairs lie on one line and overlap there."""
    on_line = (_cross(*p.T, q[:, 0], q[:, 1]) == 0) & (_cross(*p.T, q[:, 2], q[:, 3]) == 0)
    axis = (np.abs(p[:, 2] - p[:, 0]) < np.abs(p[:, 3] - p[:, 1])).astype(int)  # the longer one
    n = np.arange(len(p))
    p1, p2, q1, q2 = p[n, axis], p[n, 2 + axis], q[n, axis], q[n, 2 + axis]
    over = np.minimum(np.maximum(p1, p2), np.maximum(q1, q2)) - np.maximum(np.minimum(p1, p2), np.minimum(q1, q2))
    return bool((on_line & (over > 0)).any())


def _sides(ring: np.ndarray, area: np.ndarray) -> tuple[bool, bool]:
    """Whether parts of a ring's border lie inside and outside an area whose border it touches
    in single points at most: judged at the middle of each stretch between such points."""
    stops = [np.array([0.0, 1.0])] * len(ring)
    for j, i in touching(ring, area):
        for n, e in zip(j, area[i]):
            x1, y1, x2, y2 = ring[n]
            dx, dy, ex, ey = x2 - x1, y2 - y1, e[2] - e[0], e[3] - e[1]
            cross = dx * ey - dy * ex
            if cross:
                stops[n] = np.append(stops[n], ((e[0] - x1) * ey - (e[1] - y1) * ex) / cross)
    within = without = False
    for (x1, y1, x2, y2), at in zip(ring, stops):
        at = np.unique(at.clip(0, 1))
        for t in (at[1:] + at[:-1]) / 2:
            if inside(x1 + t * (x2 - x1), y1 + t * (y2 - y1), area):
                within = True
            else:
                without = True
        if within and without:
            break
    return within, without


def invalid_reason(rings, gtype: int | None = None) -> str | None:
    """Why a geometry is invalid; None if it is valid.

    Rings of a polygon, and shells of a multipolygon, may touch in points but neither cross
    nor share a line; holes lie in their shell and not in each other. The members of a
    collection are judged one by one.
    """
    for _, kind, pts in rings:
        xy = pts[:, :2]
        if not np.isfinite(xy).all():
            return "coordinate not finite"
        if kind == LINE and (len(xy) < 2 or (xy == xy[0]).all()):
            return "too few points"
        if kind in (SHELL, HOLE):
            if len(xy) < 4:
                return "too few points"
            if not np.array_equal(xy[0], xy[-1]):
                return "ring not closed"
    cleaned = []
    for part, kind, pts in rings:
        if kind in (SHELL, HOLE):
            xy = pts[:, :2]
            keep = np.r_[True, (xy[1:] != xy[:-1]).any(axis=1)]
            xy = xy[keep]
            if len(xy) < 4:
                return "too few points"
            edges = np.hstack([xy[:-1], xy[1:]])
            n = len(edges)
            for i, j in touching(edges, edges):
                apart = (i < j) & ~((j - i == 1) | ((i == 0) & (j == n - 1)))
                if apart.any():
                    return "ring crosses itself"
                # neighbours may share only their common corner
                back = (i < j) & ~apart
                u = edges[i[back], 2:] - edges[i[back], :2]
                v = edges[j[back], 2:] - edges[j[back], :2]
                folded = (u[:, 0] * v[:, 1] == u[:, 1] * v[:, 0]) & ((u * v).sum(axis=1) < 0)
                if folded.any():
                    return "ring folds back"
            cleaned.append((part, kind, xy, edges))
    for m, (part_a, kind_a, _, a) in enumerate(cleaned):
        for part_b, kind_b, _, b in cleaned[m + 1 :]:
            if part_a != part_b and gtype == COLLECTION:
                continue
            touch = False
            for i, j in touching(a, b):
                touch = True
                if _share_a_line(a[i], b[j]):
                    return "rings share a line"
            b_in, b_out = _sides(b, a) if touch else (inside(*b[0, :2], a), not inside(*b[0, :2], a))
            if b_in and b_out:
                return "rings cross"
            a_in = _sides(a, b)[0] if touch else inside(*a[0, :2], b)
            if part_a == part_b and kind_a == SHELL and b_out:
                return "hole outside shell"
            if part_a == part_b and kind_a == kind_b == HOLE and (a_in or b_in):
                return "nested holes"
            if part_a != part_b and kind_a == kind_b == SHELL and (a_in or b_in):
                outer, ring = (part_b, a) if a_in else (part_a, b)
                holes = [c[3] for c in cleaned if c[0] == outer and c[1] == HOLE]
                if not any(_sides(ring, h) == (True, False) for h in holes):
                    return "nested shells"
    return None
