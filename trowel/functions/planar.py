"""Exact planar tests on batches of geometries."""

from __future__ import annotations

import numpy as np

from trowel.functions.wkb import (
    HOLE, LINE, POINT, SHELL, Batch, read_rings, write_rings)

_PAIRS_AT_ONCE = 1_000_000


def segments(rings, kinds=(POINT, LINE, SHELL, HOLE)) -> np.ndarray:
    """Rows x1, y1, x2, y2; a point is a segment of length zero."""
    out = [np.empty((0, 4))]
    for _, kind, pts in rings:
        if kind in kinds and len(pts):
            xy = pts[:, :2]
            out.append(np.hstack([xy[:-1], xy[1:]]) if len(xy) > 1 else np.hstack([xy, xy]))
    return np.vstack(out)


def _cross(ax, ay, bx, by, cx, cy):
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def touching(a: np.ndarray, b: np.ndarray):
    """Index pairs of segments of `a` and `b` that share a point, batch by batch."""
    if not len(a) or not len(b):
        return
    step = max(1, _PAIRS_AT_ONCE // len(b))
    bx1, by1, bx2, by2 = b.T
    for start in range(0, len(a), step):
        ax1, ay1, ax2, ay2 = (v[:, None] for v in a[start : start + step].T)
        near = (
            (np.minimum(ax1, ax2) <= np.maximum(bx1, bx2))
            & (np.maximum(ax1, ax2) >= np.minimum(bx1, bx2))
            & (np.minimum(ay1, ay2) <= np.maximum(by1, by2))
            & (np.maximum(ay1, ay2) >= np.minimum(by1, by2))
        )
        i, j = np.nonzero(near)
        p, q = a[start + i], b[j]
        s1 = np.sign(_cross(*p.T, q[:, 0], q[:, 1])) * np.sign(_cross(*p.T, q[:, 2], q[:, 3]))
        s2 = np.sign(_cross(*q.T, p[:, 0], p[:, 1])) * np.sign(_cross(*q.T, p[:, 2], p[:, 3]))
        hit = (s1 <= 0) & (s2 <= 0)
        if hit.any():
            yield start + i[hit], j[hit]


def any_touch(a: np.ndarray, b: np.ndarray) -> bool:
    return next(touching(a, b), None) is not None


def inside(x: float, y: float, edges: np.ndarray) -> bool:
    """Even-odd test; the border itself is left to `any_touch`."""
    x1, y1, x2, y2 = edges.T
    spans = (y1 <= y) != (y2 <= y)
    at = x1[spans] + (y - y1[spans]) / (y2[spans] - y1[spans]) * (x2[spans] - x1[spans])
    return bool(np.count_nonzero(at > x) % 2)


class Segments:
    """The segments of a batch of geometries, in row order; points have length zero."""

    def __init__(self, bufs):
        g = Batch(bufs)
        self.gtype, self.kind = g.gtype, g.kind
        lengths = np.diff(g.at)
        single = lengths == 1
        ring = np.repeat(np.arange(len(lengths)), lengths)
        here = np.arange(len(g.x))
        last = np.zeros(len(g.x), dtype=bool)
        last[g.at[1:][lengths > 0] - 1] = True
        here = here[~last | single[ring]]
        there = np.where(last[here], here, here + 1)
        self.xy = np.column_stack([g.x[here], g.y[here], g.x[there], g.y[there]])
        self.ring = ring[here]
        self.row = g.row[self.ring] if len(here) else np.empty(0, dtype=np.int32)
        rows = np.arange(g.rows + 1)
        self.at = np.searchsorted(self.row, rows)
        # one point per ring: rings that do not touch lie wholly in or out
        heads = g.at[:-1][lengths > 0]
        self.heads = np.column_stack([g.x[heads], g.y[heads]])
        self.head_row = g.row[lengths > 0]

    def areas(self):
        """Segments of polygon rings with their row offsets."""
        keep = self.kind[self.ring] >= SHELL if len(self.ring) else np.empty(0, dtype=bool)
        row = self.row[keep]
        return self.xy[keep], np.searchsorted(row, np.arange(len(self.at)))


def _matched(item_row, at):
    """Pair each item with the range of its row: (item, member) indexes, in batches."""
    sizes = (at[1:] - at[:-1])[item_row]
    ends = np.cumsum(sizes)
    start = 0
    while start < len(item_row):
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + _PAIRS_AT_ONCE, "right")))
        size = sizes[start:stop]
        item = np.repeat(np.arange(start, stop), size)
        member = (np.arange(len(item)) - np.repeat(np.cumsum(size) - size, size)
                  + at[item_row[item]])
        yield item, member
        start = stop


def _segments_meet(p, q):
    near = ((np.minimum(p[:, 0], p[:, 2]) <= np.maximum(q[:, 0], q[:, 2]))
            & (np.maximum(p[:, 0], p[:, 2]) >= np.minimum(q[:, 0], q[:, 2]))
            & (np.minimum(p[:, 1], p[:, 3]) <= np.maximum(q[:, 1], q[:, 3]))
            & (np.maximum(p[:, 1], p[:, 3]) >= np.minimum(q[:, 1], q[:, 3])))
    s1 = np.sign(_cross(*p.T, q[:, 0], q[:, 1])) * np.sign(_cross(*p.T, q[:, 2], q[:, 3]))
    s2 = np.sign(_cross(*q.T, p[:, 0], p[:, 1])) * np.sign(_cross(*q.T, p[:, 2], p[:, 3]))
    return near & (s1 <= 0) & (s2 <= 0)


def rows_touching(a: np.ndarray, a_row, b: np.ndarray, b_at, rows: int) -> np.ndarray:
    """Per row: whether any of its segments in `a` meets one of its segments in `b`."""
    out = np.zeros(rows, dtype=bool)
    for item, member in _matched(a_row, b_at):
        out[a_row[item[_segments_meet(a[item], b[member])]]] = True
    return out


def _crossings(points, row, edges, at, low, high, along=0) -> np.ndarray:
    """Per point: borders met going along an axis, strictly above low, up to high."""
    out = np.zeros(len(points), dtype=np.int64)
    across = 1 - along
    for item, member in _matched(row, at):
        p, e = points[item], edges[member]
        spans = (e[:, across] <= p[:, across]) != (e[:, 2 + across] <= p[:, across])
        item, p, e = item[spans], p[spans], e[spans]
        share = (p[:, across] - e[:, across]) / (e[:, 2 + across] - e[:, across])
        place = e[:, along] + share * (e[:, 2 + along] - e[:, along])
        passed = (place > low[item]) & (place <= high[item])
        out += np.bincount(item[passed], minlength=len(points))
    return out


def points_inside(points, row, edges, at) -> np.ndarray:
    """Even-odd test per point; the border itself is left to the touch test."""
    far = np.full(len(points), np.inf)
    return _crossings(points, row, edges, at, points[:, 0], far) % 2 == 1


def intersects(bufs_a, bufs_b) -> list[bool | None]:
    """Per row: whether two geometries share a point, borders included."""
    a, b = Segments(bufs_a), Segments(bufs_b)
    n = len(bufs_a)
    out = rows_touching(a.xy, a.row, b.xy, b.at, n)
    for area, other in ((a, b), (b, a)):
        edges, at = area.areas()
        open_heads = ~out[other.head_row]
        heads, row = other.heads[open_heads], other.head_row[open_heads]
        out[row[points_inside(heads, row, edges, at)]] = True
    for i in range(n):
        # the areas of a collection may overlap: look at them one by one
        if not out[i] and 7 in (a.gtype[i], b.gtype[i]):
            out[i] = _parts_intersect(bufs_a[i], bufs_b[i])
    return [None if p is None or q is None else bool(hit)
            for p, q, hit in zip(bufs_a, bufs_b, out)]


def _parts_intersect(buf_a, buf_b) -> bool:
    sides = []
    for buf in (buf_a, buf_b):
        parts: dict[int, list] = {}
        for ring in read_rings(buf)[1]:
            parts.setdefault(ring[0], []).append(ring)
        sides.append(list(parts.values()))
    for areas, others in (sides, sides[::-1]):
        heads = [pts[0, :2] for other in others for _, _, pts in other]
        for part in areas:
            edges = segments(part, (SHELL, HOLE))
            if any(inside(x, y, edges) for x, y in heads):
                return True
    return False


# The reference point of a tile sits at odd fractions, off the usual round coordinates.
_REF = (0.41421356237309503, 0.3660254037844386)


STEP = 2  # a tile is split into 4 x 4
_CHILDREN = np.array([(x, y) for x in range(1 << STEP) for y in range(1 << STEP)], dtype=np.int64)


def _expanded(count):
    """Item and number within the item for ``count`` rows of each item."""
    item = np.repeat(np.arange(len(count)), count)
    return item, np.arange(len(item)) - np.repeat(np.cumsum(count) - count, count)


def _reach(tile, edge, edges, low, high, first, last, level, cell):
    """Pairs of tile and edge, and the place (x, y) of each: the tiles from ``first`` to ``last`` of
    each pair that the edge comes into. Rounding may let an edge in that only comes close, never
    leave one out."""
    first = np.maximum(first, low[edge] >> level)
    wide, high_ = (np.minimum(last, high[edge] >> level) - first + 1).clip(0).T
    pair, n = _expanded(wide * high_)
    place = first[pair] + np.column_stack([n // high_[pair], n % high_[pair]])
    tile, edge, side = tile[pair], edge[pair], cell * 2.0 ** level
    several = np.flatnonzero((wide * high_)[pair] > 1)  # an edge within one tile comes into it
    x1, y1, x2, y2 = edges[edge[several]].T
    x, y = ((place[several] + 0.5) * side).T
    slack = side * (0.5 + 1e-9) + 1e-14 * (np.abs(edges).max() + side)
    kept = np.full(len(pair), True)
    kept[several] = np.abs(_cross(x1, y1, x2, y2, x, y)) <= (np.abs(x2 - x1) + np.abs(y2 - y1)) * slack
    return tile[kept], edge[kept], place[kept]


def _inside_tiles(edges, cells, side) -> np.ndarray:
    """Per tile: whether its reference point lies inside. Every row of tiles is met once by
    every edge that spans it, so the work is that of the borders, not of edges times tiles."""
    rows, row = np.unique(cells[:, 1], return_inverse=True)
    y = (rows + _REF[1]) * side
    x1, y1, x2, y2 = edges.T
    first = np.searchsorted(y, np.minimum(y1, y2))
    count = np.searchsorted(y, np.maximum(y1, y2)) - first
    e, at_row = _expanded(count)
    at_row += first[e]
    at = x1[e] + (y[at_row] - y1[e]) / (y2[e] - y1[e]) * (x2[e] - x1[e])
    points = (cells[:, 0] + _REF[0]) * side
    # borders and points in one order; a border at the point itself comes before it
    point = np.repeat([False, True], [len(at), len(points)])
    order = np.lexsort((point, np.concatenate([at, points]), np.concatenate([at_row, row])))
    passed = np.empty(len(order), dtype=np.int64)
    passed[order] = np.cumsum(~point[order])
    total = np.cumsum(np.bincount(at_row, minlength=len(rows)))
    return (total[row] - passed[len(at):]) % 2 == 1


def tiles(rings, cell: float):
    """Cut a polygon layer feature into square tiles of sides ``cell`` times powers of 4.

    Only tiles that an edge comes into are split, down to ``cell``; those without edges stay
    whole, so the number of tiles follows the length of the borders. Yields per level
    (level, tiles, inside, offsets, edges): whether the reference point of a tile lies inside, and
    the edges that reach into it. Tiles wholly outside are left out.
    """
    edges = segments(rings, (SHELL, HOLE))
    if not len(edges):
        return
    low = np.floor(np.minimum(edges[:, :2], edges[:, 2:]) / cell).astype(np.int64)
    high = np.floor(np.maximum(edges[:, :2], edges[:, 2:]) / cell).astype(np.int64)
    first, last = low.min(axis=0), high.max(axis=0)
    level = 0
    while ((last >> level) - (first >> level) > 1).any():
        level += STEP
    size = (last >> level) - (first >> level) + 1
    cells = (first >> level) + np.array([(x, y) for x in range(size[0]) for y in range(size[1])])
    edge = np.arange(len(edges))
    _, edge, place = _reach(edge, edge, edges, low, high, first >> level, last >> level, level, cell)
    place -= first >> level
    tile = place[:, 0] * size[1] + place[:, 1]
    while True:
        count = np.bincount(tile, minlength=len(cells))
        crossed = count > 0
        ready = np.full(len(cells), True) if level == 0 else ~crossed
        within = np.zeros(len(cells), dtype=bool)
        if ready.any():
            within[ready] = _inside_tiles(edges, cells[ready], cell * 2.0 ** level)
        kept = within | (crossed & ready)
        own = edge[np.argsort(tile, kind="stable")] if level == 0 else edge[:0]
        yield level, cells[kept], within[kept], np.concatenate([[0], np.cumsum(count[kept])]), edges[own]
        if level == 0:
            return
        level -= STEP
        corner = cells << STEP
        tile, edge, place = _reach(tile, edge, edges, low, high, corner[tile], corner[tile] + (1 << STEP) - 1,
                                   level, cell)
        place -= corner[tile]
        number = np.cumsum(crossed) - 1  # of a crossed tile among the crossed
        tile = (number[tile] << 2 * STEP) + (place[:, 0] << STEP) + place[:, 1]
        cells = (corner[crossed][:, None, :] + _CHILDREN).reshape(-1, 2)


def meet_tiles(bufs, cx, cy, cell, within, edges, counts) -> np.ndarray:
    """Per row: whether a geometry meets the feature a tile was cut from, in that tile.

    A missing geometry stands for a pair that is certain.
    """
    n = len(bufs)
    g = Segments(bufs)
    at = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    out = np.array([b is None for b in bufs])
    out |= rows_touching(g.xy, g.row, edges, at, n)
    # a ring that starts in this tile lies on the same side as its start
    row = g.head_row
    starts_here = ((np.floor(g.heads[:, 0] / cell[row]) == cx[row])
                   & (np.floor(g.heads[:, 1] / cell[row]) == cy[row]) & ~out[row])
    heads, row = g.heads[starts_here], row[starts_here]
    ref = np.column_stack([(cx[row] + _REF[0]) * cell[row], (cy[row] + _REF[1]) * cell[row]])
    # go level to the reference point's column, then straight to it, and count borders
    corner = np.column_stack([ref[:, 0], heads[:, 1]])
    passed = _crossings(heads, row, edges, at, np.minimum(heads[:, 0], ref[:, 0]),
                        np.maximum(heads[:, 0], ref[:, 0]))
    passed += _crossings(corner, row, edges, at, np.minimum(heads[:, 1], ref[:, 1]),
                         np.maximum(heads[:, 1], ref[:, 1]), along=1)
    out[row[(passed % 2 == 0) == within[row].astype(bool)]] = True
    # or the feature lies wholly within the geometry
    areas, area_at = g.areas()
    bordered = np.flatnonzero(~out & (counts > 0))
    if len(bordered):
        first = edges[at[bordered], :2]
        out[bordered[points_inside(first, bordered, areas, area_at)]] = True
    # a tile without borders is inside throughout: does the geometry reach into it?
    plain = np.flatnonzero(~out & (counts == 0) & within.astype(bool))
    if len(plain):
        x0, y0, side = cx[plain] * cell[plain], cy[plain] * cell[plain], cell[plain]
        boxes = [write_rings(3, [(0, SHELL, np.array(
            [[x, y], [x + s, y], [x + s, y + s], [x, y + s], [x, y]]))])
            for x, y, s in zip(x0, y0, side)]
        out[plain] = intersects([bufs[i] for i in plain], boxes)
    return out
