"""Geometry bytes to coordinate arrays and back; runs inside Arrow batches.

A shape is a struct ``gtype, error, rings`` where each ring holds its part
number, its kind (0 point, 1 line, 2 shell, 3 hole) and its points ``x, y, z``.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

POINT, LINE, SHELL, HOLE = 0, 1, 2, 3

_PT = pa.struct([("x", pa.float64()), ("y", pa.float64()), ("z", pa.float64())])
_RING = pa.struct([("part", pa.int32()), ("kind", pa.int32()), ("pts", pa.list_(_PT))])
SHAPE_ARROW = pa.struct(
    [("gtype", pa.int32()), ("error", pa.string()), ("rings", pa.list_(_RING))]
)

# Arc types and the straight type each becomes after stroking.
STRAIGHT = {8: 2, 9: 2, 10: 3, 11: 5, 12: 6}
ARC_STEPS = 32  # segments per quarter circle


class _Reader:
    """Cursor over one geometry's bytes."""

    def __init__(self, buf: bytes):
        self.buf, self.pos = buf, 0
        self.rings: list[tuple[int, int, np.ndarray]] = []
        self.part = -1

    def _header(self):
        order = "<" if self.buf[self.pos] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", self.buf, self.pos + 1)
        self.pos += 5
        if code & 0x20000000:
            self.pos += 4  # embedded SRID; ours is a column
        base, family = (code & 0xFFFF) % 1000, (code & 0xFFFF) // 1000
        has_z = bool(code & 0x80000000) or family in (1, 3)
        has_m = bool(code & 0x40000000) or family in (2, 3)
        return order, base, 2 + has_z + has_m, has_z

    def _count(self, order):
        (n,) = struct.unpack_from(order + "I", self.buf, self.pos)
        self.pos += 4
        return n

    def _points(self, order, n, dims, has_z):
        xyz = np.frombuffer(self.buf, order + "f8", n * dims, self.pos).reshape(n, dims)
        self.pos += n * dims * 8
        return xyz[:, : 3 if has_z else 2]

    def read(self, nested=False, kind=LINE) -> int:
        order, base, dims, has_z = self._header()
        if base == 1:
            self.part += not nested
            pts = self._points(order, 1, dims, has_z)
            if not np.isnan(pts[0, 0]):
                self.rings.append((self.part, POINT, pts))
        elif base in (2, 8):
            self.part += not nested
            pts = self._points(order, self._count(order), dims, has_z)
            self.rings.append((self.part, kind, stroke(pts) if base == 8 else pts))
        elif base == 3:
            self.part += not nested
            for i in range(self._count(order)):
                pts = self._points(order, self._count(order), dims, has_z)
                self.rings.append((self.part, SHELL if i == 0 else HOLE, pts))
        elif base == 9:  # compound curve: pieces joined end to end
            self.part += not nested
            mark = len(self.rings)
            for _ in range(self._count(order)):
                self.read(nested=True)
            pieces = [r[2] for r in self.rings[mark:]]
            del self.rings[mark:]
            joined = np.vstack([pieces[0]] + [p[1:] for p in pieces[1:]])
            self.rings.append((self.part, kind, joined))
        elif base == 10:
            self.part += not nested
            for i in range(self._count(order)):
                self.read(nested=True, kind=SHELL if i == 0 else HOLE)
        elif base in (4, 5, 6, 7, 11, 12):
            for _ in range(self._count(order)):
                self.read()
        else:
            raise ValueError(f"geometry type {base} not supported")
        return base


def stroke(pts: np.ndarray) -> np.ndarray:
    """Replace the arcs through each three points by short segments."""
    out = [pts[:1]]
    for i in range(0, len(pts) - 2, 2):
        a, b, c = pts[i, :2], pts[i + 1, :2], pts[i + 2, :2]
        d = 2 * (a[0] * (b[1] - c[1]) + b[0] * (c[1] - a[1]) + c[0] * (a[1] - b[1]))
        full = np.array_equal(a, c)
        if d == 0 and not full:
            out.append(pts[i + 1 : i + 3])
            continue
        if full:
            centre = (a + b) / 2
        else:
            la, lb, lc = a @ a, b @ b, c @ c
            centre = np.array([
                la * (b[1] - c[1]) + lb * (c[1] - a[1]) + lc * (a[1] - b[1]),
                la * (c[0] - b[0]) + lb * (a[0] - c[0]) + lc * (b[0] - a[0]),
            ]) / d
        angle = [np.arctan2(*(p - centre)[::-1]) for p in (a, b, c)]
        turn = (angle[2] - angle[0]) % (2 * np.pi)
        if full:
            turn = 2 * np.pi
        elif (angle[1] - angle[0]) % (2 * np.pi) > turn:
            turn -= 2 * np.pi
        steps = max(2, int(np.ceil(abs(turn) / (np.pi / 2) * ARC_STEPS)))
        theta = angle[0] + turn * np.arange(1, steps) / steps
        radius = np.hypot(*(a - centre))
        arc = np.column_stack([centre[0] + radius * np.cos(theta),
                               centre[1] + radius * np.sin(theta)])
        if pts.shape[1] == 3:
            z = np.interp(np.arange(1, steps) / steps, [0, 1], pts[[i, i + 2], 2])
            arc = np.column_stack([arc, z])
        out += [arc, pts[i + 2 : i + 3]]
    return np.vstack(out)


def read_rings(buf: bytes) -> tuple[int, list[tuple[int, int, np.ndarray]]]:
    reader = _Reader(buf)
    base = reader.read()
    return STRAIGHT.get(base, base), reader.rings


def tidy(rings):
    """Rings closed and without repeated points."""
    out = []
    for part, kind, pts in rings:
        if kind != POINT and len(pts):
            pts = pts[np.r_[True, (pts[1:] != pts[:-1]).any(axis=1)]]
            if kind in (SHELL, HOLE) and (pts[0] != pts[-1]).any():
                pts = np.vstack([pts, pts[:1]])
        out.append((part, kind, pts))
    return out


class Batch:
    """The rings of a batch of geometries in flat arrays."""

    def __init__(self, bufs: list[bytes | None]):
        self.gtype, self.error, self.missing = [], [], [b is None for b in bufs]
        row, part, kind, coords = [], [], [], []
        self._points = coords
        for i, buf in enumerate(bufs):
            base, message, rings = None, None, []
            if buf is not None:
                try:
                    base, rings = read_rings(buf)
                except (struct.error, ValueError, IndexError) as exc:
                    rings, message = [], str(exc)
            self.gtype.append(base)
            self.error.append(message)
            for p, k, pts in rings:
                row.append(i)
                part.append(p)
                kind.append(k)
                coords.append(pts)
        self.rows = len(bufs)
        self.row, self.part, self.kind = (np.array(v, dtype=np.int32) for v in (row, part, kind))
        self.at = np.zeros(len(coords) + 1, dtype=np.int64)  # where each ring starts
        np.cumsum([len(c) for c in coords], out=self.at[1:])
        total = int(self.at[-1])
        self.x, self.y, self.z = np.empty(total), np.empty(total), np.zeros(total)
        self.flat = np.ones(total, dtype=bool)
        for start, pts in zip(self.at, coords):
            end = start + len(pts)
            self.x[start:end], self.y[start:end] = pts[:, 0], pts[:, 1]
            if pts.shape[1] == 3:
                self.z[start:end], self.flat[start:end] = pts[:, 2], False

    def rings(self, i: int):
        """The rings of one geometry, as `read_rings` gives them."""
        first, end = np.searchsorted(self.row, [i, i + 1])
        return [(int(self.part[r]), int(self.kind[r]), self._points[r]) for r in range(first, end)]

    def untidy(self) -> np.ndarray:
        """Which geometries have a point twice in a row, or an open ring."""
        lengths = np.diff(self.at)
        ring = np.repeat(np.arange(len(lengths)), lengths)
        out = np.zeros(self.rows, dtype=bool)
        same = (ring[1:] == ring[:-1]) & (self.x[1:] == self.x[:-1]) & (self.y[1:] == self.y[:-1])
        out[self.row[ring[1:][same]]] = True
        area = np.flatnonzero((self.kind >= SHELL) & (lengths > 0))
        first, last = self.at[:-1][area], self.at[1:][area] - 1
        out[self.row[area[(self.x[first] != self.x[last]) | (self.y[first] != self.y[last])]]] = True
        return out

    def plain(self, bufs: list[bytes | None]) -> np.ndarray:
        """Which geometries are missing, or little-endian points, lines or polygons in two
        dimensions with nothing behind them: these are written as they are read."""
        points = np.bincount(self.row, np.diff(self.at), minlength=self.rows)
        rings = np.bincount(self.row, minlength=self.rows)
        size = {1: 5 + 16 * points, 2: 9 + 16 * points, 3: 9 + 4 * rings + 16 * points}
        return np.array([b is None or (b[:1] == b"\x01" and b[2:5] == b"\0\0\0" and b[1] in size
                                       and len(b) == size[b[1]][i]) for i, b in enumerate(bufs)], dtype=bool)


def decode(column: pa.Array) -> pa.Array:
    """A WKB column as shapes; bytes that cannot be read give ``error``."""
    return shapes(Batch(column.to_pylist()))


def shapes(batch: Batch) -> pa.Array:
    """The geometries of a batch as shapes."""
    points = pa.StructArray.from_arrays(
        [pa.array(batch.x), pa.array(batch.y), pa.array(batch.z, mask=batch.flat)],
        fields=list(_PT))
    rings = pa.StructArray.from_arrays(
        [pa.array(batch.part), pa.array(batch.kind),
         pa.ListArray.from_arrays(pa.array(batch.at, pa.int32()), points)], fields=list(_RING))
    ends = np.searchsorted(batch.row, np.arange(batch.rows + 1))
    return pa.StructArray.from_arrays(
        [pa.array(batch.gtype, pa.int32()), pa.array(batch.error, pa.string()),
         pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rings)],
        fields=list(SHAPE_ARROW), mask=pa.array(batch.missing))


STATS_ARROW = pa.struct([("gtype", pa.int32()), ("error", pa.string()), ("npoints", pa.int32())]
                        + [(c, pa.float64()) for c in
                           ("xmin", "ymin", "xmax", "ymax", "cx", "cy")])


def stats(column: pa.Array) -> pa.Array:
    """Type, size, box and centroid per geometry.

    The centroid is weighted by area if there is any, else by length, else by points.
    """
    g = Batch(column.to_pylist())
    n = g.rows
    lengths = np.diff(g.at)
    ring = np.repeat(np.arange(len(lengths)), lengths)  # ring of each point
    owner = g.row[ring] if len(ring) else np.empty(0, int)
    count = np.bincount(owner, minlength=n)
    has = count > 0
    starts = np.searchsorted(owner, np.arange(n))[has]
    box = np.full((4, n), np.nan)
    if has.any():
        for k, (f, v) in enumerate([(np.minimum, g.x), (np.minimum, g.y),
                                    (np.maximum, g.x), (np.maximum, g.y)]):
            box[k, has] = f.reduceat(v, starts)
    # all sums run on offsets from each geometry's box corner, to keep digits
    x, y = g.x - box[0, owner], g.y - box[1, owner]
    inner = np.ones(len(x), dtype=bool)
    inner[g.at[1:][lengths > 0] - 1] = False  # the last point of a ring starts no segment
    i = np.flatnonzero(inner)
    r, w = ring[i], owner[i]
    cross = x[i] * y[i + 1] - x[i + 1] * y[i]
    turn = np.bincount(r, cross, minlength=len(lengths))  # twice the signed ring area
    sign = np.where(g.kind == SHELL, 1.0, np.where(g.kind == HOLE, -1.0, 0.0)) * np.sign(turn)
    weight = cross * sign[r]
    area = np.bincount(w, weight, minlength=n)
    ax = np.bincount(w, weight * (x[i] + x[i + 1]), minlength=n) / 3
    ay = np.bincount(w, weight * (y[i] + y[i + 1]), minlength=n) / 3
    step = np.hypot(x[i + 1] - x[i], y[i + 1] - y[i])
    length = np.bincount(w, step, minlength=n)
    lx = np.bincount(w, step * (x[i] + x[i + 1]) / 2, minlength=n)
    ly = np.bincount(w, step * (y[i] + y[i + 1]) / 2, minlength=n)
    px, py = np.bincount(owner, x, minlength=n), np.bincount(owner, y, minlength=n)
    with np.errstate(all="ignore"):
        cx = np.where(area > 0, ax / area, np.where(length > 0, lx / length, px / count)) + box[0]
        cy = np.where(area > 0, ay / area, np.where(length > 0, ly / length, py / count)) + box[1]
    empty = ~has
    return pa.StructArray.from_arrays(
        [pa.array(g.gtype, pa.int32()), pa.array(g.error, pa.string()),
         pa.array(count, pa.int32())] + [pa.array(v, mask=empty) for v in (*box, cx, cy)],
        fields=list(STATS_ARROW), mask=pa.array(g.missing))


def write_rings(gtype: int, rings: list[tuple[int, int, np.ndarray]]) -> bytes:
    """Little-endian WKB of one geometry."""
    has_z = any(p.shape[1] == 3 for _, _, p in rings)
    flag = 1000 if has_z else 0

    def head(base):
        return struct.pack("<BI", 1, base + flag)

    def run(pts):
        if has_z and pts.shape[1] == 2:
            pts = np.column_stack([pts, np.zeros(len(pts))])
        return np.ascontiguousarray(pts, "<f8").tobytes()

    def simple(group):
        kind = group[0][1]
        if kind == POINT:
            return head(1) + run(group[0][2])
        if kind == LINE:
            return head(2) + struct.pack("<I", len(group[0][2])) + run(group[0][2])
        body = b"".join(struct.pack("<I", len(p)) + run(p) for _, _, p in group)
        return head(3) + struct.pack("<I", len(group)) + body

    parts: dict[int, list] = {}
    for ring in rings:
        parts.setdefault(ring[0], []).append(ring)
    pieces = [simple(g) for g in parts.values()]
    if gtype <= 3:
        if pieces:
            return pieces[0]
        if gtype == 1:
            return head(1) + np.full(2 + has_z, np.nan).tobytes()
        return head(gtype) + struct.pack("<I", 0)
    return head(gtype) + struct.pack("<I", len(pieces)) + b"".join(pieces)


def encode(column: pa.Array) -> pa.Array:
    """Shapes back to WKB."""
    ring_list = column.field("rings")
    rings = ring_list.values
    ring_at = ring_list.offsets.to_numpy()
    points = rings.field("pts").values
    pt_at = rings.field("pts").offsets.to_numpy()
    xy = np.column_stack([points.field("x").to_numpy(zero_copy_only=False),
                          points.field("y").to_numpy(zero_copy_only=False)])
    z = points.field("z")
    has_z = z.is_valid().to_numpy(zero_copy_only=False)
    z = z.to_numpy(zero_copy_only=False)
    part, kind = (rings.field(f).to_numpy(zero_copy_only=False) for f in ("part", "kind"))
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    out = []
    for i, gtype in enumerate(column.field("gtype").to_pylist()):
        if not valid[i] or gtype is None:
            out.append(None)
            continue
        group = []
        for r in range(ring_at[i], ring_at[i + 1]):
            a, b = pt_at[r], pt_at[r + 1]
            pts = xy[a:b]
            if b > a and has_z[a:b].all():
                pts = np.column_stack([pts, z[a:b]])
            group.append((int(part[r]), int(kind[r]), pts))
        out.append(write_rings(gtype, group))
    return pa.array(out, pa.binary())
