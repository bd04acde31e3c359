"""Geometries taken apart into edge rows, so that work on borders is joins between rows."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trowel.functions.wkb import HOLE, LINE, SHELL, Batch

EDGES = ("key bigint, fault int, message string, ring int, part int, kind int, apart boolean, rings int, "
         "seq int, size int, x1 double, y1 double, x2 double, y2 double, sx double, sy double")
NOT_FINITE, TOO_FEW, NOT_CLOSED, UNREADABLE, TOO_FEW_LEFT = range(5)
COLLECTION = 7
ONE_CELL = 64  # geometries of so few edges need no grid
_LOT = 65_536  # edge rows of one Arrow batch

_ARROW = pa.schema([
    ("key", pa.int64()), ("fault", pa.int32()), ("message", pa.string()), ("ring", pa.int32()), ("part", pa.int32()),
    ("kind", pa.int32()), ("apart", pa.bool_()), ("rings", pa.int32()), ("seq", pa.int32()), ("size", pa.int32()),
    *[(c, pa.float64()) for c in ("x1", "y1", "x2", "y2", "sx", "sy")]])


def _table(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ARROW],
        schema=_ARROW)


def _ring_faults(g: Batch) -> np.ndarray:
    """The fault of each ring as it stands, -1 for none."""
    lengths = np.diff(g.at)
    fault = np.full(len(lengths), -1)
    full = np.flatnonzero(lengths > 0)
    first, last = g.at[:-1][full], g.at[1:][full] - 1
    area = g.kind >= SHELL
    closed, still, finite = (np.ones(len(lengths), dtype=bool) for _ in range(3))
    if len(full):
        ring = np.repeat(np.arange(len(lengths)), lengths)
        closed[full] = (g.x[first] == g.x[last]) & (g.y[first] == g.y[last])
        head = g.at[:-1][ring]
        still[full] = np.logical_and.reduceat((g.x == g.x[head]) & (g.y == g.y[head]), first)
        finite[full] = np.logical_and.reduceat(np.isfinite(g.x) & np.isfinite(g.y), first)
    fault[area & ~closed] = NOT_CLOSED
    fault[(area & (lengths < 4)) | ((g.kind == LINE) & ((lengths < 2) | still))] = TOO_FEW
    fault[~finite] = NOT_FINITE
    return fault


def _rings_in_row(g: Batch) -> np.ndarray:
    """The number of each ring within its geometry."""
    return np.arange(len(g.row)) - np.searchsorted(g.row, g.row)


def edge_rows(batches: Iterator[pa.RecordBatch], one_cell: int = ONE_CELL) -> Iterator[pa.RecordBatch]:
    """Rows (key, wkb) as edges of their polygon rings, in lots; and a row with a fault for each
    ring that is none. Repeated points are passed over. Wide geometries are turned over, x for y,
    so that bands of equal y hold few edges. ``sx`` and ``sy`` are the sides of the geometry's
    grid: some mean edges wide, so that all edges together cross few cells each."""
    for batch in batches:
        keys = batch["key"].to_numpy(zero_copy_only=False)
        g = Batch(batch["wkb"].to_pylist())
        bad = [i for i, message in enumerate(g.error) if message is not None]
        if bad:
            yield _table(key=keys[bad], fault=[UNREADABLE] * len(bad), ring=[-1] * len(bad),
                         message=[f"unreadable: {g.error[i]}" for i in bad])
        if not len(g.row):
            continue
        number, fault = _rings_in_row(g), _ring_faults(g)
        ill = np.flatnonzero(fault >= 0)
        if len(ill):
            yield _table(key=keys[g.row[ill]], fault=fault[ill], ring=number[ill])
        sound = np.ones(g.rows, dtype=bool)
        sound[g.row[ill]] = False
        lengths = np.diff(g.at)
        ring = np.repeat(np.arange(len(lengths)), lengths)
        keep = (sound[g.row] & (g.kind >= SHELL))[ring]
        moved = np.ones(len(ring), dtype=bool)
        moved[1:] = (ring[1:] != ring[:-1]) | (g.x[1:] != g.x[:-1]) | (g.y[1:] != g.y[:-1])
        keep &= moved
        ring, x, y = ring[keep], g.x[keep], g.y[keep]
        left = np.bincount(ring, minlength=len(lengths))
        short = np.flatnonzero((left < 4) & (g.kind >= SHELL) & sound[g.row])
        if len(short):
            yield _table(key=keys[g.row[short]], fault=[TOO_FEW_LEFT] * len(short), ring=number[short])
        keep = left[ring] >= 4
        ring, x, y = ring[keep], x[keep], y[keep]
        start = np.flatnonzero(ring[1:] == ring[:-1])
        if not len(start):
            continue
        ring, x1, y1, x2, y2 = ring[start], x[start], y[start], x[start + 1], y[start + 1]
        row = g.row[ring]
        count = np.bincount(row, minlength=g.rows)
        own = np.flatnonzero(count)
        heads = np.searchsorted(row, own)
        extent = lambda v: np.maximum.reduceat(v, heads) - np.minimum.reduceat(v, heads)
        wide = np.zeros(g.rows, dtype=bool)
        wide[own] = extent(x1) > extent(y1)
        turned = wide[row]
        x1, y1 = np.where(turned, y1, x1), np.where(turned, x1, y1)
        x2, y2 = np.where(turned, y2, x2), np.where(turned, x2, y2)
        reach = np.zeros(g.rows)
        reach[own] = np.maximum.reduceat(np.maximum(np.abs(x1), np.abs(y1)), heads)
        least = np.maximum(reach * 2.0 ** -30, 1e-300)
        sides = []
        for a, b in ((x1, x2), (y1, y2)):
            mean = np.bincount(row, np.abs(b - a), minlength=g.rows) / np.maximum(count, 1)
            sides.append(np.where(count <= one_cell, 2 * (reach + 1), np.maximum(4 * mean, least))[row])
        size = np.bincount(ring, minlength=len(lengths))
        seq = np.arange(len(ring)) - np.searchsorted(ring, ring)
        rings = np.bincount(g.row[np.unique(ring)], minlength=g.rows)
        apart = np.array([t == COLLECTION for t in g.gtype])
        for i in range(0, len(ring), _LOT):
            lot = slice(i, i + _LOT)
            r, w = ring[lot], row[lot]
            yield _table(key=keys[w], ring=number[r], part=g.part[r], kind=g.kind[r], apart=apart[w],
                         rings=rings[w], seq=seq[lot], size=size[r], x1=x1[lot], y1=y1[lot], x2=x2[lot],
                         y2=y2[lot], sx=sides[0][lot], sy=sides[1][lot])


SEGMENTS = ("key bigint, part int, area boolean, apart boolean, head boolean, "
            "x1 double, y1 double, x2 double, y2 double, sy double")
_SEGMENTS = pa.schema([("key", pa.int64()), ("part", pa.int32()), ("area", pa.bool_()), ("apart", pa.bool_()),
                       ("head", pa.bool_()), *[(c, pa.float64()) for c in ("x1", "y1", "x2", "y2", "sy")]])


def segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, wkb) as the segments of all their parts as they stand, in lots; a point is a
    segment of length zero. ``head`` marks the first one of each ring or line. ``sy`` is the height
    of the bands in which a point looks for the borders beside it."""
    for batch in batches:
        keys = batch["key"].to_numpy(zero_copy_only=False)
        g = Batch(batch["wkb"].to_pylist())
        lengths = np.diff(g.at)
        ring = np.repeat(np.arange(len(lengths)), lengths)
        here = np.arange(len(ring))
        last = np.zeros(len(ring), dtype=bool)
        last[g.at[1:][lengths > 0] - 1] = True
        here = here[~last | (lengths == 1)[ring]] if len(ring) else here
        if not len(here):
            continue
        there = np.where(last[here], here, here + 1)
        ring = ring[here]
        row = g.row[ring]
        x1, y1, x2, y2 = g.x[here], g.y[here], g.x[there], g.y[there]
        count = np.bincount(row, minlength=g.rows)
        rise = np.bincount(row, np.abs(y2 - y1), minlength=g.rows) / np.maximum(count, 1)
        reach = np.zeros(g.rows)
        np.maximum.at(reach, row, np.maximum(np.abs(y1), np.abs(y2)))
        sy = np.where(count <= ONE_CELL, 2 * (reach + 1), np.maximum(4 * rise, np.maximum(reach * 2.0 ** -30, 1e-300)))
        apart = np.array([t == COLLECTION for t in g.gtype])
        for i in range(0, len(here), _LOT):
            lot = slice(i, i + _LOT)
            r, w = ring[lot], row[lot]
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(
                (keys[w], g.part[r], g.kind[r] >= SHELL, apart[w], here[lot] == g.at[r], x1[lot], y1[lot], x2[lot],
                 y2[lot], sy[w]), _SEGMENTS)], schema=_SEGMENTS)


def in_segments(geometries: DataFrame) -> DataFrame:
    """Rows (key, wkb) as rows of SEGMENTS."""
    return geometries.select("key", "wkb").mapInArrow(segment_rows, SEGMENTS)


def taken_apart(geometries: DataFrame, one_cell: int = ONE_CELL) -> DataFrame:
    """Rows (key, wkb) as rows of EDGES."""
    return geometries.select("key", "wkb").mapInArrow(partial(edge_rows, one_cell=one_cell), EDGES)


def _cells(value: Column, side: Column) -> Column:
    return F.floor(value / side).cast("bigint")


def with_bands(edges: DataFrame) -> DataFrame:
    """The edges once for each band of y (``band``) that they reach."""
    return edges.withColumn("band", F.explode(F.sequence(
        _cells(F.least("y1", "y2"), F.col("sy")), _cells(F.greatest("y1", "y2"), F.col("sy")))))


def with_cells(edges: DataFrame) -> DataFrame:
    """The edges once for each grid cell (cx, cy) that they cross: column by column the stretch
    between the column's borders, a little widened against rounding. Edges that are steep for the
    grid are in few columns and reach over all their height there."""
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    spread = edges.withColumn("cx", F.explode(F.sequence(_cells(lo, F.col("sx")), _cells(hi, F.col("sx")))))
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    steep = F.abs(dx) < F.col("sx") / 64

    def height(x: Column) -> Column:
        return F.when(steep, F.lit(None)).otherwise(F.col("y1") + (x - F.col("x1")) * F.try_divide(dy, dx))
    from_y = height(F.greatest(lo, F.col("cx") * F.col("sx")))
    to_y = height(F.least(hi, (F.col("cx") + 1) * F.col("sx")))
    slack = F.col("sy") / 64 + F.abs(dy) * 2.0 ** -14
    low = F.greatest(F.least("y1", "y2"), F.least(from_y, to_y) - slack)
    high = F.least(F.greatest("y1", "y2"), F.greatest(from_y, to_y) + slack)
    return spread.withColumn("cy", F.explode(F.sequence(_cells(low, F.col("sy")), _cells(F.greatest(low, high), F.col("sy")))))


def _cross(ax: Column, ay: Column, bx: Column, by: Column, cx: Column, cy: Column) -> Column:
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def _ends(mark: str) -> list[Column]:
    return [F.col(f"{mark}{c}") for c in ("x1", "y1", "x2", "y2")]


def edges_touch(a: str, b: str) -> Column:
    """Whether the edges in the columns with these prefixes share a point, ends included."""
    ax1, ay1, ax2, ay2 = p = _ends(a)
    bx1, by1, bx2, by2 = q = _ends(b)
    near = ((F.least(ax1, ax2) <= F.greatest(bx1, bx2)) & (F.greatest(ax1, ax2) >= F.least(bx1, bx2))
            & (F.least(ay1, ay2) <= F.greatest(by1, by2)) & (F.greatest(ay1, ay2) >= F.least(by1, by2)))
    return (near & (F.signum(_cross(*p, bx1, by1)) * F.signum(_cross(*p, bx2, by2)) <= 0)
            & (F.signum(_cross(*q, ax1, ay1)) * F.signum(_cross(*q, ax2, ay2)) <= 0))


def edges_share_a_line(a: str, b: str) -> Column:
    """Whether touching edges lie on one line and overlap there in more than a point."""
    ax1, ay1, ax2, ay2 = p = _ends(a)
    bx1, by1, bx2, by2 = _ends(b)
    on_line = (_cross(*p, bx1, by1) == 0) & (_cross(*p, bx2, by2) == 0)

    def overlap(p1, p2, q1, q2):
        return F.least(F.greatest(p1, p2), F.greatest(q1, q2)) > F.greatest(F.least(p1, p2), F.least(q1, q2))
    flat = F.abs(ax2 - ax1) >= F.abs(ay2 - ay1)  # compared along the longer axis
    return on_line & F.when(flat, overlap(ax1, ax2, bx1, bx2)).otherwise(overlap(ay1, ay2, by1, by2))


def place_on(a: str, b: str) -> Column:
    """Where edge a meets edge b, as a share of a; NULL for parallel ones."""
    ax1, ay1, ax2, ay2 = _ends(a)
    bx1, by1, bx2, by2 = _ends(b)
    turn = (ax2 - ax1) * (by2 - by1) - (ay2 - ay1) * (bx2 - bx1)
    share = ((bx1 - ax1) * (by2 - by1) - (by1 - ay1) * (bx2 - bx1)) / F.when(turn != 0, turn)
    return F.greatest(F.least(share, F.lit(1.0)), F.lit(0.0))


def ray_meets(x: str, y: str) -> Column:
    """Whether the level ray from a point to the right crosses the row's edge."""
    above = (F.col("y1") <= F.col(y)) != (F.col("y2") <= F.col(y))
    at = F.col("x1") + (F.col(y) - F.col("y1")) / F.when(above, F.col("y2") - F.col("y1")) * (F.col("x2") - F.col("x1"))
    return above & (at > F.col(x))


def is_hole(kind: str) -> Column:
    return F.col(kind) == HOLE


def is_shell(kind: str) -> Column:
    return F.col(kind) == SHELL
