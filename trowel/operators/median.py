"""Geometric median of the points of each group.

Each round reads the points once. It sums them up in cells around the present candidate, whose
size grows with their distance from it, and with the cells' sums takes the exact distance sum
and pull at the candidate. A far cell stands for its points by its middle; a group has no more
than some ten thousand cells, however many points. The least distance sum over the cells,
corrected by the exact pull, is the next candidate: what is left of the error shrinks with the
cells' angle in every round, so a few rounds over the points do.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trowel.session import cut_lineage

GROUPS_TO_BROADCAST = 500_000  # two numbers and the keys per group

SECTORS = 64   # cells of a ring
RINGS = 11     # rings until the distance has doubled: cells are about as wide as long
STEPS = 200    # steps over the cells of a group, at most
NOISE = 1e-13  # share of a distance sum that its rounding may hide

CELL_SUMS = ["n", "x", "y", "f", "rx", "ry", "w"]


def _cells(points: DataFrame, candidates: DataFrame, keys: list[str], tolerance: float) -> DataFrame:
    """The points by cell around the candidate (cx, cy) of their group: how many, their middle
    from there, and the exact sums of distances, directions and inverse distances."""
    met = points.join(candidates, keys).withColumn("dx", F.col("x") - F.col("cx")).withColumn(
        "dy", F.col("y") - F.col("cy")).withColumn("d", F.hypot("dx", "dy"))
    away = F.col("d") > 0
    ring = F.when(away, F.greatest(F.floor(F.log2(F.col("d") / tolerance) * RINGS), F.lit(0)))
    sector = F.when(away, F.floor(F.atan2("dy", "dx") / (2 * np.pi) * SECTORS))
    far = F.when(away, F.col("d"))
    held = ["cx", "cy", "bx", "by", "bf", "vx", "vy"]
    return met.groupBy(*keys, ring.cast("int").alias("ring"), sector.cast("int").alias("sector")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("dx").alias("x"), F.avg("dy").alias("y"), F.sum("d").alias("f"),
        *[F.coalesce(F.sum(c / far), F.lit(0.0)).alias(name)
          for c, name in ((F.col("dx"), "rx"), (F.col("dy"), "ry"), (F.lit(1.0), "w"))],
        *[F.first(c).alias(c) for c in held])


def least_sum(n: np.ndarray, x: np.ndarray, y: np.ndarray, tilt: tuple[float, float]) -> tuple[float, float]:
    """Where the sum of n times the distance to (x, y), plus the tilt, is least, from (0, 0) on.

    Of Newton's step, the nearest of the points and the step with the rule of Vardi and Zhang,
    which always lowers the sum, the best is taken until none is better.
    """
    def total(a: float, b: float) -> float:
        return float((n * np.hypot(x - a, y - b)).sum() + tilt[0] * a + tilt[1] * b)

    a = b = 0.0
    value = total(a, b)
    for _ in range(STEPS):
        dx, dy = x - a, y - b
        d = np.hypot(dx, dy)
        off = d > 0
        dx, dy, near, weight = dx[off], dy[off], d[off], n[off]
        rx = float((weight * dx / near).sum()) - tilt[0]
        ry = float((weight * dy / near).sum()) - tilt[1]
        own, pull = float(n[~off].sum()), float(np.hypot(rx, ry))
        if pull <= own or not len(near):
            break
        w = float((weight / near).sum())
        damp = 1 - own / pull
        tries = [(a + damp * rx / w, b + damp * ry / w)]
        first = int(near.argmin())
        tries.append((a + float(dx[first]), b + float(dy[first])))
        if own == 0:
            hxx, hyy = float((weight * dy * dy / near**3).sum()), float((weight * dx * dx / near**3).sum())
            hxy = float((-weight * dx * dy / near**3).sum())
            det = hxx * hyy - hxy * hxy
            if np.isfinite(det) and det > 1e-9 * (hxx + hyy) ** 2:
                tries.append((a + (hyy * rx - hxy * ry) / det, b + (hxx * ry - hxy * rx) / det))
        least, at = min((total(*t), t) for t in tries)
        if not least < value:
            break
        value, (a, b) = least, at
    return a, b


def _advance(keys: list[str], tolerance: float):
    def advance(cells: pd.DataFrame) -> pd.DataFrame:
        """The next candidate of one group, from its cells around the present one."""
        out = cells.iloc[:1][keys].copy()
        cx, cy, bx, by, bf, vx, vy = (float(cells[c].iloc[0]) for c in ("cx", "cy", "bx", "by", "bf", "vx", "vy"))
        cells = cells.sort_values(["ring", "sector"])  # sums do not hang on the rows' order
        n, x, y, f, rx, ry, w = (cells[c].to_numpy(float) for c in CELL_SUMS)
        here = cells["ring"].isna().to_numpy()
        own, f, rx, ry, w = float(n[here].sum()), f.sum(), float(rx.sum()), float(ry.sum()), float(w.sum())
        pull = float(np.hypot(rx, ry))
        if f <= bf * (1 + NOISE):
            bx, by, bf = cx, cy, f
            d = np.hypot(x, y)
            d[d == 0] = np.inf  # a cell in the middle pulls nowhere
            tilt = float((n * x / d).sum()) - rx, float((n * y / d).sum()) - ry
            damp = max(0.0, 1 - own / pull) if pull else 0.0
            vx, vy = (cx + damp * rx / w, cy + damp * ry / w) if w else (cx, cy)
            a, b = least_sum(n, x, y, tilt)
            done = pull <= own or np.hypot(a, b) < tolerance
            cx, cy = cx + a, cy + b
        elif (cx, cy) == (vx, vy):
            done = True  # not even the step that always lowers the sum does: rounding is all that is left
        else:
            done = np.hypot(cx - bx, cy - by) < tolerance
            cx, cy = vx, vy
        values = (cx, cy, bx, by, bf, vx, vy, bool(done))
        return out.assign(**dict(zip(("cx", "cy", "bx", "by", "bf", "vx", "vy", "done"), values)))
    return advance


def geometric_median(points: DataFrame, *keys: str, tolerance: float = 1e-5,
                     rounds: int = 30) -> DataFrame:
    """The point with the least distance sum per group: keys, x, y, converged.

    ``converged`` is false where ``rounds`` did not do; x and y are then the best point met.
    ``points`` is read once per round, so it should be a checkpoint or a stored table. Points
    without finite coordinates take no part; a group of no others has no row.
    """
    keys = list(keys)
    finite = (F.abs("x") < float("inf")) & (F.abs("y") < float("inf"))  # a NaN is above all numbers
    points = points.where(finite)
    state = points.groupBy(*keys).agg(F.avg("x").alias("cx"), F.avg("y").alias("cy")).select(
        *keys, "cx", "cy", F.col("cx").alias("bx"), F.col("cy").alias("by"),
        F.lit(float("inf")).alias("bf"), F.col("cx").alias("vx"), F.col("cy").alias("vy"),
        F.lit(False).alias("done"))
    state = cut_lineage(state)
    few = state.limit(GROUPS_TO_BROADCAST + 1).count() <= GROUPS_TO_BROADCAST
    for _ in range(rounds):
        candidates = state.where(~F.col("done")).drop("done")
        if few:  # then the points stay where they are
            candidates = F.broadcast(candidates)
        cells = _cells(points, candidates, keys, tolerance)
        moved = cells.groupBy(*keys).applyInPandas(_advance(keys, tolerance), state.schema)
        state = cut_lineage(state.where("done").unionByName(moved))
        if state.where(~F.col("done")).isEmpty():
            break
    return state.select(*keys, F.col("bx").alias("x"), F.col("by").alias("y"),
                        F.col("done").alias("converged"))
