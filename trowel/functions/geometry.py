"""Geometry columns: bytes in and out by Arrow batches, the rest as expressions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trowel.functions import planar, wkb

POINT_TYPE = T.StructType().add("x", "double").add("y", "double").add("z", "double")
RING_TYPE = (T.StructType().add("part", "integer").add("kind", "integer")
             .add("pts", T.ArrayType(POINT_TYPE)))
SHAPE_TYPE = (T.StructType().add("gtype", "integer").add("error", "string")
              .add("rings", T.ArrayType(RING_TYPE)))
STATS_TYPE = T.StructType().add("gtype", "integer").add("error", "string").add(
    "npoints", "integer")
for _name in ("xmin", "ymin", "xmax", "ymax", "cx", "cy"):
    STATS_TYPE = STATS_TYPE.add(_name, "double")
TILES_TYPE = T.ArrayType(
    T.StructType().add("level", "integer").add("cx", "long").add("cy", "long").add("inside", "boolean")
    .add("edges", T.ArrayType(T.DoubleType())))

# WKT names by type code.
WKT_NAMES = {
    1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT",
    5: "MULTILINESTRING", 6: "MULTIPOLYGON", 7: "GEOMETRYCOLLECTION",
}


# -- Arrow batches ----------------------------------------------------------
@F.arrow_udf(SHAPE_TYPE)
def decode_shape(data: pa.Array) -> pa.Array:
    return wkb.decode(data)


@F.arrow_udf(T.BinaryType())
def encode_shape(shape: pa.Array) -> pa.Array:
    return wkb.encode(shape)


@F.arrow_udf(STATS_TYPE)
def geom_stats(data: pa.Array) -> pa.Array:
    """Struct gtype, error, npoints, xmin, ymin, xmax, ymax, cx, cy."""
    return wkb.stats(data)


def once(value: Column) -> Column:
    """The value of a Python step that a filter looks at, as a row of its own: Spark pushes such a
    filter below the step otherwise, and runs the step twice, in two workers for each task."""
    return F.explode(F.array(value))


def _rings(buf):
    return wkb.read_rings(buf)[1]


@F.arrow_udf(T.BooleanType())
def intersects(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether two geometries share a point, borders included."""
    return pa.array(planar.intersects(a.to_pylist(), b.to_pylist()), pa.bool_())


@F.arrow_udf(TILES_TYPE)
def cut_tiles(data: pa.Array, cell: pa.Array) -> pa.Array:
    """The tiles of each geometry, built as columns: no Python value for each tile."""
    levels, counts = [], []
    for buf, side in zip(data.to_pylist(), cell.to_pylist()):
        found = [] if buf is None else list(planar.tiles(_rings(buf), side))
        levels += found
        counts.append(sum(len(cells) for _, cells, _, _, _ in found))

    def column(values, kind):
        return np.concatenate([np.empty(0, kind), *values]).astype(kind)

    cells = np.concatenate([np.empty((0, 2), np.int64), *[t[1] for t in levels]])
    sizes = column([np.diff(t[3]) for t in levels], np.int64) * 4
    edges = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                                     pa.array(column([t[4].ravel() for t in levels], np.float64)))
    level = np.repeat(column([[t[0]] for t in levels], np.int32),
                      column([[len(t[1])] for t in levels], np.int64))
    tiles = pa.StructArray.from_arrays(
        [pa.array(level, pa.int32()), pa.array(cells[:, 0]), pa.array(cells[:, 1]),
         pa.array(column([t[2] for t in levels], bool)), edges],
        ["level", "cx", "cy", "inside", "edges"])
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), tiles)


@F.arrow_udf(T.BooleanType())
def meets_tile(data: pa.Array, cx: pa.Array, cy: pa.Array, cell: pa.Array,
               within: pa.Array, edges: pa.Array) -> pa.Array:
    """Whether a geometry meets a tile; a NULL geometry is a pair already sure."""
    spots = [c.to_numpy(zero_copy_only=False) for c in (cx, cy, cell, within)]
    flat = edges.flatten().to_numpy(zero_copy_only=False)
    counts = pa.compute.list_value_length(edges).to_numpy(zero_copy_only=False) // 4
    return pa.array(planar.meet_tiles(data.to_pylist(), *spots, flat.reshape(-1, 4), counts),
                    pa.bool_())


@F.arrow_udf(T.BinaryType())
def canonical(data: pa.Array) -> pa.Array:
    """One byte order and no embedded system: equal geometries are equal bytes. Bytes that
    cannot be read stay as they are."""
    out = []
    for buf in data.to_pylist():
        # little-endian points, lines and polygons in two dimensions are in this form
        if buf is not None and not (buf[:1] == b"\x01" and buf[1:5] in _PLAIN):
            try:
                buf = wkb.write_rings(*wkb.read_rings(buf))
            except Exception:  # bytes that are no geometry
                pass
        out.append(buf)
    return pa.array(out, pa.binary())


_PLAIN = {bytes([kind, 0, 0, 0]) for kind in (1, 2, 3)}


def _tidied(data: pa.Array, flat: bool) -> tuple[list[bytes | None], wkb.Batch | None]:
    """The tidy bytes, and what was read of them unless some were written anew."""
    out = data.to_pylist()
    g = wkb.Batch(out)
    for error in filter(None, g.error):
        raise ValueError(error)
    # all that is not tidy or not in the plain form of two dimensions is written anew
    anew = np.flatnonzero(~g.plain(out) | g.untidy())
    for i in anew:
        rings = [(part, kind, pts[:, :2] if flat else pts) for part, kind, pts in g.rings(i)]
        out[i] = wkb.write_rings(g.gtype[i], wkb.tidy(rings))
    return out, None if len(anew) else g


@F.arrow_udf(T.BinaryType())
def tidy_wkb(data: pa.Array) -> pa.Array:
    """Close open rings, drop repeated points, stroke arcs."""
    return pa.array(_tidied(data, flat=False)[0], pa.binary())


@F.arrow_udf(SHAPE_TYPE)
def tidy_shape(data: pa.Array) -> pa.Array:
    """``decode_shape`` of ``tidy_wkb``; bytes that are tidy are read once."""
    out, read = _tidied(data, flat=False)
    return wkb.shapes(read or wkb.Batch(out))


@F.arrow_udf(T.BinaryType())
def flat_tidy_wkb(data: pa.Array) -> pa.Array:
    """The same in two dimensions."""
    return pa.array(_tidied(data, flat=True)[0], pa.binary())


def _packed(record: np.ndarray, valid: np.ndarray) -> pa.Array:
    raw = record.tobytes()
    fixed = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(record.dtype.itemsize), len(record), [None, pa.py_buffer(raw)]
    ).cast(pa.binary())
    return pa.compute.if_else(pa.array(valid), fixed, pa.scalar(None, pa.binary()))


def _doubles(*columns):
    valid = np.logical_and.reduce(
        [c.is_valid().to_numpy(zero_copy_only=False) for c in columns])
    return valid, [c.fill_null(0.0).to_numpy(zero_copy_only=False) for c in columns]


@F.arrow_udf(T.BinaryType())
def point_wkb(x: pa.Array, y: pa.Array) -> pa.Array:
    valid, (x, y) = _doubles(x, y)
    rec = np.zeros(len(x), np.dtype([("o", "u1"), ("t", "<u4"), ("xy", "<f8", 2)]))
    rec["o"], rec["t"] = 1, 1
    rec["xy"] = np.column_stack([x, y])
    return _packed(rec, valid)


@F.arrow_udf(T.BinaryType())
def box_wkb(x0: pa.Array, y0: pa.Array, x1: pa.Array, y1: pa.Array) -> pa.Array:
    valid, (x0, y0, x1, y1) = _doubles(x0, y0, x1, y1)
    rec = np.zeros(len(x0), np.dtype(
        [("o", "u1"), ("t", "<u4"), ("r", "<u4"), ("n", "<u4"), ("xy", "<f8", 10)]))
    rec["o"], rec["t"], rec["r"], rec["n"] = 1, 3, 1, 5
    rec["xy"] = np.column_stack([x0, y0, x1, y0, x1, y1, x0, y1, x0, y0])
    return _packed(rec, valid)


# -- expressions over a shape -------------------------------------------------
def shape_points(shape: Column) -> Column:
    return F.flatten(F.transform(shape["rings"], lambda r: r["pts"]))


def number_text(value: Column) -> Column:
    """A coordinate without a trailing `.0` and without an exponent."""
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    plain = value.cast("string")
    long_form = F.regexp_replace(value.cast("decimal(38,15)").cast("string"), r"\.?0+\z", "")
    return (F.when(whole, value.cast("bigint").cast("string"))
            .when(plain.contains("E"), long_form).otherwise(plain))


def _point_text(p: Column) -> Column:
    flat = F.concat(number_text(p["x"]), F.lit(" "), number_text(p["y"]))
    return F.when(p["z"].isNull(), flat).otherwise(
        F.concat(flat, F.lit(" "), number_text(p["z"])))


def _ring_text(ring: Column) -> Column:
    return F.concat(F.lit("("), F.array_join(F.transform(ring["pts"], _point_text), ","),
                    F.lit(")"))


def wkt(shape: Column, tag_z: bool = True) -> Column:
    """Well-known text; ``tag_z=False`` leaves the Z mark out, as extended text does."""
    rings = shape["rings"]
    first = F.get(rings, F.lit(0))  # NULL for an empty geometry
    kind = first["kind"]
    name = F.lit(None).cast("string")
    for code, word in WKT_NAMES.items():
        name = F.when(shape["gtype"] == code, F.lit(word)).otherwise(name)
    if tag_z:
        name = F.concat(name, F.when(F.get(first["pts"], F.lit(0))["z"].isNotNull(), F.lit(" Z "))
                        .otherwise(F.lit("")))
    texts = F.transform(rings, _ring_text)
    joined = F.array_join(texts, ",")

    # the rings of one part belong together: group them by part number
    parts = F.transform(
        F.array_distinct(F.transform(rings, lambda r: r["part"])),
        lambda n: F.filter(rings, lambda r: r["part"] == n))
    polygons = F.array_join(F.transform(parts, lambda g: F.concat(
        F.lit("("), F.array_join(F.transform(g, _ring_text), ","), F.lit(")"))), ",")
    members = F.array_join(F.transform(parts, lambda g: (
        F.when(g[0]["kind"] == wkb.POINT, F.concat(F.lit("POINT"), _ring_text(g[0])))
        .when(g[0]["kind"] == wkb.LINE, F.concat(F.lit("LINESTRING"), _ring_text(g[0])))
        .otherwise(F.concat(F.lit("POLYGON("),
                            F.array_join(F.transform(g, _ring_text), ","), F.lit(")"))))), ",")
    dots = F.array_join(F.transform(shape_points(shape), _point_text), ",")
    body = (
        F.when(shape["gtype"].isin(1, 2), joined)
        .when(shape["gtype"].isin(3, 5), F.concat(F.lit("("), joined, F.lit(")")))
        .when(shape["gtype"] == 4, F.concat(F.lit("("), dots, F.lit(")")))
        .when(shape["gtype"] == 6, F.concat(F.lit("("), polygons, F.lit(")")))
        .when(shape["gtype"] == 7, F.concat(F.lit("("), members, F.lit(")")))
    )
    return F.when(kind.isNull() & shape["gtype"].isNotNull(),
                  F.concat(F.rtrim(name), F.lit(" EMPTY"))).otherwise(F.concat(name, body))


def ewkt(shape: Column, srid: Column) -> Column:
    mark = F.when(F.coalesce(srid, F.lit(0)) == 0, F.lit("")).otherwise(
        F.concat(F.lit("SRID="), srid.cast("string"), F.lit(";")))
    return F.concat(mark, wkt(shape, tag_z=False))


def map_rings(shape: Column, change) -> Column:
    """The shape with the point array of every ring replaced by `change(points)`."""
    rings = F.transform(shape["rings"], lambda r: F.struct(
        r["part"].alias("part"), r["kind"].alias("kind"), change(r["pts"]).alias("pts")))
    return F.when(shape.isNotNull(), F.struct(
        shape["gtype"].alias("gtype"), shape["error"].alias("error"), rings.alias("rings")))


def map_points(shape: Column, change) -> Column:
    """The shape with every point replaced by `change(point)`."""
    return map_rings(shape, lambda pts: F.transform(pts, change))


def flatten_z(shape: Column) -> Column:
    return map_points(shape, lambda p: F.struct(
        p["x"].alias("x"), p["y"].alias("y"), F.lit(None).cast("double").alias("z")))
