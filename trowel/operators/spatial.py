"""Spatial joins as equi-joins on grid cells, and reports over geometries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trowel.functions import geometry as G
from trowel.functions.edges import edges_touch, in_segments, ray_meets, with_bands
from trowel.functions.lists import element, fold
from trowel.operators.validity import invalid_reasons
from trowel.schema import TARGET_SRID
from trowel.session import broadcast_if_small, cut_lineage, stored

A = "archive"

HOME_STEP = 4  # an object's own grid has cells of the tiles' side times a power of 16
WIDE = 2  # an object spans at most 1 + 2 ** WIDE of its cells along an axis


def _grid(value: Column, side) -> Column:
    return F.floor(value / side).cast("bigint")


def with_bbox(df: DataFrame, *keep: str) -> DataFrame:
    """Rows with a readable geometry and its bounding box."""
    measured = df.where(F.col("wkb").isNotNull()).select(
        *keep, "wkb", G.once(G.geom_stats("wkb")).alias("g"))
    return measured.where(F.col("g.xmin").isNotNull()).select(
        *keep, "wkb", *[f"g.{c}" for c in ("gtype", "xmin", "ymin", "xmax", "ymax")])


# -- objects against a polygon layer ------------------------------------------------
def region_tiles(layer: DataFrame, columns: list[str], cell: float) -> DataFrame:
    """The layer cut into tiles, wide ones where no border runs; every tile carries only the
    borders that cross it.

    Copies of a feature are counted in ``copies`` and cut once.
    """
    features = layer.where(F.col("wkb").isNotNull()).groupBy(*columns, "wkb").agg(
        F.count(F.lit(1)).alias("copies"))
    features = with_bbox(features, *columns, "copies").withColumn("feature", F.md5("wkb"))
    box = [F.col(c).alias(f"f{c}") for c in ("xmin", "ymin", "xmax", "ymax")]
    return (features.withColumn("tiles", G.cut_tiles("wkb", F.lit(float(cell))))
            .select(*columns, "feature", "copies", *box, F.inline("tiles")))


def region_hits(objects: DataFrame, ids: list[str], layer: DataFrame, columns: list[str],
                cell: float = 1000.0) -> DataFrame:
    """(ids, columns) for each object and layer feature that share a point.

    An object meets a tile by grid cell, in the wider of their two grids.  In a tile without
    borders an object that lies in that tile is inside for certain; all other pairs are tested
    against the tile's borders.
    """
    # a small layer is sent to the objects; for a large one both sides shuffle by cell
    tiles = broadcast_if_small(region_tiles(layer, columns, cell))
    about = tiles.agg(F.collect_set("level").alias("levels"), *[  # one row, a number for each level
        _grid(f("f" + c), cell).alias(c) for f, c in ((F.min, "xmin"), (F.min, "ymin"), (F.max, "xmax"), (F.max, "ymax"))])
    about = about.first()
    west, south, east, north = [about[c] if about.levels else n for c, n in
                                (("xmin", 0), ("ymin", 0), ("xmax", -1), ("ymax", -1))]
    homes = [h for h in range(0, max(east - west, north - south, 1).bit_length() + HOME_STEP, HOME_STEP)]
    # a tile lies in the cell of its own level, and once in each wider grid that objects live in
    tiles = tiles.withColumn("k", F.explode(F.array_union(F.array("level"), F.filter(
        F.array(*[F.lit(h) for h in homes]), lambda h: h > F.col("level")))))
    tiles = tiles.withColumn("gx", F.expr("shiftright(cx, k - level)")).withColumn(
        "gy", F.expr("shiftright(cy, k - level)"))
    boxed = with_bbox(objects, *ids).select(
        *ids, "wkb", "xmin", "ymin", "xmax", "ymax", _grid(F.col("xmin"), cell).alias("x0"), _grid(F.col("xmax"), cell).alias("x1"),
        _grid(F.col("ymin"), cell).alias("y0"), _grid(F.col("ymax"), cell).alias("y1"))
    # an object lives, as far as the layer reaches, in the grid of its size, and visits all wider tiles
    boxed = boxed.where((F.col("x0") <= east) & (F.col("x1") >= west) & (F.col("y0") <= north) & (F.col("y1") >= south))
    for low, high, first, last in (("x0", "x1", west, east), ("y0", "y1", south, north)):
        boxed = boxed.withColumn(f"l{low}", F.greatest(low, F.lit(first).cast("bigint"))).withColumn(
            f"l{high}", F.least(high, F.lit(last).cast("bigint")))
    # measured and tested by different tasks: a task that did both would hold two Python workers
    boxed = stored(boxed, "boxed")
    span = F.greatest(F.expr("lx1 - lx0"), F.expr("ly1 - ly0"))
    home = F.lit(homes[-1])
    for h in reversed(homes):
        home = F.when(span <= 1 << (h + WIDE), F.lit(h)).otherwise(home)
    visited = F.array(*[F.lit(n) for n in sorted(about.levels)]).cast("array<int>")
    spread = boxed.withColumn("home", home).withColumn("k", F.explode(F.array_union(
        F.array("home"), F.filter(visited, lambda n: n > F.col("home")))))
    for axis in "xy":
        spread = spread.withColumn(f"g{axis}", F.explode(F.expr(
            f"sequence(shiftright(l{axis}0, k), shiftright(l{axis}1, k))")))
    within = F.lit(True)
    for axis in "xy":
        within &= F.col(f"c{axis}").between(F.expr(f"shiftright({axis}0, level)"), F.expr(f"shiftright({axis}1, level)"))
    pairs = spread.join(tiles, ["k", "gx", "gy"]).where(
        (F.col("k") == F.greatest("home", "level")) & within
        & (F.col("xmin") <= F.col("fxmax")) & (F.col("fxmin") <= F.col("xmax"))
        & (F.col("ymin") <= F.col("fymax")) & (F.col("fymin") <= F.col("ymax")))
    sure = (F.size("edges") == 0) & F.expr("shiftright(x0, level) = shiftright(x1, level)") & F.expr(
        "shiftright(y0, level) = shiftright(y1, level)")
    side = F.lit(float(cell)) * F.expr("shiftleft(1L, level)")
    tested = pairs.withColumn("probe", F.when(~sure, F.col("wkb"))).withColumn(
        "hit", G.meets_tile("probe", "cx", "cy", side, "inside", "edges"))
    found = (tested.where("hit").select(*ids, "feature", "copies", *columns)
             .dropDuplicates([*ids, "feature", *columns]))
    once = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return found.withColumn("_copy", once).select(*ids, *columns)


def objects_in_region(t, cell: float = 1000.0, column: str = "lan", shapes: DataFrame | None = None,
                      **bounds: int) -> DataFrame:
    """Geometries per region name of each archive, with the names ranked by count.

    Geometries in no region count under a NULL name; one that meets two regions of the
    same name counts twice. ``shapes`` may hold the table with unreadable geometries too, which
    meet nothing: then these need not be told apart before the join.
    """
    ids = t["geo_object"].select(A, F.col("ObjectId").alias("object_id"))
    shapes = t["geo_object"] if shapes is None else shapes
    hits = region_hits(shapes.select(A, F.col("ObjectId").alias("object_id"), "wkb"),
                       [A, "object_id"], t["region"], ["namn", column], cell)
    placed = ids.join(hits.select(A, "object_id", column), [A, "object_id"], "left")
    placed = cut_lineage(placed)  # read twice below; the spatial join runs once
    lists = fold(placed, [A, column], "object_id",
                 {"object_ids": element(F.col("object_id"))}, "objects_listed", **bounds)
    totals = lists.groupBy(A, column).agg(F.max("objects_listed").alias("objects_in_lan"))
    rank = Window.partitionBy(A).orderBy(F.desc("objects_in_lan"), F.asc_nulls_last(column))
    # as many rows per archive as there are names
    totals = totals.withColumn("count_rank", F.row_number().over(rank).cast("bigint"))
    same = F.col("l.archive").eqNullSafe(F.col("n.archive")) & F.col(f"l.{column}").eqNullSafe(
        F.col(f"n.{column}"))
    return lists.alias("l").join(totals.alias("n"), same).select(
        F.col("l.archive").alias(A), F.col(f"l.{column}").alias(column), "objects_in_lan",
        "object_ids", "count_rank", "part")


def in_any_region(objects: DataFrame, ids: list[str], layer: DataFrame,
                  cell: float = 1000.0) -> DataFrame:
    """Objects that meet the union of a layer: a semi join to its parts."""
    hits = region_hits(objects, ids, layer, [], cell).distinct()
    return objects.join(hits, ids, "left_semi")


def srid_intersect(t, cell: float = 1000.0) -> DataFrame:
    """The target SRID for each archive that meets a parish, NULL for the others."""
    objects = t["geo_object"].select(A, F.col("ObjectId").alias("object_id"), "wkb")
    hits = region_hits(objects, [A, "object_id"], t["region"], ["namn"], cell)
    met = hits.select(A).distinct().withColumn("srid", F.lit(TARGET_SRID))
    return t["object"].select(A).distinct().join(met, A, "left")


# -- objects against objects ----------------------------------------------------------
PAIR_LEVELS = 11  # cells from 1 m to 4 ** 11 m


def box_pairs(boxes: DataFrame, key: str, also=None) -> DataFrame:
    """Pairs (a, b) of rows whose bounding boxes touch, each pair once; ``also`` are columns that
    come along, as a_… and b_…, and a condition on these.

    A box lives in cells about its own size and also visits the cells of larger boxes;
    small boxes only meet their neighbours however many there are.  Of the cells two
    boxes share, only the one with the lower left corner of their overlap counts.
    """
    size = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    own = F.when(size == 0, -1).when(size <= 1, 0).otherwise(
        F.least(F.ceil(F.log(4.0, size)), F.lit(PAIR_LEVELS)).cast("int"))
    more, condition = also or ([], F.lit(True))
    boxes = boxes.select(key, "xmin", "ymin", "xmax", "ymax", own.alias("own"), *more)

    def cells(df):
        side = F.expr("double(shiftleft(1L, 2 * level))")
        for axis in ("x", "y"):
            df = df.withColumn(f"c{axis}", F.explode(F.sequence(
                _grid(F.col(f"{axis}min"), side), _grid(F.col(f"{axis}max"), side))))
        return df

    def renamed(df, mark):
        return df.select("level", "cx", "cy", *[
            F.col(c).alias(f"{mark}_{c}")
            for c in (key, "own", "xmin", "ymin", "xmax", "ymax", *more)])

    # boxes without size are never at home: they meet each other only in the same place
    home = boxes.where(F.col("own") >= 0).withColumn("level", F.col("own"))
    levels = home.select("level").distinct()  # at most 12 rows
    visits = boxes.withColumn("level", F.explode(F.sequence(
        F.greatest("own", F.lit(0)), F.lit(PAIR_LEVELS)))).join(
        F.broadcast(levels), "level", "left_semi")
    a, b = renamed(cells(home), "a"), renamed(cells(visits), "b")
    side = F.expr("double(shiftleft(1L, 2 * level))")
    meet = a.join(b, ["level", "cx", "cy"]).where(
        ((F.col("b_own") < F.col("a_own")) | (F.col(f"a_{key}") < F.col(f"b_{key}")))
        & (F.col("a_xmin") <= F.col("b_xmax")) & (F.col("b_xmin") <= F.col("a_xmax"))
        & (F.col("a_ymin") <= F.col("b_ymax")) & (F.col("b_ymin") <= F.col("a_ymax"))
        & (_grid(F.greatest("a_xmin", "b_xmin"), side) == F.col("cx"))
        & (_grid(F.greatest("a_ymin", "b_ymin"), side) == F.col("cy")) & condition)
    spots = boxes.where(F.col("own") == -1).select(
        (F.col("xmin") + 0.0).alias("x"), (F.col("ymin") + 0.0).alias("y"), key, *more)
    sides = [spots.select("x", "y", *[F.col(c).alias(f"{mark}_{c}") for c in (key, *more)]) for mark in "ab"]
    stacked = sides[0].join(sides[1], ["x", "y"]).where((F.col(f"a_{key}") < F.col(f"b_{key}")) & condition)
    out = [F.col(f"a_{key}").alias("a"), F.col(f"b_{key}").alias("b"), *[f"{m}_{c}" for m in "ab" for c in more]]
    return meet.select(*out).union(stacked.select(*out))


def meeting_pairs(geometries: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """Pairs (a, b), a < b, of rows (key, wkb) that share a point, borders included; with
    ``wanted`` (key) only those of which one is among these.

    Geometries are taken apart into segments. Segments meet segments in grid cells of their size,
    and touching ones make a pair. Of geometries whose boxes meet, one may also lie in the other:
    the first point of each part counts the borders beside it, in bands of the other geometry's
    height. No geometry's bytes are joined, so a large outline costs its segments once, however
    many it meets. The parts of a collection are looked at one by one.
    """
    rows = stored(in_segments(geometries).withColumn("no", F.monotonically_increasing_id()), "segments")
    ends = {f"{end}{axis}": f(f"{axis}1", f"{axis}2") for axis in "xy" for end, f in (("min", F.least), ("max", F.greatest))}
    flat = rows.select("no", "key", "x1", "y1", "x2", "y2", *[c.alias(f"{n[-1]}{n[:-1]}") for n, c in ends.items()])
    boxes = flat.groupBy("key").agg(*[f(c).alias(c) for c, f in (
        ("xmin", F.min), ("ymin", F.min), ("xmax", F.max), ("ymax", F.max))])
    near = box_pairs(boxes, "key").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    if wanted is not None:
        mark = lambda side: wanted.select(F.col("key").alias(side), F.lit(True).alias(f"wanted_{side}"))
        near = near.join(mark("a"), "a", "left").join(mark("b"), "b", "left").where(
            F.col("wanted_a") | F.col("wanted_b")).select("a", "b")
    near = stored(near, "near")
    # only segments of geometries whose boxes meet others look for each other
    some = near.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    flat = flat.join(some, "key", "left_semi")
    touching = box_pairs(flat, "no", (["key", "x1", "y1", "x2", "y2"], F.col("a_key") != F.col("b_key"))).where(
        edges_touch("a_", "b_")).select(F.least("a_key", "b_key").alias("a"), F.greatest("a_key", "b_key").alias("b"))
    touching = stored(touching.distinct().join(near, ["a", "b"], "left_semi"), "touching")
    near = near.join(touching, ["a", "b"], "left_anti")
    both = stored(near.select(F.inline(F.array(
        F.struct(F.col("a").alias("inner"), F.col("b").alias("outer")),
        F.struct(F.col("b").alias("inner"), F.col("a").alias("outer"))))), "open")
    areas = rows.where("area").withColumnRenamed("key", "outer")
    grids = areas.groupBy("outer").agg(F.max("sy").alias("sy"))
    heads = rows.where("head").select(F.col("key").alias("inner"), F.col("x1").alias("px"), F.col("y1").alias("py"))
    spots = both.join(grids, "outer").join(heads, "inner").withColumn(
        "band", _grid(F.col("py"), F.col("sy"))).select("outer", "band", "inner", "px", "py")
    counted = spots.join(with_bands(areas).select(
        "outer", "band", F.when(F.col("apart"), F.col("part")).otherwise(-1).alias("part"), "x1", "y1", "x2", "y2"),
        ["outer", "band"]).where(ray_meets("px", "py")).groupBy("inner", "outer", "px", "py", "part").agg(
        F.count(F.lit(1)).alias("n"))
    within = counted.where(F.col("n") % 2 == 1).select(
        F.least("inner", "outer").alias("a"), F.greatest("inner", "outer").alias("b"))
    return touching.union(within.distinct())


def same_geometry(t, **bounds: int) -> DataFrame:
    """Objects of an archive that share a geometry, byte for byte in canonical form.

    Grouped by a 128-bit key; a geometry's bytes are joined to its lists once.
    """
    rows = t["geo_object"].select(A, F.col("ObjectId").alias("object_id"),
                                  G.canonical("wkb").alias("wkb"), "srid")
    rows = stored(rows.withColumn("pk", geometry_key()), "same")
    lists = fold(rows.select(A, "pk", "object_id"), [A, "pk"], "object_id",
                 {"object_ids": element(F.col("object_id"))}, "occurrence", **bounds)
    shapes = rows.groupBy(A, "pk").agg(F.max("wkb").alias("wkb"), F.max("srid").alias("srid"))
    return lists.join(shapes, [A, "pk"]).select(
        A, "wkb", "srid", "part", "occurrence", "object_ids")


def geometry_key() -> Column:
    """128 bits of a geometry and its system."""
    about = F.concat_ws("|", F.coalesce(F.col("srid").cast("string"), F.lit("")), F.col("wkb").isNull().cast("string"))
    return F.md5(F.concat(F.coalesce("wkb", F.lit(b"")), F.encode(about, "UTF-8")))


def occurrences(t) -> DataFrame:
    """Each geometry of each archive once: pk, archive, wkb, srid."""
    rows = t["geo_object"].select(G.canonical("wkb").alias("wkb"), "srid", A)
    return rows.withColumn("pk", geometry_key()).groupBy("pk", A).agg(
        F.max("wkb").alias("wkb"), F.max("srid").alias("srid"))


def grouped_geometries(found: DataFrame) -> DataFrame:
    """Occurrences by geometry, with the archives of each."""
    grouped = found.groupBy("pk").agg(
        F.max("wkb").alias("the_geom"), F.max("srid").alias("srid"),
        F.array_sort(F.collect_set(A)).alias("databases"))  # at most all archive names
    return grouped.select("databases", F.size("databases").alias("db_occurrence"), "the_geom",
                          "srid", "pk")


def same_geometry_all(t) -> DataFrame:
    """Geometries with the archives they occur in; the key is a 128-bit hash."""
    rows = t["geo_object"].select(G.canonical("wkb").alias("wkb"), "srid", A)
    return grouped_geometries(rows.withColumn("pk", geometry_key()))


def geometry_pairs(groups: DataFrame, fresh: DataFrame | None = None) -> DataFrame:
    """Keys of geometries that meet, (pk, other) in both directions; with ``fresh`` (pk) only
    those of which one is among these."""
    rows = stored(groups.where(F.col("the_geom").isNotNull()).select(
        F.monotonically_increasing_id().alias("key"), "pk", F.col("the_geom").alias("wkb")), "groups")
    wanted = None if fresh is None else rows.select("key", "pk").join(fresh, "pk", "left_semi").select("key")
    keys = [rows.select(F.col("key").alias(side), F.col("pk").alias(f"pk_{side}")) for side in "ab"]
    named = meeting_pairs(rows, wanted).join(keys[0], "a").join(keys[1], "b")
    return named.select(F.inline(F.array(
        F.struct(F.col("pk_a").alias("pk"), F.col("pk_b").alias("other")),
        F.struct(F.col("pk_b").alias("pk"), F.col("pk_a").alias("other")))))


def partner_lists(groups: DataFrame, pairs: DataFrame, **bounds: int) -> DataFrame:
    """Geometries with the keys and archives of those they meet."""
    other = groups.select(F.col("pk").alias("other"), F.array_join("databases", ",").alias("other_dbs"))
    lists = fold(pairs.join(other, "other"), ["pk"], "other", {
        "intersect_pk": element(F.col("other")),
        "intersect_dbs": element(F.col("other_dbs"))}, **bounds)
    return groups.join(lists, "pk").select(
        "databases", "db_occurrence", "the_geom", "pk", "intersect_pk", "intersect_dbs", "part")


def geometry_intersects(groups: DataFrame, **bounds: int) -> DataFrame:
    """Geometries that meet others: their keys and archive lists.

    ``groups`` is the result of `same_geometry_all`; see `meeting_pairs`.
    """
    groups = stored(groups, "groups")
    return partner_lists(groups, geometry_pairs(groups), **bounds)


# -- reports and edits -------------------------------------------------------------------
NO_INVALID = "No invalid objects found"


def validity_report(t, **bounds: int) -> DataFrame:
    """Invalid geometries per archive: how many in all, and their ids; a list too long for one
    row goes on in further parts. Judged by joins between edges, see `operators.validity`."""
    rows = stored(t["geo_object"].where(F.col("wkb").isNotNull()).select(
        F.monotonically_increasing_id().alias("key"), A, F.col("ObjectId").alias("object_id"), "wkb"), "judged")
    invalid = rows.select("key", A, "object_id").join(invalid_reasons(rows), "key")
    lists = fold(invalid, [A], "object_id",
                 {"ids": element(F.col("object_id").cast("string"))}, "invalid_count", **bounds)
    return t["object"].select(A).distinct().join(lists, A, "left").select(
        A, F.coalesce("invalid_count", F.lit(0)).alias("invalid_count"),
        F.coalesce(F.array_join("ids", ","), F.lit(NO_INVALID)).alias("invalid_objects"),
        F.coalesce("part", F.lit(0)).alias("part"))


def geom_measures(t) -> DataFrame:
    """Type, size, box, centroid and SRID of every geometry."""
    return t["geo_object"].select(A, "ObjectId", "srid", G.geom_stats("wkb").alias("g")).select(
        A, "ObjectId", "srid",
        *[f"g.{c}" for c in ("gtype", "npoints", "xmin", "ymin", "xmax", "ymax", "cx", "cy")])


def geom_to_wkt(t) -> DataFrame:
    shaped = t["geo_object"].select(A, "ObjectId", "srid", G.decode_shape("wkb").alias("s"))
    return shaped.select(A, "ObjectId", G.wkt(F.col("s")).alias("wkt"),
                         G.ewkt(F.col("s"), F.col("srid")).alias("ewkt"))


def force_2d(t) -> DataFrame:
    return t["geo_object"].withColumn("_s", G.decode_shape("wkb")).withColumn(
        "_s", G.flatten_z(F.col("_s"))).withColumn("wkb", G.encode_shape("_s")).drop("_s")


def normalize_geometry(t) -> DataFrame:
    """Geometries tidied, with marks for what changed and what stays invalid. Tidying is one pass
    over a batch's points; what stays invalid is found by joins between edges."""
    tidied = stored(t["geo_object"].select("*", G.tidy_wkb("wkb").alias("tidy")).select(
        F.monotonically_increasing_id().alias("key"), A, "ObjectId", "MetaId", "SymbolId", F.col("tidy").alias("wkb"),
        "srid", (~F.col("wkb").eqNullSafe(F.col("tidy"))).alias("repaired")), "tidied")
    problems = invalid_reasons(tidied).withColumnRenamed("why", "problem")
    return tidied.join(problems, "key", "left").select(
        A, "ObjectId", "MetaId", "SymbolId", "wkb", "srid", "repaired",
        F.col("problem").isNotNull().alias("still_invalid"), "problem")


def error_rows(t) -> tuple[DataFrame, DataFrame]:
    """Readable geometries, and an error row for each of the others."""
    read = t["geo_object"].withColumn("s", G.once(G.decode_shape("wkb")))
    good = read.where(F.col("s.error").isNull()).drop("s")
    bad = read.where(F.col("s.error").isNotNull()).select(
        A, "ObjectId", F.lit("Error in parsing geometry").alias("label"),
        F.col("s.error").alias("message"))
    return good, bad


def apply_geometry_fixes(t, *sources: DataFrame) -> DataFrame:
    """Geometry table with corrected geometries put in.

    A source has ``archive, object_ids, wkb``; the ids are a comma list.  Later sources
    win, as later updates would.
    """
    fixes = None
    for rank, source in enumerate(sources):
        ids = F.explode(F.split("object_ids", ","))
        rows = source.select(A, ids.alias("id"), "wkb").select(
            A, F.trim("id").cast("bigint").alias("ObjectId"),
            F.struct(F.lit(rank).alias("rank"), F.col("wkb")).alias("fix"))
        fixes = rows if fixes is None else fixes.union(rows)
    last = fixes.groupBy(A, "ObjectId").agg(F.max("fix").alias("fix"))
    return t["geo_object"].join(last, [A, "ObjectId"], "left").select(
        A, "ObjectId", "MetaId", "SymbolId",
        F.when(F.col("fix").isNotNull(), F.col("fix.wkb")).otherwise(F.col("wkb")).alias("wkb"),
        "srid")
