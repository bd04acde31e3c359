"""Why geometries are invalid, by joins between their edges.

Rings of a polygon, and shells of a multipolygon, may touch in points but neither cross nor
share a line; holes lie in their shell and not in each other. The members of a collection are
judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trowel.functions import edges as E
from trowel.session import stored

# Reasons in the order in which they count; the first of a geometry is told.
ALONE = {E.UNREADABLE: (0, None), E.NOT_FINITE: (0, "coordinate not finite"), E.TOO_FEW: (0, "too few points"),
         E.NOT_CLOSED: (0, "ring not closed"), E.TOO_FEW_LEFT: (1, "too few points")}
OF_RING = ["ring crosses itself", "ring folds back"]
OF_PAIR = ["rings share a line", "rings cross", "hole outside shell", "nested holes", "nested shells"]

_NEAR = 1e-9  # shares of an edge that are one place


def _fault(stage: int, a: Column, b: Column, rank: int, why: Column) -> Column:
    return F.struct(F.lit(stage).alias("stage"), a.cast("int").alias("a"), b.cast("int").alias("b"),
                    F.lit(rank).alias("rank"), why.alias("why")).alias("fault")


def _ring_fault(rank: int) -> Column:
    return _fault(1, F.col("a_ring"), F.lit(-1), rank, F.lit(OF_RING[rank]))


def _pair_fault(a: str, b: str, rank: int) -> Column:
    return _fault(2, F.col(a), F.col(b), rank, F.lit(OF_PAIR[rank]))


def _marked(rows: DataFrame, mark: str, *columns: str) -> DataFrame:
    return rows.select("key", *[c for c in ("cx", "cy") if c in rows.columns],
                       *[F.col(c).alias(f"{mark}_{c}") for c in columns])


def _touching(edges: DataFrame) -> DataFrame:
    """Pairs of edges of one geometry that share a point, from cells that both cross."""
    cells = E.with_cells(edges)
    columns = ("ring", "part", "apart", "seq", "size", "x1", "y1", "x2", "y2")
    first = (F.col("a_ring") < F.col("b_ring")) | (
        (F.col("a_ring") == F.col("b_ring")) & (F.col("a_seq") < F.col("b_seq")))
    return _marked(cells, "a", *columns).join(_marked(cells, "b", *columns), ["key", "cx", "cy"]).where(
        first & ((F.col("a_part") == F.col("b_part")) | ~F.col("a_apart")) & E.edges_touch("a_", "b_")).drop("cx", "cy")


def _places(touches: DataFrame, edges: DataFrame) -> DataFrame:
    """Points (key, ring, other, px, py) of a ring, one between each two places where it touches
    another ring: on such a stretch it is all inside or all outside of the other."""
    sides = [touches.select("key", F.col(f"{a}_ring").alias("ring"), F.col(f"{b}_ring").alias("other"),
                            F.col(f"{a}_seq").alias("seq"), F.col(f"{a}_size").alias("size"),
                            E.place_on(f"{a}_", f"{b}_").alias("at")) for a, b in (("a", "b"), ("b", "a"))]
    stops = sides[0].union(sides[1]).where(F.col("at").isNotNull())
    ends = F.col("at") > 1 - _NEAR  # the end of an edge is the start of the next
    stops = stops.select(
        "key", "ring", "other", F.when(ends, (F.col("seq") + 1) % F.col("size")).otherwise(F.col("seq")).alias("seq"),
        F.when(ends, 0.0).otherwise(F.col("at")).alias("at")).distinct()
    following = F.lead("at").over(Window.partitionBy("key", "ring", "other", "seq").orderBy("at"))
    stops = stops.withColumn("until", F.coalesce(following, F.lit(1.0))).where(F.col("until") - F.col("at") > _NEAR)
    middle = (F.col("at") + F.col("until")) / 2
    return stops.join(edges.select("key", "ring", "seq", "sy", "x1", "y1", "x2", "y2"), ["key", "ring", "seq"]).select(
        "key", "ring", "other", "sy", (F.col("x1") + middle * (F.col("x2") - F.col("x1"))).alias("px"),
        (F.col("y1") + middle * (F.col("y2") - F.col("y1"))).alias("py"))


def _insides(points: DataFrame, edges: DataFrame) -> DataFrame:
    """Rows (key, ring, other, px, py, around) for each point that lies inside ring ``around``: a
    level ray to the right meets that ring's edges an odd number of times. Points and edges meet in
    bands of y. A point with a ring ``other`` is tested against that one only."""
    spots = points.withColumn("band", F.floor(F.col("py") / F.col("sy")).cast("bigint")).select(
        "key", "band", "ring", "other", "px", "py", "part", "apart")
    borders = E.with_bands(edges).select(
        "key", "band", F.col("ring").alias("around"), F.col("part").alias("around_part"), "x1", "y1", "x2", "y2")
    met = spots.join(borders, ["key", "band"]).where(
        (F.col("around") != F.col("ring")) & (F.coalesce("other", "around") == F.col("around"))
        & (~F.col("apart") | (F.col("part") == F.col("around_part"))) & E.ray_meets("px", "py"))
    return met.groupBy("key", "ring", "other", "px", "py", "around").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") % 2 == 1).drop("n")


def _relations(touches: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """How rings lie to each other (key, ring, around, within, without), for pairs in which the
    first is not wholly outside; and the rings (key, ring, part, kind)."""
    several = edges.where(F.col("rings") > 1)
    rings = several.where(F.col("seq") == 0).select("key", "ring", "part", "kind", "apart")
    between = _places(touches, several).distinct().join(rings.select("key", "ring", "part", "apart"), ["key", "ring"])
    heads = several.where(F.col("seq") == 0).select(
        "key", "ring", F.lit(None).cast("int").alias("other"), "sy", F.col("x1").alias("px"), F.col("y1").alias("py"),
        "part", "apart")
    points = stored(between.unionByName(heads), "points")
    found = stored(_insides(points, several), "insides")
    tried = points.where(F.col("other").isNotNull()).groupBy("key", "ring", "other").agg(
        F.count(F.lit(1)).alias("tried"))
    inner = found.where(F.col("other").isNotNull()).groupBy("key", "ring", "other").agg(F.count(F.lit(1)).alias("inner"))
    touched = stored(tried.join(inner, ["key", "ring", "other"], "left").select(
        "key", "ring", F.col("other").alias("around"), (F.coalesce("inner", F.lit(0)) > 0).alias("within"),
        (F.coalesce("inner", F.lit(0)) < F.col("tried")).alias("without")), "touched")
    alone = found.where(F.col("other").isNull()).select("key", "ring", "around").join(
        touched, ["key", "ring", "around"], "left_anti")
    return stored(alone.select("*", F.lit(True).alias("within"), F.lit(False).alias("without")).union(touched),
                  "relations"), rings


def _pair_faults(relations: DataFrame, rings: DataFrame) -> list[DataFrame]:
    out = [relations.where(
        (F.col("around") < F.col("ring")) & F.col("within") & F.col("without")).select("key", _pair_fault("around", "ring", 1))]
    shells = rings.where(E.is_shell("kind")).select("key", "part", F.col("ring").alias("around"))
    held = rings.where(E.is_hole("kind")).select("key", "part", "ring").join(shells, ["key", "part"]).join(
        relations, ["key", "ring", "around"], "left")
    out.append(held.where(F.coalesce("without", F.lit(True))).select("key", _pair_fault("around", "ring", 2)))
    about = lambda mark: rings.select("key", *[F.col(c).alias(f"{mark}{c}") for c in ("ring", "part", "kind")])
    inner = relations.where("within").join(about("r_").withColumnRenamed("r_ring", "ring"), ["key", "ring"]).join(
        about("a_").withColumnRenamed("a_ring", "around"), ["key", "around"]).withColumn(
        "low", F.least("ring", "around")).withColumn("high", F.greatest("ring", "around"))
    same = F.col("r_part") == F.col("a_part")
    out.append(inner.where(same & E.is_hole("r_kind") & E.is_hole("a_kind")).select("key", _pair_fault("low", "high", 3)))
    # a shell inside another part lies in one of that part's holes
    free = inner.where(E.is_shell("r_kind") & E.is_hole("a_kind") & ~F.col("without")).select(
        "key", "ring", "a_part").distinct()
    out.append(inner.where(~same & E.is_shell("r_kind") & E.is_shell("a_kind")).join(
        free, ["key", "ring", "a_part"], "left_anti").select("key", _pair_fault("low", "high", 4)))
    return out


def invalid_reasons(geometries: DataFrame, one_cell: int = E.ONE_CELL) -> DataFrame:
    """The invalid ones among rows (key, wkb), as rows (key, why); keys are whole numbers that do
    not repeat.

    Polygon rings are taken apart into edge rows. Edges of one geometry meet in grid cells whose
    sides follow its mean edge, so each crosses few cells and the cells of a large geometry are
    spread over tasks; those of up to ``one_cell`` edges need no grid. Touching edges give the faults of single rings and the places where rings
    touch. How rings lie to each other is counted by rays: points and edges meet in bands. Of all
    faults of a geometry the first one counts: by ring, then by pair of rings.

    Defined cases: a missing geometry is not invalid; bytes that are no geometry are; points,
    and lines with two different points, are valid; an empty geometry is valid.
    """
    apart = stored(E.taken_apart(geometries.where(F.col("wkb").isNotNull()), one_cell), "edges")
    edges = apart.where(F.col("fault").isNull())
    stage, why = F.lit(0), F.col("message")
    for code, (at, text) in ALONE.items():
        stage = F.when(F.col("fault") == code, at).otherwise(stage)
        why = F.when(F.col("fault") == code, F.lit(text)).otherwise(why) if text else why
    found = [apart.where(F.col("fault").isNotNull()).select("key", F.struct(
        stage.alias("stage"), F.col("ring").alias("a"), F.lit(-1).alias("b"), F.lit(-1).alias("rank"),
        why.alias("why")).alias("fault"))]
    neighbours = (F.col("b_seq") - F.col("a_seq") == 1) | (
        (F.col("a_seq") == 0) & (F.col("b_seq") == F.col("a_size") - 1))
    ux, uy = F.col("a_x2") - F.col("a_x1"), F.col("a_y2") - F.col("a_y1")
    vx, vy = F.col("b_x2") - F.col("b_x1"), F.col("b_y2") - F.col("b_y1")
    back = (ux * vy == uy * vx) & (ux * vx + uy * vy < 0)
    one = F.col("a_ring") == F.col("b_ring")
    # of the neighbours only those that fold back are of interest: few rows are written
    touches = stored(_touching(edges).where(~one | ~neighbours | back), "touches")
    found.append(touches.where(one & ~neighbours).select("key", _ring_fault(0)))
    found.append(touches.where(one & neighbours).select("key", _ring_fault(1)))
    if not edges.where(F.col("rings") > 1).isEmpty():
        line = E.edges_share_a_line("a_", "b_")
        found.append(touches.where(~one & line).select("key", _pair_fault("a_ring", "b_ring", 0)))
        found += _pair_faults(*_relations(touches.where(~one), edges))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    return every.groupBy("key").agg(F.min("fault").alias("fault")).select("key", F.col("fault.why").alias("why"))
