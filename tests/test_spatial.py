import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.brute_validity import invalid_reason
from tests.small import BOWTIE, OPEN_RING, box, line, point, polygon
from trowel.functions import geometry as G
from trowel.functions import planar, wkb
from trowel.functions import projection as P
from trowel.functions.wkb import SHELL
from trowel.operators import reproject, site, spatial, validity
from trowel.operators.median import geometric_median, least_sum
from trowel.session import cut_lineage


def shapes(spark, bufs):
    return spark.createDataFrame([(i, b) for i, b in enumerate(bufs)], "id int, wkb binary")


def test_text_and_measures(spark):
    hole = polygon([(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)],
                   [(1, 1), (1, 3), (3, 3), (3, 1), (1, 1)])
    bufs = [point(1.5, -2), line((0, 0), (4, 0)), hole, None, b"junk",
            wkb.write_rings(4, [(0, 0, np.array([[1.0, 2.0]])), (1, 0, np.array([[3.0, 4.0]]))]),
            wkb.write_rings(1, [(0, 0, np.array([[1.0, 2.0, 3.0]]))]),
            wkb.write_rings(6, [(0, 2, np.array([[0, 0], [1, 0], [1, 1], [0, 0.0]])),
                                (1, 2, np.array([[5, 5], [6, 5], [6, 6], [5, 5.0]]))]),
            point(12345678.25, 0.00001)]
    df = shapes(spark, bufs).withColumn("s", G.decode_shape("wkb"))
    got = df.select("id", G.wkt(F.col("s")).alias("t"), G.ewkt(F.col("s"), F.lit(3006)).alias("e"),
                    G.geom_stats("wkb").alias("g")).orderBy("id").collect()
    assert [r.t for r in got] == [
        "POINT(1.5 -2)", "LINESTRING(0 0,4 0)",
        "POLYGON((0 0,10 0,10 10,0 10,0 0),(1 1,1 3,3 3,3 1,1 1))", None, None,
        "MULTIPOINT(1 2,3 4)", "POINT Z (1 2 3)",
        "MULTIPOLYGON(((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))", "POINT(12345678.25 0.00001)"]
    assert got[6].e == "SRID=3006;POINT(1 2 3)"
    assert (got[1].g.cx, got[1].g.cy, got[1].g.xmax) == (2.0, 0.0, 4.0)
    area = 100 - 4
    assert got[2].g.cx == pytest.approx((100 * 5 - 4 * 2) / area)
    assert got[3].g is None and got[4].g.error and got[4].g.cx is None


def test_bytes_survive_a_round_trip(spark):
    bufs = [point(1, 2), line((0, 0), (1, 5), (2, 2)), box(0, 0, 3, 4), BOWTIE,
            wkb.write_rings(3, [(0, 2, np.array([[0, 0, 1], [1, 0, 1], [1, 1, 1], [0, 0, 1.0]]))])]
    df = shapes(spark, bufs).select("wkb", G.decode_shape("wkb").alias("s"))
    assert [bytes(r.b) for r in df.select(G.encode_shape("s").alias("b")).collect()] == bufs
    flat = df.select(G.flatten_z(F.col("s")).alias("f")).select(G.encode_shape("f").alias("b"))
    assert len(bytes(flat.collect()[4].b)) == 13 + 4 * 16


def test_big_endian_and_embedded_srid():
    import struct
    big = struct.pack(">BIdd", 0, 1, 3.0, 4.0)
    tagged = struct.pack("<BIIdd", 1, 1 | 0x20000000, 3006, 3.0, 4.0)
    for buf in (big, tagged):
        gtype, rings = wkb.read_rings(buf)
        assert gtype == 1 and rings[0][2].tolist() == [[3.0, 4.0]]


def test_arcs_become_segments():
    import struct
    half = struct.pack("<BII", 1, 8, 3) + struct.pack("<6d", 0, 0, 1, 1, 2, 0)
    gtype, rings = wkb.read_rings(half)
    pts = rings[0][2]
    assert gtype == 2 and len(pts) > 30
    assert np.allclose(np.hypot(pts[:, 0] - 1, pts[:, 1]), 1)
    assert pts[0].tolist() == [0, 0] and pts[-1].tolist() == [2, 0] and (pts[:, 1] >= -1e-9).all()


SQUARE = [(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)]
RING = [(3, 3), (6, 3), (6, 6), (3, 6), (3, 3)]


def collected(kind, *parts):
    return struct.pack("<BII", 1, kind, len(parts)) + b"".join(parts)


JUDGED = [
    (box(0, 0, 1, 1), None), (point(1, 1), None), (None, None),
    (BOWTIE, "ring crosses itself"), (OPEN_RING, "ring not closed"),
    (point(float("inf"), 0), "coordinate not finite"), (line((1, 1), (1, 1)), "too few points"),
    (polygon([(0, 0), (4, 0), (4, 4), (0, 0)], [(5, 5), (6, 5), (6, 6), (5, 5)]),
     "hole outside shell"),
    (polygon([(0, 0), (4, 0), (2, 0), (0, 0)]), "ring folds back"),
    (polygon([(0, 0), (4, 0), (2, 0), (2, 2), (0, 0)]), "ring crosses itself"),
    (collected(6, box(0, 0, 2, 2), box(0, 0, 2, 2)), "rings share a line"),
    (collected(6, box(0, 0, 2, 2), box(1, 0, 3, 2)), "rings share a line"),
    (collected(6, box(0, 0, 2, 2), box(1, 1, 3, 3)), "rings cross"),
    (collected(6, box(0, 0, 9, 9), box(1, 1, 3, 3)), "nested shells"),
    (collected(6, box(0, 0, 2, 2), box(2, 2, 3, 3)), None),
    (collected(6, polygon(SQUARE, RING), box(4, 4, 5, 5)), None),
    (collected(7, box(0, 0, 2, 2), box(1, 1, 3, 3)), None),
    (polygon(SQUARE, SQUARE), "rings share a line"),
    (polygon(SQUARE, [(0, 3), (2, 3), (2, 5), (0, 5), (0, 3)]), "rings share a line"),
    (polygon(SQUARE, RING, [(4, 4), (5, 4), (5, 5), (4, 5), (4, 4)]), "nested holes"),
    (polygon(SQUARE, [(0, 3), (2, 2), (2, 4), (0, 3)]), None),
    (polygon(SQUARE, [(-1, 0), (5, 6), (6, 5), (-1, 0)]), "rings cross"),
]


@pytest.mark.parametrize("buf, why", JUDGED)
def test_validity_by_hand(buf, why):
    assert buf is None or invalid_reason(*reversed(wkb.read_rings(buf))) == why


def reasons(spark, bufs, **how):
    found = validity.invalid_reasons(shapes(spark, bufs).select(F.col("id").cast("bigint").alias("key"), "wkb"), **how)
    return {r.key: r.why for r in found.collect()}


def test_validity_by_edges(spark):
    assert reasons(spark, [buf for buf, _ in JUDGED] + [b"junk"]) == {
        **{i: why for i, (_, why) in enumerate(JUDGED) if why}, len(JUDGED): reasons(spark, [b"junk"])[0]}


def circle(x, y, r, n, step=None, jitter=None):
    at = np.sort([jitter.random() for _ in range(n)]) if jitter else np.arange(n) / n
    pts = np.column_stack([x + r * np.cos(2 * np.pi * at), y + r * np.sin(2 * np.pi * at)])
    pts = np.round(pts / step) * step if step else pts
    return np.vstack([pts, pts[:1]])


def judged_shapes(seed, n):
    """Walks, holes, parts and large rings with one pair of corners exchanged, on coarse grids."""
    rand = random.Random(seed)
    out = []
    for _ in range(n):
        sort = rand.randrange(5)
        rings = []
        if sort == 0:
            walk = np.array([[rand.randrange(6), rand.randrange(6)] for _ in range(rand.randrange(3, 9))], float)
            rings.append((0, wkb.SHELL, np.vstack([walk, walk[:1]])))
        elif sort == 1:
            rings.append((0, wkb.SHELL, circle(0, 0, 10, rand.randrange(4, 12), 1)))
            for _ in range(rand.randrange(1, 4)):
                rings.append((0, wkb.HOLE, circle(rand.randrange(-8, 9), rand.randrange(-8, 9),
                                                  rand.choice([1, 2, 3, 5]), rand.randrange(4, 9), 1)))
        elif sort in (2, 3):
            for part in range(rand.randrange(2, 5)):
                x, y, r = rand.randrange(-6, 7), rand.randrange(-6, 7), rand.choice([2, 3, 6, 8])
                rings.append((part, wkb.SHELL, circle(x, y, r, rand.choice([4, 8]), 1)))
                if rand.random() < 0.5:
                    rings.append((part, wkb.HOLE, circle(x, y, r - 1, 4, 1)))
        else:
            pts = circle(5e6, 6e6, 1000, rand.randrange(70, 200), jitter=rand)
            if rand.random() < 0.5:
                i, j = rand.randrange(len(pts) - 1), rand.randrange(len(pts) - 1)
                pts[[i, j]] = pts[[j, i]]
                pts[-1] = pts[0]
            rings.append((0, wkb.SHELL, pts))
        out.append(wkb.write_rings({2: 6, 3: 7}.get(sort, 3), rings))
    return out


@pytest.mark.parametrize("one_cell", [64, 0])
def test_validity_against_all_pairs_of_segments(spark, one_cell):
    bufs = judged_shapes(one_cell, 500)
    want = {i: invalid_reason(*reversed(wkb.read_rings(b))) for i, b in enumerate(bufs)}
    assert reasons(spark, bufs, one_cell=one_cell) == {i: w for i, w in want.items() if w}


def test_large_geometries_are_spread(spark):
    octagons = [(i, wkb.SHELL, circle(10 * (i % 100), 10 * (i // 100), 4, 8)) for i in range(10_000)]
    crossed = octagons[:-1] + [(9999, wkb.SHELL, circle(985, 990, 4, 8))]
    ring = circle(5e5, 6e6, 1000, 10 ** 6)
    holes = [(0, wkb.HOLE, circle(5e5 - 300 + 20 * (i % 30), 6e6 - 300 + 20 * (i // 30), 4, 8)) for i in range(900)]
    outside = holes + [(0, wkb.HOLE, circle(5e5 + 2000, 6e6, 4, 8))]
    bufs = [wkb.write_rings(6, octagons), wkb.write_rings(6, crossed), wkb.write_rings(3, [(0, wkb.SHELL, ring), *holes]),
            wkb.write_rings(3, [(0, wkb.SHELL, ring), *outside])]
    assert reasons(spark, bufs) == {1: "rings cross", 3: "hole outside shell"}


def test_tidied_bytes_are_those_of_each_ring_alone(spark):
    bufs = judged_shapes(3, 60) + [point(1, 2), line((0, 0), (0, 0), (1, 1)), OPEN_RING, OPEN_RING + b"behind", None,
                                   wkb.write_rings(1, []), wkb.write_rings(3, []),
                                   wkb.write_rings(2, [(0, 1, np.array([[0, 0, 1.0], [0, 0, 2], [0, 0, 2]]))])]
    got = shapes(spark, bufs).select("id", G.tidy_wkb("wkb").alias("t"), G.flat_tidy_wkb("wkb").alias("f")).collect()
    for r in got:
        if bufs[r.id] is None:
            assert r.t is None and r.f is None
            continue
        gtype, rings = wkb.read_rings(bufs[r.id])
        assert bytes(r.t) == wkb.write_rings(gtype, wkb.tidy(rings))
        assert bytes(r.f) == wkb.write_rings(gtype, wkb.tidy([(p, k, x[:, :2]) for p, k, x in rings]))


def test_validity_report(tables):
    got = {r.archive: (r.invalid_count, r.invalid_objects)
           for r in spatial.validity_report(tables).collect()}
    assert got == {"a1": (2, "102,103"), "a2": (0, spatial.NO_INVALID),
                   "a3": (0, spatial.NO_INVALID)}


def test_normalize(tables):
    got = {r.ObjectId: r for r in spatial.normalize_geometry(tables).where("archive = 'a1'").collect()}
    assert got[103].repaired and not got[103].still_invalid
    assert got[102].still_invalid and not got[102].repaired


def random_shapes(seed, n, size=12.0):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        x, y = rng.uniform(-40, 40), rng.uniform(-40, 40)
        w = rng.choice([0.5, 3, 30]) * rng.random()
        kind = rng.randrange(4)
        if kind == 0:
            out.append(point(round(x), round(y)))
        elif kind == 1:
            out.append(line((x, y), (x + w, y - w), (x + 2 * w, y)))
        elif kind == 2:
            out.append(box(round(x), round(y), round(x) + math.ceil(w), round(y) + math.ceil(w)))
        else:
            k = rng.randrange(3, 8)
            turn = [(2 * math.pi * i / k) for i in range(k)]
            pts = [(x + w * math.cos(a), y + w * math.sin(a)) for a in turn]
            out.append(polygon(pts + pts[:1]))
    return out


def brute_force(a, b):
    """One pair at a time, by the simple definitions."""
    ra, rb = wkb.read_rings(a)[1], wkb.read_rings(b)[1]
    if planar.any_touch(planar.segments(ra), planar.segments(rb)):
        return True
    for area, other in ((ra, rb), (rb, ra)):
        edges = planar.segments([r for r in area if r[1] >= 2])
        if len(edges) and any(planar.inside(*p[0, :2], edges) for _, _, p in other):
            return True
    return False


def test_batches_equal_single_tests():
    a, b = random_shapes(1, 300), random_shapes(2, 300)
    assert planar.intersects(a, b) == [brute_force(p, q) for p, q in zip(a, b)]


@pytest.mark.parametrize("cell", [5.0, 16.0, 1000.0])
def test_region_join_equals_brute_force(spark, cell):
    objects = random_shapes(3, 120)
    ring = [(-30, -30), (30, -25), (10, 0), (30, 30), (-20, 20), (-30, -30)]
    layer = [box(-50, -50, 50, 50), polygon(ring), box(0, 0, 10, 10), box(10, 0, 20, 10),
             polygon([(-20, -20), (20, -20), (20, 20), (-20, 20), (-20, -20)],
                     [(-10, -10), (-10, 10), (10, 10), (10, -10), (-10, -10)])]
    df = shapes(spark, objects)
    regions = shapes(spark, layer).withColumnRenamed("id", "region")
    got = {tuple(r) for r in spatial.region_hits(df, ["id"], regions, ["region"], cell).collect()}
    want = {(i, j) for i, o in enumerate(objects) for j, r in enumerate(layer)
            if brute_force(o, r)}
    assert got == want


def covered(rings, cell):
    """Tile -> (inside, edges) of a feature."""
    return {(level, int(x), int(y)): (bool(ins), {tuple(e) for e in edges[a:b]})
            for level, cells, inside, at, edges in planar.tiles(rings, cell)
            for (x, y), ins, a, b in zip(cells, inside, at, at[1:])}


@pytest.mark.parametrize("cell", [1.0, 3.0, 7.3, 50.0])
def test_tiles_cover_the_feature_once_with_all_its_edges(cell):
    rng = np.random.default_rng(5)
    for _ in range(8):
        pts = rng.integers(-20, 20, (rng.integers(3, 9), 2)) * rng.choice([1.0, 0.5])
        rings = [(0, SHELL, np.vstack([pts, pts[:1]]))]
        edges, got = planar.segments(rings), covered(rings, cell)
        low, high = (np.floor(f(0) / cell).astype(int) for f in (pts.min, pts.max))
        for x in range(low[0] - 1, high[0] + 2):
            for y in range(low[1] - 1, high[1] + 2):
                here = [t for t in got if (x >> t[0], y >> t[0]) == t[1:]]
                assert len(here) <= 1
                sides = np.array([[x, y, x + 1, y], [x + 1, y, x + 1, y + 1],
                                  [x + 1, y + 1, x, y + 1], [x, y + 1, x, y]]) * cell
                for e in edges:
                    own = [np.floor(e[[i, i + 2]] / cell) for i in (0, 1)]
                    near = own[0].min() <= x <= own[0].max() and own[1].min() <= y <= own[1].max()
                    ends_here = own[0][0] == x and own[1][0] == y
                    if near and (ends_here or planar.any_touch(e[None], sides)):
                        assert tuple(e) in got[here[0]][1]
                level = here[0][0] if here else 0
                ref = [((v >> level) + r) * cell * 2 ** level for v, r in zip((x, y), planar._REF)]
                assert planar.inside(*ref, edges) == (bool(here) and got[here[0]][0])


def test_tiles_follow_the_border_not_the_area():
    side = 500_000.0
    corners = [(0, 0), (side, 0), (side, side), (0, side), (0, 0)]
    for pts in (corners, [corners[0], corners[2], corners[3], corners[0]]):
        assert len(covered([(0, SHELL, np.array(pts))], 1000.0)) < 8000
    turn = np.linspace(0, 2 * np.pi, 200_001)
    circle = np.column_stack([np.cos(turn), np.sin(turn)]) * side / 2
    circle[-1] = circle[0]
    assert len(covered([(0, SHELL, circle)], 1000.0)) < 8000


def test_objects_of_all_sizes_meet_wide_tiles(spark):
    """A region of 300 cells a side: points, boxes from below a cell to wider than the region."""
    rng = np.random.default_rng(6)
    region = polygon([(0, 0), (300, 20), (280, 300), (150, 160), (10, 290), (0, 0)],
                     [(100, 60), (100, 110), (160, 110), (160, 60), (100, 60)])
    objects = []
    for size in (0, 0.3, 1, 4, 20, 90, 400):
        for _ in range(25):
            x, y = rng.uniform(-60, 340, 2).round(1)
            objects.append(point(x, y) if size == 0 else box(x, y, x + size, y + size))
    got = {r.id for r in spatial.region_hits(shapes(spark, objects), ["id"], shapes(spark, [region, box(900, 900, 901, 901)])
                                             .withColumnRenamed("id", "region"), ["region"], 1.0).collect()}
    assert got == {i for i, o in enumerate(objects) if brute_force(o, region)}


def test_regions_of_an_empty_layer(spark):
    layer = shapes(spark, [point(1, 1)]).withColumnRenamed("id", "region")
    for rows in (layer, layer.limit(0)):
        assert spatial.region_hits(shapes(spark, [box(0, 0, 3, 3)]), ["id"], rows, ["region"], 1.0).isEmpty()


def test_wide_objects_and_copied_regions(spark):
    wide = line((-1e6, 0.5), (1e6, 0.5))  # two million cells of side 1
    layer = shapes(spark, [box(0, 0, 3, 1), box(0, 0, 3, 1), box(0, 2, 3, 3)]).withColumn(
        "region", F.lit("r")).drop("id")
    hits = spatial.region_hits(shapes(spark, [wide]), ["id"], layer, ["region"], 1.0)
    assert hits.count() == 2  # a copied feature counts twice, the third is not met


def test_pair_join_equals_brute_force(spark):
    bufs = list(dict.fromkeys(random_shapes(4, 150)))
    df = spark.createDataFrame([(["a"], 1, b, 3006, f"{i:03d}") for i, b in enumerate(bufs)],
                               "databases array<string>, db_occurrence int, the_geom binary, "
                               "srid int, pk string")
    got = {r.pk: set(r.intersect_pk) for r in spatial.geometry_intersects(df).collect()}
    want = {}
    for i, a in enumerate(bufs):
        met = {f"{j:03d}" for j, b in enumerate(bufs) if i != j and brute_force(a, b)}
        if met:
            want[f"{i:03d}"] = met
    assert got == want


def test_equal_points_in_three_byte_forms(spark):
    forms = [point(1, 2), struct.pack(">BIdd", 0, 1, 1, 2), struct.pack("<BIIdd", 1, 1 | 0x20000000, 3006, 1, 2)]
    other = [struct.pack("<BIddd", 1, 1001, 1, 2, 5), collected(4, point(1, 2)), point(3, 3)]
    df = spark.createDataFrame([("a", i, b, 3006) for i, b in enumerate(forms + other)],
                               "archive string, ObjectId bigint, wkb binary, srid int")
    t = {"geo_object": df}
    assert sorted(r.occurrence for r in spatial.same_geometry(t).collect()) == [1, 1, 1, 3]
    groups = spatial.same_geometry_all(t)
    met = spatial.geometry_intersects(groups).collect()
    assert groups.count() == 4 and sorted(len(r.intersect_pk) for r in met) == [2, 2, 2]


def test_objects_in_region_counts_a_border_twice(tables):
    got = {(r.archive, r.lan): r for r in spatial.objects_in_region(tables, 7.0).collect()}
    # the box touches both parishes of the county; ids repeat as the counts do
    assert got["a1", "county"].object_ids.count(100) == 2
    assert got["a1", None].object_ids == [104, 105]
    assert got["a1", "county"].count_rank == 1 and got["a1", None].count_rank == 2
    assert got["a2", "county"].objects_in_lan == 2


def test_same_geometry(tables):
    got = [(r.archive, r.object_ids, r.occurrence) for r in spatial.same_geometry(tables).collect()
           if r.wkb == bytearray(box(0, 0, 5, 5))]
    assert sorted(got) == [("a1", [100], 1), ("a2", [100], 1)]
    both = [r.databases for r in spatial.same_geometry_all(tables).collect()
            if r.the_geom == bytearray(box(0, 0, 5, 5))]
    assert both == [["a1", "a2"]]


def test_fixes_apply_by_archive_and_last_wins(spark, tables):
    one = spark.createDataFrame([("a1", "101,102", point(7, 7))],
                                "archive string, object_ids string, wkb binary")
    two = spark.createDataFrame([("a1", "102", point(8, 8))],
                                "archive string, object_ids string, wkb binary")
    got = {(r.archive, r.ObjectId): r.wkb for r in
           spatial.apply_geometry_fixes(tables, one, two).collect()}
    assert got["a1", 101] == bytearray(point(7, 7)) and got["a1", 102] == bytearray(point(8, 8))
    assert got["a2", 100] == bytearray(box(0, 0, 5, 5))


def distance_sum(points, x, y):
    return sum(math.hypot(px - x, py - y) for px, py in points)


def test_median_is_least(spark):
    rng = random.Random(5)
    groups = {
        "cloud": [(rng.gauss(500000, 50), rng.gauss(6500000, 9)) for _ in range(60)],
        "single": [(3.0, 4.0)], "pair": [(0.0, 0.0), (2.0, 0.0)],
        "corner": [(0.0, 0.0), (1.0, 0.0), (0.0, 1.0), (-5.0, -5.0), (0.1, 0.1)],
        "row": [(float(i), 2.0 * i) for i in (0, 1, 2, 10, 50)],
        "at_point": [(0.0, 0.0), (1.0, 0.0), (-1.0, 0.0), (0.0, 1.0), (0.0, -1.0)]}
    rows = [(k, x, y) for k, pts in groups.items() for x, y in pts]
    df = cut_lineage(spark.createDataFrame(rows, "g string, x double, y double"))
    for r in geometric_median(df, "g").collect():
        here = distance_sum(groups[r.g], r.x, r.y)
        for step in (1e-2, 1e-3):
            for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1)):
                assert here <= distance_sum(groups[r.g], r.x + dx * step, r.y + dy * step) + 1e-7
    assert {r.g: (round(r.x, 4), round(r.y, 4)) for r in geometric_median(df, "g").collect()
            if r.g in ("single", "row", "at_point")} == {
        "single": (3, 4), "row": (2, 4), "at_point": (0, 0)}


def test_median_in_ten_rounds(spark):
    """Clouds, lines, stacks around a point and outliers: the plain search over all points goes no
    further than the tolerance from there, and no group needs more than ten rounds."""
    rng = np.random.default_rng(11)
    around = 2 * np.pi * rng.random(3000)
    groups = {
        "cloud": rng.normal((500000, 6500000), (900, 30), (20000, 2)),
        "two": np.concatenate([rng.normal((0, 0), 1, (5000, 2)), rng.normal((1e6, 1e6), 1, (5000, 2))]),
        "uneven": np.concatenate([rng.normal((0, 0), 1, (5001, 2)), rng.normal((1e6, 1e6), 1, (4000, 2))]),
        "line": np.stack([np.arange(4001.0) ** 2, 3 * np.arange(4001.0) ** 2], 1),
        "star": np.concatenate([[[7.0, 7.0]], 7 + 1e4 * rng.random((3000, 1)) ** 6 * np.stack([np.cos(around), np.sin(around)], 1)]),
        "outlier": np.concatenate([rng.random((500, 2)), [[1e9, -1e9]]]),
        "tiny": 500000 + 1e-7 * rng.random((300, 2)),
        "square": np.array([[0.0, 0], [1, 0], [1, 1], [0, 1]]), "two points": np.array([[0.0, 0], [4, 0]])}
    df = cut_lineage(spark.createDataFrame(
        [(k, *map(float, p)) for k, pts in groups.items() for p in pts] + [("cloud", float("nan"), 0.0), ("none", None, 1.0)],
        "g string, x double, y double"))
    rows = geometric_median(df, "g", rounds=10).collect()
    assert {r.g for r in rows} == set(groups) and [r.g for r in rows if not r.converged] == []
    for r in rows:
        pts = groups[r.g] - (r.x, r.y)
        a, b = least_sum(np.ones(len(pts)), pts[:, 0], pts[:, 1], (0.0, 0.0))
        here, there = np.hypot(*pts.T).sum(), np.hypot(*(pts - (a, b)).T).sum()
        # the point is the least one to the tolerance; where many are least, the sum is
        assert math.hypot(a, b) < 2e-5 or (
            r.g in ("two", "two points") and here <= there * (1 + 1e-12)), (r.g, a, b, here - there)


def moved(spark, x, y, source, target):
    pts = F.array(F.struct(F.lit(x).alias("x"), F.lit(y).alias("y"),
                           F.lit(None).cast("double").alias("z")))
    p = spark.range(1).select(
        P.transform_points(pts, P.fixed(source), P.fixed(target))[0].alias("p")).first().p
    return p.x, p.y


@pytest.mark.parametrize("srid", sorted(P.SYSTEMS))
def test_there_and_back(spark, srid):
    x, y = moved(spark, 540000.0, 6570000.0, 3006, srid)
    back = moved(spark, x, y, srid, 3006)
    assert math.dist(back, (540000.0, 6570000.0)) < 1e-3


def test_axis_and_scale(spark):
    # on the central meridian easting is the false easting; the pole distance is the meridian arc
    lon, lat = moved(spark, 500000.0, 6500000.0, 3006, 4619)
    assert lon == pytest.approx(15.0, abs=1e-12) and 58 < lat < 59
    x, y = moved(spark, 15.0, 90.0 - 1e-12, 4619, 3006)
    assert y == pytest.approx(0.9996 * 10001965.7293, abs=0.01)  # quarter meridian of GRS 80
    # 3009 has the same meridian, full scale and another false easting
    assert moved(spark, 500000.0, 6500000.0, 3006, 3009) == pytest.approx(
        (150000.0, 6500000.0 / 0.9996), abs=1e-4)


def test_rt90_shift_is_plausible(spark):
    # RT 90 and SWEREF 99 differ by some 200 m in latitude and longitude
    lon, lat = moved(spark, 15.8, 59.0, 4124, 4619)
    north, east = (lat - 59.0) * 111000, (lon - 15.8) * 57400
    assert 30 < math.hypot(north, east) < 400


def test_reproject_uses_each_archives_system(spark, tables):
    srids = spark.createDataFrame([("a1", 3006), ("a2", 3009)], "archive string, likely_srid int")
    table = tables["geo_object"].where("ObjectId = 100").withColumn(
        "wkb", F.lit(box(150000, 6500000, 150005, 6500005)))
    got = {r.archive: wkb.read_rings(bytes(r.wkb))[1][0][2][0].tolist()
           for r in reproject.reproject({"geo_object": table}, srids).collect()}
    assert got["a1"] == [150000, 6500000]
    assert got["a2"] == pytest.approx([500000, 6500000 * 0.9996], abs=1e-3)


def test_unknown_srid_is_an_error(spark, tables):
    srids = spark.createDataFrame([("a1", 1), ("a2", 3006)], "archive string, likely_srid int")
    with pytest.raises(Exception, match="unknown SRID 1"):
        reproject.reproject(tables, srids).collect()


def test_cascade_takes_the_first_match(spark, tables):
    zone = spark.createDataFrame([("sea", box(490000, 6490000, 510000, 6510000), 3006)],
                                 "eez_name string, wkb binary, srid int")
    # archive a1 holds points that only fit the zone when read as system 3007 or 3010
    lon, lat = moved(spark, 500000.0, 6500000.0, 3006, 4619)
    x, y = moved(spark, lon, lat, 4619, 3007)
    geo = spark.createDataFrame([("a1", 1, 38, 1, point(x, y), 3006), ("a2", 1, 38, 1,
                                 point(500000, 6500000), 3006)],
                                tables["geo_object"].schema)
    got = {r.archive: r.likely_srid for r in reproject.likely_srid_cascade(
        {**tables, "zone": zone, "geo_object": geo}, cell=5000.0).collect()}
    assert got == {"a1": 3007, "a2": 3006, "a3": 3006}


def test_spatial_plans_have_no_cross_join(tables):
    groups = spatial.same_geometry_all(tables)
    for df in (spatial.region_hits(tables["geo_object"], ["archive", "ObjectId"],
                                   tables["region"], ["namn"], 5.0),
               spatial.geometry_intersects(groups)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_site_region_left_join(spark, tables):
    centres = spark.createDataFrame([("a1", 5.0, 0.0), ("a2", 50.0, 50.0)],
                                    "archive string, x double, y double")
    got = sorted((r.archive, r.namn) for r in site.site_region(
        centres, tables["region"], ["namn"], 3.0).collect())
    assert [g[0] for g in got] == ["a1", "a1", "a2"] and got[2][1] is None


def test_force_2d_query_covers_all_rows_and_shapes(spark):
    from __spark_entry__ import queries
    folder = "/root/testdata/sf0.001"
    got = {(r.archive, r.ObjectId): r.wkt for r in queries()["force_2d_raised_shapes"](spark, folder).collect()}
    rows = queries()["force_2d"](spark, folder).collect()
    assert set(got) == {(r.archive, r.ObjectId) for r in rows} and len(got) == len(rows)
    assert len({i % 9 for _, i in got}) == 9 and len(set(got.values())) == 9
    assert all("Z" not in w.replace("POLYGON", "") for w in got.values())


def test_large_outlines_meet_by_their_segments(spark):
    """Outlines of 100,000 corners: crossing, one in the other, apart; and points in and beside them."""
    rand = random.Random(2)
    n = 100_000
    outline = lambda x, r: wkb.write_rings(3, [(0, wkb.SHELL, circle(x, 0, r, n))])
    ringed = wkb.write_rings(3, [(0, wkb.SHELL, circle(0, 0, 50, n)), (0, wkb.HOLE, circle(0, 0, 30, n))])
    bufs = [outline(0, 100), outline(155, 100), ringed, outline(0, 20), outline(1000, 10)]
    spots = [(rand.uniform(-120, 260), rand.uniform(-110, 110)) for _ in range(300)]
    bufs += [point(*p) for p in spots]
    pairs = {(r.a, r.b) for r in spatial.meeting_pairs(shapes(spark, bufs).select(
        F.col("id").cast("bigint").alias("key"), "wkb")).collect()}
    want = {(0, 1), (0, 2), (0, 3)}
    for i, (x, y) in enumerate(spots, 5):
        far, beside = math.hypot(x, y), math.hypot(x - 155, y)
        want |= {(k, i) for k, inside in ((0, far < 100), (1, beside < 100), (2, 30 < far < 50), (3, far < 20)) if inside}
    assert pairs == want


def test_no_geometry_bytes_in_pair_rows(spark):
    df = shapes(spark, [box(0, 0, 1, 1), point(0, 0)]).select(F.col("id").cast("bigint").alias("key"), "wkb")
    assert "wkb" not in spatial.meeting_pairs(df)._jdf.queryExecution().optimizedPlan().toString()


def test_tidy_shape_is_the_shape_of_the_tidy_bytes(spark):
    arc = struct.pack("<BII6d", 1, 8, 3, 0, 0, 1, 1, 2, 0)
    high = wkb.write_rings(1, [(0, 0, np.array([[1.0, 2.0, 3.0]]))])
    empty = wkb.write_rings(3, [])
    for bufs in ([point(1, 2), None, box(0, 0, 2, 2), line((0, 0), (4, 0)), empty],
                 [OPEN_RING, point(1, 2), None, line((0, 0), (0, 0), (4, 0)), arc, high, empty, BOWTIE]):
        got = shapes(spark, bufs).repartition(1).select(
            "id", G.tidy_shape("wkb").alias("once"), G.decode_shape(G.tidy_wkb("wkb")).alias("twice")).collect()
        assert len(got) == len(bufs) and all(r.once == r.twice for r in got)


def python_steps(df):
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_geometries_are_read_by_one_python_step_at_a_time(tables):
    table = tables["geo_object"]
    for df in (spatial.with_bbox(table, "ObjectId"), site.centroid_points(tables), *spatial.error_rows(tables)):
        assert python_steps(df) == 1
    objects = table.select("archive", F.col("ObjectId").alias("object_id"), "wkb")
    hits = spatial.region_hits(objects, ["archive", "object_id"], tables["region"], ["namn", "lan"], 50.0)
    assert python_steps(hits) == 1  # measuring is behind it, and so are the tiles


def test_unreadable_geometries_may_stay_in_the_shapes(spark, tables):
    table = tables["geo_object"]
    junk = table.limit(1).withColumn("ObjectId", F.lit(987654).cast(table.schema["ObjectId"].dataType)).withColumn(
        "wkb", F.lit(b"junk"))
    mixed = table.unionByName(junk)
    good, _ = spatial.error_rows({"geo_object": mixed})
    got = spatial.objects_in_region({**tables, "geo_object": good}, 50.0, shapes=mixed)
    want = spatial.objects_in_region(tables, 50.0)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
