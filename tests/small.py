"""Two small archives with the same ids, so a join key without ``archive`` shows."""

import struct

from trowel.schema import CORE_TABLES


def point(x, y):
    return struct.pack("<BIdd", 1, 1, x, y)


def line(*pts):
    return struct.pack("<BII", 1, 2, len(pts)) + b"".join(struct.pack("<dd", *p) for p in pts)


def polygon(*rings):
    out = struct.pack("<BII", 1, 3, len(rings))
    for ring in rings:
        out += struct.pack("<I", len(ring)) + b"".join(struct.pack("<dd", *p) for p in ring)
    return out


def box(x0, y0, x1, y1):
    return polygon([(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)])


BOWTIE = polygon([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)])
OPEN_RING = polygon([(0, 0), (2, 0), (2, 2), (0, 2)])

DATA = {
    "object": [
        ("a1", 1, 1, None, 1, "Site one", None, None), ("a2", 1, 1, None, 1, "Site two", None, None),
        ("a2", 2, 1, None, 2, "Site two b", None, None),
        ("a1", 10, 11, 183, 10, "pit", 1, None), ("a2", 10, 11, 183, 10, "hearth", 1, None),
        ("a1", 11, 11, 183, 11, None, 1, None), ("a1", 20, 9, 52, 20, "group g", 1, None),
        ("a1", 21, 9, 52, 21, "group h", 1, None), ("a3", 10, 11, 999, 10, "lone", None, None),
        ("a1", 12, 3, 183, 12, "no attributes", 1, None)],
    "geo_object": [
        ("a1", 100, 80, 1, box(0, 0, 5, 5), 3006), ("a2", 100, 80, 1, box(0, 0, 5, 5), 3006),
        ("a1", 101, 38, 1, point(10, 10), 3006), ("a1", 102, 80, 1, BOWTIE, 3006),
        ("a1", 103, 80, 1, OPEN_RING, 3006), ("a1", 104, 38, 1, None, 3006),
        ("a1", 105, 77, 1, point(1000, 1000), 3006)],
    "geo_rel": [("a1", 10, 101), ("a1", 10, 100), ("a2", 10, 100), ("a1", 11, 104),
                ("a1", 12, 555), ("a3", 10, 7)],
    "attribute": [
        ("a1", 1000, 122, 10, "Typ"), ("a2", 1000, 122, 10, "Typ"), ("a1", 1001, 900, 10, "Note"),
        ("a1", 1002, 900, 10, "Note"), ("a1", 1003, 900, 20, "Note"), ("a1", 1004, 69, 1, "Slutdatum"),
        ("a2", 1004, 69, 1, "Project name"), ("a2", 1005, 69, 2, "Projektnamn"),
        ("a1", 1006, 5, 10, "Loose")],
    "attribute_value": [
        ("a1", 1, 1000, None, None), ("a1", 2, 1000, "", None), ("a1", 3, 1000, "Stolphål", ""),
        ("a1", 4, 1000, "Stolphål", "cm"), ("a1", 5, 1000, "", "cm"), ("a1", 6, 1000, None, "cm"),
        ("a2", 1, 1000, "grop", "m"), ("a1", 7, 1004, "2001-02-03", None),
        ("a2", 8, 1004, "P2", None), ("a2", 9, 1005, "P2b", None), ("a1", 10, 1006, "x", "y")],
    "attribute_def": [(a, m, "l", False, True, False, "text", None, 250)
                      for a in ("a1", "a2") for m in (122, 900, 69)],
    "free_text": [("a1", 1001, r"{\rtf1 \fs17 first note\par }"),
                  ("a1", 1002, r"{\rtf1 \fs17 second note\par }"),
                  ("a1", 1003, r"{\rtf1 \fs17 group note\par }")],
    "binary_value": [("a1", 1, b"abc", None, "image/jpeg"), ("a1", 2, None, None, "image/jpeg")],
    "definition": [(a, m, None, n, "", None, "", None, True) for a in ("a1", "a2", "a3")
                   for m, n in ((11, "Object"), (9, "Area"), (183, "Pit"), (52, "Group"),
                                (122, "Type"), (1, "Project"), (77, "c"), (500, "in"))],
    "alternative_def": [("a1", 122, 1, "alt a"), ("a1", 122, 1, "alt b")],
    "geo_object_def": [(a, m, "c", t, True) for a in ("a1", "a2")
                       for m, t in ((38, "Point"), (80, "Polygon"))],
    "object_def": [("a1", 77, "code", 10, 0, True, True)],
    "sub_class_def": [("a1", 183, 11)],
    "relation_def": [("a1", 500, "contains", "in", False, None),
                     ("a1", 501, "Skapar", "made by", False, None)],
    "object_rel": [("a1", 20, 10, 500), ("a1", 21, 10, 500), ("a1", 1, 10, 501),
                   ("a1", 1, 11, 500), ("a2", 1, 10, 500)],
    "event": [],
    "region": [("north", "county", box(-1, -1, 5, 20), 3006), ("south", "county", box(5, -1, 20, 20), 3006)],
    "zone": [("sea", box(-100, -100, 100, 100), 3006)],
    "manifest": [],
}


def small_tables(spark):
    return {name: spark.createDataFrame(rows, CORE_TABLES[name]) for name, rows in DATA.items()}
