"""The core tables as plain expressions over the generic test tables.

An archive is a nation.  Project objects come from nations, trenches from
customers, surveyed objects from orders, notes from documents, files from
pages.  Ids interleave the kinds (``10 + 5 * key + kind``), so they do not
collide at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trowel.functions.geometry import box_wkb, point_wkb
from trowel.session import attached

# Definitions, repeated in every archive.
DEFINITIONS = [
    (1, "Projekt"), (2, "Fornlamning"), (3, "Dokument"), (9, "Schakt"), (11, "Objekt"),
    (38, "Punkt"), (52, "Grupp"), (62, "Slutdatum"), (63, "Plats"), (69, "Projekt id"),
    (80, "Yta"), (119, "Segment"), (122, "Typ"), (131, "Balance"), (183, "Yta i schakt"),
    (489, "SRID"), (900, "Beskrivning"), (1600, "Omfattning"), (1601, "Innehall"),
    (1602, "Skarning"), (1603, "Skapande"), (10001, "Prio 1"), (10002, "Prio 2"),
    (10003, "Prio 3"), (10004, "Prio 4"),
]
ATTRIBUTE_DEFS = [
    (62, "Slutdatum"), (63, "Plats"), (69, "Project name"), (119, "Segment"), (122, "Typ"),
    (131, "Balance"), (489, "SRID"), (900, "Beskrivning"),
]
RELATION_DEFS = [
    (1600, "Omfattar", "Ingar i"), (1601, "Innehaller", "Tillhor"),
    (1602, "Skar", "Skars av"), (1603, "Skapar", "Skapad av"),
]
GEO_DEFS = [(38, "Point"), (39, "Point"), (76, "Polyline"), (80, "Polygon")]
OBJECT_DEFS = [(1, 1015), (2, 1020), (3, 1025), (9, 1030), (11, 1035), (52, 1020), (183, 1050)]
ALTERNATIVE_DEFS = [(122, 10042, "Typ alt")]
SUB_CLASSES = [(52, 9), (183, 9), (10001, 11), (10002, 11), (10003, 11), (10004, 11)]


def _id(key, kind: int):
    return (F.lit(10) + F.col(key) * 5 + kind).cast("bigint")


def _none(kind: str):
    return F.lit(None).cast(kind)


def _archive(key):
    return F.concat(F.lit("nation_"), F.col(key).cast("string")).alias("archive")


class TestTables(dict):
    """Core tables by name, planned when first asked for."""

    __test__ = False

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.folder = spark, folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def __missing__(self, name: str) -> DataFrame:
        self[name] = BUILDERS[name](self)
        return self[name]


# -- the generic tables with their archive -------------------------------------
def _nations(t):
    return t.raw("nation").select(_archive("n_nationkey"), F.col("n_nationkey").alias("k"),
                                  "n_name", "n_regionkey")


def _customers(t):
    return t.raw("customer").select(_archive("c_nationkey"), F.col("c_custkey").alias("k"),
                                    "c_name", "c_acctbal", "c_mktsegment")


def _orders(t):
    home = t["_customers"].select("archive", F.col("k").alias("o_custkey"))
    return t.raw("orders").join(home, "o_custkey").select(
        "archive", F.col("o_orderkey").alias("k"), "o_custkey", "o_orderstatus",
        "o_orderpriority")


def _documents(t):
    home = t["_orders"].select("archive", F.col("k").alias("doc_id"), "o_custkey")
    return attached(t.raw("documents").select("doc_id", "text"), home, ["doc_id"])


def _pages(t):
    home = t["_orders"].select("archive", F.col("k").alias("page_id"))
    return t.raw("pages").select("page_id", "html").join(home, "page_id")


def _dictionary(t, rows, names):
    """A fixed list repeated for every archive."""
    entries = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)])
                        for row in rows])
    return t["_nations"].select("archive", F.inline(entries))


# -- core tables ----------------------------------------------------------------
def _object(t):
    nations = t["_nations"].select(
        "archive", F.lit(1).cast("bigint").alias("ObjectId"), F.lit(1).alias("ClassId"),
        _none("int").alias("SubClassId"), F.lit(1).cast("bigint").alias("PublicId"),
        F.col("n_name").alias("Name"), _none("bigint").alias("SiteId"),
        _none("int").alias("Origin"))
    customers = t["_customers"].select(
        "archive", _id("k", 0), F.lit(9),
        F.when(F.col("c_mktsegment") == "BUILDING", 52).otherwise(183),
        _id("k", 0) + 1000, "c_name", F.lit(1).cast("bigint"), _none("int"))
    orders = t["_orders"].select(
        "archive", _id("k", 1),
        F.when(F.col("o_orderstatus") == "F", 11).when(F.col("o_orderstatus") == "O", 2)
        .otherwise(3),
        F.lit(10000) + F.substring("o_orderpriority", 1, 1).cast("int"),
        _id("k", 1) + 1000,
        F.when(F.col("k") % 13 != 0, F.concat(F.lit("A"), F.col("k").cast("string"))),
        F.lit(1).cast("bigint"), _none("int"))
    return nations.union(customers).union(orders)


def _geo_rel(t):
    def link(df, object_kind, geo_kind):
        return df.select("archive", _id("k", object_kind).alias("ObjectId"),
                         _id("k", geo_kind).alias("GeoObjectId"))

    k = F.col("k")
    return (link(t["_customers"].where(k % 10 != 0), 0, 2)
            .union(link(t["_orders"].where(k % 3 == 0), 1, 3))
            .union(link(t["_orders"].where(k % 30 == 0), 1, 4)))


def _geo_object(t):
    k = F.col("k")
    x = (F.lit(500000) + (k % 97) * 10).cast("double")
    y = (F.lit(6500000) + (k % 89) * 10).cast("double")
    shown = k % 50 != 1

    def boxes(kind):
        # every 39th order has a link but no geometry row
        rows = t["_orders"].where((k % 39 != 0) & (k % (3 if kind == 3 else 30) == 0))
        x0, y0 = F.when(shown, x), F.when(shown, y)
        return rows.select("archive", _id("k", kind), F.lit(80), (k % 4).cast("int"),
                           box_wkb(x0, y0, x0 + 5, y0 + 5), F.lit(3006))

    points = t["_customers"].where(k % 10 != 0).select(
        "archive", _id("k", 2).alias("ObjectId"), F.lit(38).alias("MetaId"),
        (k % 4).cast("int").alias("SymbolId"),
        point_wkb(F.when(shown, x), F.when(shown, y)).alias("wkb"), F.lit(3006).alias("srid"))
    return points.union(boxes(3)).union(boxes(4))


NATION_ATTRIBUTES = [  # AttributeId, MetaId, Label; the sixth only where key % 5 = 0
    (1, 69, "Project name"), (2, 62, "Slutdatum"), (3, 63, "Plats"), (4, 64, "Projektkod"),
    (5, 489, "SRID"), (6, 69, "Site Id"),
]


def _nation_attributes(t):
    regions = t.raw("region").select(F.col("r_regionkey").alias("n_regionkey"), "r_name")
    values = {1: F.col("n_name"), 2: F.lit("2020-01-01"), 3: F.col("r_name"), 4: F.lit(""),
              5: F.lit("3006"), 6: F.concat(F.lit("S"), F.col("k").cast("string"))}
    entries = F.array(*[
        F.struct(F.lit(a).cast("bigint").alias("AttributeId"), F.lit(m).alias("MetaId"),
                 F.lit(label).alias("Label"), values[a].alias("Value"))
        for a, m, label in NATION_ATTRIBUTES])
    return (t["_nations"].join(regions, "n_regionkey")
            .select("archive", "k", F.inline(entries))
            .where((F.col("AttributeId") != 6) | (F.col("k") % 5 == 0)))


def _attribute(t):
    def rows(df, kind, meta, label, owner):
        return df.select("archive", _id("k", kind).alias("AttributeId"),
                         F.lit(meta).alias("MetaId"), owner.alias("ObjectId"),
                         F.lit(label).alias("Label"))

    nations = t["_nation_attributes"].select(
        "archive", "AttributeId", "MetaId", F.lit(1).cast("bigint").alias("ObjectId"), "Label")
    customers, orders = t["_customers"], t["_orders"]
    docs = t["_documents"].withColumnRenamed("doc_id", "k")
    pages = t["_pages"].withColumnRenamed("page_id", "k")
    # every fourth note belongs to the order's trench
    owner = F.when(F.col("k") % 4 == 1, _id("o_custkey", 0)).otherwise(_id("k", 1))
    return (nations.union(rows(customers, 0, 119, "Segment", _id("k", 0)))
            .union(rows(customers, 1, 131, "Balance", _id("k", 0)))
            .union(rows(orders, 2, 122, "Typ", _id("k", 1)))
            .union(rows(docs, 3, 900, "Beskrivning", owner))
            .union(rows(pages, 4, 901, "Bild", _id("k", 1))))


def _attribute_value(t):
    def rows(df, attribute, second, value, unit):
        return df.select("archive", (attribute * 2 + second).alias("AttributeValueId"),
                         attribute.alias("AttributeId"), value.alias("Value"),
                         unit.alias("Unit"))

    k = F.col("k")
    none = _none("string")
    parts = t.raw("part")
    count = parts.agg(F.count(F.lit(1)).alias("parts"))
    named = (t["_orders"].crossJoin(count)  # one row
             .withColumn("p_partkey", k % F.col("parts"))
             .join(parts.select("p_partkey", "p_name"), "p_partkey"))
    typ = F.when(k % 7 == 0, "").when(k % 11 == 0, none).otherwise(F.col("p_name"))
    unit = F.when(k % 3 == 1, "").when(k % 3 == 2, "cm")
    cents = F.round(F.col("c_acctbal") * 100, 0).cast("bigint").cast("string")
    nations = rows(t["_nation_attributes"], F.col("AttributeId"), 0, F.col("Value"), none)
    customers = t["_customers"]
    return (nations.union(rows(customers, _id("k", 0), 0, F.col("c_mktsegment"), none))
            .union(rows(customers, _id("k", 1), 0, cents, F.lit("kr")))
            .union(rows(named, _id("k", 2), 0, typ, unit))
            .union(rows(named.where(k % 5 == 0), _id("k", 2), 1,
                        F.concat(F.lit("extra "), F.col("p_name")), none)))


def _free_text(t):
    text = F.col("text")
    for letter, code in (("ä", r"\'e4"), ("ö", r"\'f6"), ("å", r"\'e5")):
        text = F.replace(text, F.lit(letter), F.lit(code))
    start = F.when(F.col("doc_id") % 9 == 0, r"{\rtf1 ").otherwise(r"{\rtf1 \fs17 ")
    end = F.when(F.col("doc_id") % 5 == 2, r"\b0 x\f0\ul\par }").otherwise(r"\par }")
    return t["_documents"].select("archive", _id("doc_id", 3).alias("AttributeId"),
                                  F.concat(start, text, end).alias("Text"))


def _binary_value(t):
    return t["_pages"].select(
        "archive", _id("page_id", 4).alias("AttributeId"),
        F.when(F.col("page_id") % 8 != 0, F.encode("html", "UTF-8")).alias("Value"),
        _none("string").alias("Reference"), F.lit("text/html").alias("MimeType"))


def _object_rel(t):
    status = F.col("o_orderstatus")
    top = t["_customers"].select("archive", F.lit(1).cast("bigint").alias("ParentId"),
                                 _id("k", 0).alias("ChildId"), F.lit(1600).alias("MetaId"))
    return top.union(t["_orders"].select(
        "archive", _id("o_custkey", 0), _id("k", 1),
        F.when(status == "F", 1601).when(status == "O", 1602).otherwise(1603)))


def _event(t):
    users = t["_customers"].select("archive", F.col("k").alias("user_id"))
    kind = F.col("event_type")
    text = (F.when(kind == "purchase", F.concat(F.lit("Import from Measurement File "),
                                                F.col("event_id").cast("string")))
            .when(kind != "view", kind))
    return t.raw("events").join(users, "user_id").select(
        "archive", F.col("event_id").alias("EventId"), _id("user_id", 0).alias("ObjectId"),
        F.col("ts").cast("timestamp_ntz").alias("Time"), text.alias("Description"))


def _definition(t):
    meta = F.col("MetaId")
    return _dictionary(t, DEFINITIONS, ("MetaId", "Name")).select(
        "archive", "MetaId", F.when(meta % 4 == 0, 1).alias("VersionReferenceId"), "Name",
        F.when(meta % 2 == 0, "").otherwise(F.concat(F.lit("d"), meta.cast("string")))
        .alias("Description"),
        _none("string").alias("ToolTip"),
        F.when(meta % 3 == 0, "").when(meta % 3 == 1, F.lit("h")).alias("Help"),
        _none("int").alias("ExternalId"), F.lit(True).alias("IsSystemDefinition"))


def _attribute_def(t):
    return _dictionary(t, ATTRIBUTE_DEFS, ("MetaId", "Label")).select(
        "archive", "MetaId", "Label", F.lit(False).alias("MultipleAllowed"),
        F.lit(True).alias("FreeValueAllowed"), F.lit(False).alias("NotNull"),
        F.lit("text").alias("DataType"), _none("string").alias("Unit"),
        F.lit(250).cast("smallint").alias("Length"))


def _region(t):
    k = F.col("k")
    x0 = (F.lit(500000) + (k % 5) * 200).cast("double")
    y0 = (F.lit(6500000) + F.floor(k / 5) * 180).cast("double")
    wide = F.when(k == 7, 150.0).when(k == 12, 250.0).otherwise(200.0)
    name = k.cast("string")
    return t["_nations"].select(
        F.concat(F.lit("parish_"), name).alias("namn"),
        F.concat(F.lit("county_"), (k % 5).cast("string")).alias("lan"),
        box_wkb(x0, y0, x0 + wide, y0 + 180).alias("wkb"), F.lit(3006).alias("srid"))


def _zone(t):
    k = F.col("k")
    x0 = F.when(k == 0, 499000.0).otherwise(500400.0)
    x1 = F.when(k == 0, 500600.0).otherwise(502000.0)
    return t["_nations"].where(k < 2).select(
        F.concat(F.lit("zone_"), k.cast("string")).alias("eez_name"),
        box_wkb(x0, F.lit(6499000.0), x1, F.lit(6502000.0)).alias("wkb"),
        F.lit(3006).alias("srid"))


def _manifest(t):
    """Bookkeeping rows as earlier runs would have left them."""
    k = F.col("k")
    entries = [
        ("validity", _none("int"), F.when(k % 3 != 0, "done").otherwise("failed"), 1),
        ("layers", (k % 4 + 8).cast("int"), F.lit("done"), 1),
        ("layers", (k % 4 + 9).cast("int"),
         F.when(k % 7 == 0, "failed").otherwise("done"), 2),
        ("features", _none("int"), F.when(k % 2 == 0, "done"), 1),
    ]
    rows = F.array(*[
        F.struct(F.lit(step).alias("step"), version.alias("version"), status.alias("status"),
                 F.lit(day).alias("day"))
        for step, version, status, day in entries])
    return t["_nations"].select("archive", F.inline(rows)).select(
        "archive", "step", "version", "status", _none("string").alias("message"),
        F.timestamp_add("DAY", "day", F.lit("2024-01-01").cast("timestamp"))
        .alias("updated_at"))


BUILDERS = {
    "_nations": _nations, "_customers": _customers, "_orders": _orders,
    "_documents": _documents, "_pages": _pages, "_nation_attributes": _nation_attributes,
    "object": _object, "geo_rel": _geo_rel, "geo_object": _geo_object,
    "attribute": _attribute, "attribute_value": _attribute_value, "free_text": _free_text,
    "binary_value": _binary_value, "object_rel": _object_rel, "event": _event,
    "definition": _definition, "attribute_def": _attribute_def, "region": _region,
    "zone": _zone, "manifest": _manifest,
    "alternative_def": lambda t: _dictionary(
        t, ALTERNATIVE_DEFS, ("MetaId", "AttributeDefId", "Value")),
    "geo_object_def": lambda t: _dictionary(t, GEO_DEFS, ("MetaId", "Type")).select(
        "archive", "MetaId", F.lit("c").alias("Code"), "Type", F.lit(True).alias("IsVisible")),
    "object_def": lambda t: _dictionary(t, OBJECT_DEFS, ("MetaId", "PublicId")).select(
        "archive", "MetaId", F.concat(F.lit("o"), F.col("MetaId").cast("string")).alias("Code"),
        F.col("PublicId").cast("bigint").alias("PublicId"), F.lit(0).alias("Color"),
        F.lit(True).alias("CanAddAttribute"), F.lit(True).alias("IsVisible")),
    "sub_class_def": lambda t: _dictionary(t, SUB_CLASSES, ("MetaId", "ClassId")),
    "relation_def": lambda t: _dictionary(
        t, RELATION_DEFS, ("MetaId", "ParentText", "ChildText")).select(
        "archive", "MetaId", "ParentText", "ChildText", F.lit(False).alias("Equal"),
        _none("int").alias("RelationTypeDefId")),
}
