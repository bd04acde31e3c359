"""Every operator as a query over the test tables.

Lists leave as joined texts and geometries as well-known text, so the results can be
compared with the SQL of `catalog.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog.oracle import ARCHIVE_TABLES, LAYER_COLUMNS
from trowel.functions import geometry as G
from trowel.functions import text as X
from trowel.functions.wkb import HOLE, POINT, SHELL, write_rings
from trowel.operators import counts, eav, relations, reproject, site, spatial
from trowel.plans import features, layers, runs
from trowel.session import cut_lineage, scratch_path
from trowel.schema import CORE_TABLES
from trowel.sinks import writers
from trowel.sources import archives, pending
from trowel.sources.archives import stored_tables
from trowel.sources.testdata import TestTables
from trowel.streaming.incremental import run_incremental

A = "archive"
SIMPLE_PATTERN = "(?i)bolt|ring"  # the SQL engine has no look-around
CELL = 50.0  # the test regions are about 200 m wide

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str, stored: bool = True):
    """Register ``fn(tables)``; ``stored`` reads the archive store, else plain views."""

    def add(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tables = stored_tables(spark, folder) if stored else TestTables(spark, folder)
            return fn(tables)

        QUERIES[name] = run
        return fn

    return add


def flat(df: DataFrame) -> DataFrame:
    return writers.joined_lists(df)


def as_wkt(df: DataFrame, column: str = "wkb", name: str = "wkt") -> DataFrame:
    shaped = df.withColumn("_shape", G.decode_shape(column))
    return shaped.withColumn(name, G.wkt(F.col("_shape"))).drop(
        "_shape", *([column] if column != name else []))


def ascii_fields(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("undersöknings_id", "undersoknings_id")


# -- sources -----------------------------------------------------------------------
@query("archive_list", stored=False)
def _(t):
    return site.archive_list(t)


@query("read_archives")
def _(t):
    for name in ARCHIVE_TABLES:
        t[name]  # make sure the store holds them
    tables = archives.read_archives(t.spark, t.root, ARCHIVE_TABLES)
    counted = [df.groupBy(A).agg(F.count(F.lit(1)).alias("n"))
               .select(A, F.lit(name).alias("name"), "n") for name, df in tables.items()]
    return reduce(DataFrame.union, counted)


@query("read_reference_layer")
def _(t):
    t["region"]
    layer = archives.read_reference_layer(t.spark, f"{t.root}/region", ["namn", "lan"])
    boxed = spatial.with_bbox(layer, "namn", "lan")
    corner = [F.col(a).cast("bigint").alias(b) for a, b in
              (("xmin", "x0"), ("ymin", "y0"), ("xmax", "x1"), ("ymax", "y1"))]
    return boxed.select("namn", "lan", *corner)


@query("pending_archives", stored=False)
def _(t):
    return pending.pending_archives(site.archive_names(t), t["manifest"], "layers", 10)


@query("pending_by_except", stored=False)
def _(t):
    done = pending.latest_status(t["manifest"]).where(
        (F.col("step") == "validity") & (F.col("status") == "done"))
    return pending.pending_by_except(site.archive_names(t), done)


@query("pending_by_output")
def _(t):
    path = scratch_path(t.spark, "output")
    writers.write_csv(site.multi_project_check(t), path)
    return pending.pending_by_output(site.archive_names(t),
                                     t.spark.read.option("header", True).csv(path))


@query("table_inventory", stored=False)
def _(t):
    return flat(site.held_tables(t, ARCHIVE_TABLES))


# -- sinks -----------------------------------------------------------------------------
@query("write_csv")
def _(t):
    path = scratch_path(t.spark, "csv")
    writers.write_csv(counts.find_count(t), path)
    return t.spark.read.option("header", True).option("nullValue", "").option(
        "emptyValue", '""').schema("find_type string, find_count bigint, archive string").csv(
        path).select(A, F.when(F.col("find_type") == '""', "").otherwise(F.col("find_type"))
                     .alias("find_type"), "find_count")


@query("write_json_table", stored=False)
def _(t):
    path = scratch_path(t.spark, "json")
    writers.write_json_table(site.blob_metrics(t), path)
    schema = t.spark.read.text(f"{path}/schema").first().value  # one line: the schema
    from pyspark.sql.types import StructType
    import json
    return t.spark.read.schema(StructType.fromJson(json.loads(schema))).json(
        f"{path}/data").select(A, "blob_count", "blob_bytes")


@query("write_layers")
def _(t):
    """All layers, written for half of the archives, then for the rest: a text for each row."""
    path = scratch_path(t.spark, "layers")
    tables = {name: t[name] for name in ("object", "definition", "alternative_def", "geo_object", "geo_object_def",
                                         "geo_rel", "object_rel", "relation_def", "attribute", "attribute_def",
                                         "attribute_value", "free_text", "event")}
    early = {name: df.where(F.crc32(A) % 2 == 0) if A in df.columns else df for name, df in tables.items()}
    for held in (early, tables, tables):
        layers.export_layers(held, f"{path}/out", f"{path}/manifest", 1)
    out = None
    for name, columns in LAYER_COLUMNS.items():
        rows = writers.read_layers(t.spark, f"{path}/out", name)
        rows = as_wkt(rows, "geom", "geom") if name == "features" else ascii_fields(rows)
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("∅")) for c in columns])
        rows = rows.select(F.lit(name).alias("layer"), A, text.alias("row"))
        out = rows if out is None else out.union(rows)
    return out


@query("create_features_table")
def _(t):
    path = scratch_path(t.spark, "features")
    name = "features_" + path.rsplit("-", 1)[1]
    rows = features.features_table(t)
    writers.create_features_table(rows, name, path)
    writers.create_features_table(rows.limit(0), name, path)  # exists: nothing happens
    return as_wkt(t.spark.table(name), "geom", "geom").drop("part", "srid")


@query("insert_if_absent")
def _(t):
    path = scratch_path(t.spark, "result")
    rows = counts.find_count(t)
    keys = [A, "find_type"]
    complete = rows.where(F.col("find_type").isNotNull())
    writers.insert_if_absent(rows.where(F.col("find_count") > 2), path, keys)
    writers.insert_if_absent(complete, path, keys)  # only the missing ones go in
    writers.insert_if_absent(rows.where("find_type IS NULL AND find_count <= 2"), path, keys)
    return t.spark.read.parquet(path)


@query("update_from")
def _(t):
    target = t["object"].select(A, "ObjectId", F.lit(0).cast("bigint").alias("links"))
    links = t["object_rel"].groupBy(A, F.col("ParentId").alias("ObjectId")).agg(
        F.count(F.lit(1)).alias("links"))
    return writers.update_from(target, links, [A, "ObjectId"], ["links"])


@query("update_status", stored=False)
def _(t):
    path = scratch_path(t.spark, "manifest")
    t["manifest"].write.parquet(path)
    writers.update_status(site.archive_names(t), path, "features", "done", 2)
    return pending.latest_status(t.spark.read.parquet(path)).select(
        A, "step", "version", "status")


@query("error_rows")
def _(t):
    files = t["binary_value"].where(F.col("Value").isNotNull()).select(
        A, F.col("AttributeId").alias("ObjectId"), F.col("Value").alias("wkb"))
    mixed = {"geo_object": t["geo_object"].select(A, "ObjectId", "wkb").union(files)}
    good, bad = spatial.error_rows(mixed)
    count = F.count(F.lit(1)).alias("n")
    return (good.groupBy(A).agg(count).select(A, F.lit("read").alias("outcome"), "n")
            .union(bad.groupBy(A).agg(count).select(A, F.lit("failed").alias("outcome"), "n")))


@query("export_blobs", stored=False)
def _(t):
    folder = scratch_path(t.spark, "blobs").removeprefix("file:")
    return writers.export_blobs(t["binary_value"], folder, "html").drop("path")


@query("incremental_class_counts")
def _(t):
    t["object"]
    base = scratch_path(t.spark, "stream")
    def surveyed(tables):
        return tables["object"].groupBy(A).agg(
            F.count(F.when(F.col("ClassId") == 11, 1)).alias("surveyed"))

    rows = t["object"].select(*[f.split()[0] for f in CORE_TABLES["object"].split(", ")])
    late = F.col("ObjectId") % 3 == 0
    for part in (~late, late, F.lit(False)):  # archives come in two files; the last run finds none
        rows.where(part).write.mode("append").parquet(f"{base}/object")
        run_incremental(t.spark, f"{base}/object", "object", surveyed,
                        f"{base}/result", f"{base}/checkpoint")
    return t.spark.read.parquet(f"{base}/result")


# -- runs: each twice, the second finds nothing to do -----------------------------------
def run_twice(t, label, names, run):
    """Half of the archives first, then all, then all again; what is stored in the end."""
    path = scratch_path(t.spark, label)
    tables = {name: t[name] for name in names}
    early = {name: df.where(F.crc32(A) % 2 == 0) if A in df.columns else df for name, df in tables.items()}
    for held in (early, tables, tables):
        run(held, f"{path}/out", f"{path}/manifest")
    return t.spark.read.parquet(f"{path}/out")


@query("run_clean_notes")
def _(t):
    return run_twice(t, "notes", ("object", "free_text"), runs.clean_notes).select(
        A, "AttributeId", "converted_text")


@query("run_check_validity")
def _(t):
    return run_twice(t, "validity", ("object", "geo_object"), runs.check_validity)


@query("run_move_to_target")
def _(t):
    return as_wkt(run_twice(t, "moved", ("object", "geo_object"), runs.move_to_target)).select(
        A, "ObjectId", "wkt")


@query("run_regions")
def _(t):
    path = scratch_path(t.spark, "regions")
    tables = {name: t[name] for name in ("object", "geo_object", "region")}
    early = {name: df.where(F.crc32(A) % 2 == 0) if A in df.columns else df for name, df in tables.items()}
    for held in (early, tables, tables):
        runs.regions(held, path, f"{path}/manifest", cell=CELL)
    return flat(t.spark.read.parquet(f"{path}/regions").drop("part"))


@query("run_judge_values")
def _(t):
    """Every value with its default status, and its nearest word to the default keyword."""
    values = counts.attribute_values(t).where(F.col("value").isNotNull()).withColumn("pk", F.col("value"))
    return runs.judge_values(values).drop("pk")


@query("run_export_csv")
def _(t):
    """The CSV files of all archives as read back, every column a text, with the place of the site."""
    path = scratch_path(t.spark, "export")
    tables = {name: t[name] for name in CORE_TABLES if name not in ("binary_value", "manifest")}
    for _ in range(2):
        runs.export_csv(tables, f"{path}/out", f"{path}/manifest", cell=CELL)
    return t.spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(f"{path}/out")


def compared(t):
    """Half of the archives first, then all: the folder with the results."""
    path = scratch_path(t.spark, "compared")
    rows = t["geo_object"]
    for part in (rows.where(F.crc32(A) % 2 == 0), rows):
        runs.compare_geometries({"geo_object": part}, path)
    return path


@query("run_compare_geometries")
def _(t):
    out = t.spark.read.parquet(f"{compared(t)}/same_geometry")
    return flat(as_wkt(out, "the_geom", "wkt").drop("pk", "srid", "bucket"))


@query("run_compare_partners")
def _(t):
    path = compared(t)
    return partners(t.spark.read.parquet(f"{path}/geometry_intersects"), t.spark.read.parquet(f"{path}/same_geometry"))


# -- attributes and relations --------------------------------------------------------
for _name in ("object_attributes", "objects_and_attributes", "attr_detail", "attributes_layer"):
    query(_name)(getattr(eav, _name))
query("object_definitions", stored=False)(eav.object_definitions)
for _name in ("relations_layer", "group_members"):
    query(_name, stored=False)(getattr(relations, _name))


@query("attr_text")
def _(t):
    detail = t["attribute"].join(t["attribute_def"].select(A, "MetaId"), [A, "MetaId"]).join(
        t["attribute_value"], [A, "AttributeId"])
    return detail.select(A, F.col("AttributeValueId").alias("attributevalue_id"),
                         *[eav.attr_text(rule).alias(f"text_{rule}")
                           for rule in ("csv", "table", "draft", "view")])


@query("value_with_unit")
def _(t):
    return t["attribute_value"].select(A, "AttributeValueId",
                                       eav.value_with_unit().alias("value_with_unit"))


@query("attr_arrays")
def _(t):
    return flat(eav.attr_arrays(t).drop("members"))


@query("parent_relations", stored=False)
def _(t):
    return flat(relations.parent_relations(t).drop("members"))


@query("child_relations", stored=False)
def _(t):
    return flat(relations.child_relations(t).drop("members"))


@query("relation_arrays_described", stored=False)
def _(t):
    return flat(relations.relation_arrays_described(t).drop("members", "part"))


@query("groups_layer")
def _(t):
    return relations.groups_layer(t)


@query("definitions_by_id", stored=False)
def _(t):
    return eav.definitions_by_id(t, (122, 183, 10004))


@query("geo_object_attribute_arrays")
def _(t):
    return flat(as_wkt(features.geo_object_attribute_arrays(t), "the_geom", "the_geom")
                .drop("part"))


# -- exports -----------------------------------------------------------------------------
@query("feature_core")
def _(t):
    return features.feature_core(t).drop("wkb", "srid")


@query("feature_core_strict")
def _(t):
    return features.feature_core(t, strict=True).drop("wkb", "srid")


@query("features_table")
def _(t):
    return as_wkt(features.features_table(t), "geom", "geom").drop("part", "srid")


@query("features_table_v1")
def _(t):
    return as_wkt(features.features_table(t, public_id=False), "geom", "geom").drop(
        "part", "srid")


@query("features_csv")
def _(t):
    sites = site.site_summary(t, with_place=False)
    fields = site.unnest_site_attributes(sites)
    names = sites.where(F.col("part") == 0).select(A, "site_name")
    empty = ["site_landskap", "lan_name", "parish_name", "site_centroid", "undersokningstyp",
             "exploateringstyp", "raa_dnr", "lst_dnr", "part"]
    return ascii_fields(flat(features.features_csv(t, names, fields).drop(*empty)))


@query("features_csv_with_place")
def _(t):
    """All columns, with the site table of the run."""
    sites = cut_lineage(site.site_summary(t, cell=CELL))
    fields = site.unnest_site_attributes(sites)
    return ascii_fields(flat(features.features_csv(t, sites.where(F.col("part") == 0), fields)))


@query("project_information")
def _(t):
    sites = site.site_summary(t, with_place=False)
    out = site.project_information(sites, site.unnest_site_attributes(sites))
    return ascii_fields(out.select("pk", A, "site_name", "slutdatum", "projektnamn",
                                   "projektkod", "plats", "undersöknings_id"))


@query("object_texts")
def _(t):
    return relations.object_texts(t)


# -- site ------------------------------------------------------------------------------------
for _name in ("project_count", "attribute_counts", "class_counts", "spatial_type_counts",
              "fieldwork_dates", "recorded_srid", "multi_project_check", "node_edge_count"):
    query(_name, stored=False)(getattr(site, _name))


@query("site_summary")
def _(t):
    out = site.site_summary(t, with_place=False)
    return flat(out.drop("table_array", "table_ct", "site_archive", "parish_name", "lan_name",
                         "geom_centroid_wkt", "x_dispersion", "y_dispersion", "geom",
                         "eez_name", "converged"))


@query("site_summary_with_place")
def _(t):
    names = ("object", "geo_object", "attribute", "event")
    out = site.site_summary(t, inventory=site.held_tables(t, names), cell=CELL)
    return flat(out.drop("geom"))


@query("site_centroid")
def _(t):
    return site.site_centroid(t)


@query("site_extent")
def _(t):
    return site.centroid_points(t).groupBy(A).agg(
        (F.max("x") - F.min("x")).alias("x_dispersion"),
        (F.max("y") - F.min("y")).alias("y_dispersion"))


@query("site_region")
def _(t):
    centres = site.site_centroid(t).select(A, "x", "y")
    return site.site_region(centres, t["region"], ["namn", "lan"], CELL)


@query("site_attributes", stored=False)
def _(t):
    return flat(site.site_attributes(t).drop("members", "part"))


@query("unnest_site_attributes", stored=False)
def _(t):
    return ascii_fields(site.unnest_site_attributes(site.site_attributes(t)))


@query("blob_metrics", stored=False)
def _(t):
    return site.blob_metrics(t, by_type=True)


# -- counting ----------------------------------------------------------------------------------
for _name in ("find_count", "select_finds", "attribute_values", "geo_attribute_values"):
    query(_name)(getattr(counts, _name))


@query("feature_count")
def _(t):
    return counts.feature_count(t, SIMPLE_PATTERN)


@query("feature_count_postholes")
def _(t):
    return counts.feature_count(t)


@query("value_status")
def _(t):
    return counts.value_status(counts.attribute_values(t), SIMPLE_PATTERN)


@query("value_status_postholes")
def _(t):
    return counts.value_status(counts.attribute_values(t))


@query("value_histogram")
def _(t):
    return counts.value_histogram(t, F.col("Value").ilike("%b_l%"))


@query("prototype_histograms")
def _(t):
    return counts.prototype_histograms(t)


@query("histogram_difference")
def _(t):
    return counts.histogram_difference(t, F.col("Value").ilike("%r_n%"),
                                       F.col("Value").rlike("(?i)red|hot"))


@query("keyword_distance")
def _(t):
    values = t["attribute_value"].select(A, F.col("AttributeValueId").alias("pk"),
                                         F.col("Value").alias("value"))
    return counts.keyword_distance(values, "GIZMO", key=[A, "pk"])


# -- text -----------------------------------------------------------------------------------------
@query("clean_text")
def _(t):
    return t["free_text"].select(A, "AttributeId",
                                 X.clean_text(F.col("Text")).alias("converted_text"))


@query("clean_text_csv")
def _(t):
    return t["free_text"].select(A, "AttributeId",
                                 X.clean_text_csv(F.col("Text")).alias("converted_text"))


@query("clean_text_span")
def _(t):
    cut = X.clean_text_span(F.col("Text"), F.col("AttributeId"), late=r"\\par", early=r"\\par")
    return t["free_text"].select(A, "AttributeId", cut.alias("converted_text"))


# -- spatial --------------------------------------------------------------------------------------
@query("validity_report")
def _(t):
    return spatial.validity_report(t)


@query("reproject")
def _(t):
    return as_wkt(reproject.reproject(t, reproject.likely_srid(t))).select(A, "ObjectId", "wkt")


@query("reproject_zone")
def _(t):
    srids = site.archive_names(t).select(A, F.lit(3008).alias("likely_srid"))
    return spatial.geom_measures({"geo_object": reproject.reproject(t, srids)})


@query("likely_srid", stored=False)
def _(t):
    return reproject.likely_srid(t)


@query("likely_srid_cascade")
def _(t):
    return reproject.likely_srid_cascade(t, cell=500.0)


@query("srid_intersect")
def _(t):
    return spatial.srid_intersect(t, CELL)


@query("same_geometry")
def _(t):
    return flat(as_wkt(spatial.same_geometry(t)).drop("srid"))


@query("same_geometry_all")
def _(t):
    out = as_wkt(spatial.same_geometry_all(t), "the_geom", "wkt")
    return flat(out.drop("pk", "srid"))


def partners(met, groups):
    """A row for each partner of a geometry, with both as texts."""
    names = as_wkt(groups.select(F.col("pk").alias("other"), "the_geom"), "the_geom", "intersects")
    each = met.select("the_geom", F.inline(F.arrays_zip(
        F.col("intersect_pk").alias("other"), F.col("intersect_dbs").alias("dbs"))))
    each = each.toDF("the_geom", "other", "intersect_dbs").join(names, "other").drop("other")
    return as_wkt(each, "the_geom", "wkt")


@query("geometry_intersects")
def _(t):
    groups = spatial.same_geometry_all(t)
    return partners(spatial.geometry_intersects(groups), groups)


@query("objects_in_region")
def _(t):
    return flat(spatial.objects_in_region(t, CELL).drop("part"))


@query("region_union")
def _(t):
    objects = t["geo_object"].select(A, "ObjectId", "wkb")
    return spatial.in_any_region(objects, [A, "ObjectId"], t["zone"], 500.0).drop("wkb")


@query("apply_geometry_fixes")
def _(t):
    def source(digit, x, y):
        rows = t["geo_object"].where(F.col("ObjectId") % 10 == digit)
        return rows.select(A, F.col("ObjectId").cast("string").alias("object_ids"),
                           G.point_wkb(F.lit(x), y).alias("wkb"))

    first = source(2, 1.0, F.col("ObjectId").cast("double"))
    groups = t["geo_object"].where(F.col("ObjectId") % 10 == 3).groupBy(
        A, "MetaId", F.floor(F.col("ObjectId") / 1000)).agg(
        F.array_join(F.collect_list(F.col("ObjectId").cast("string")), ",").alias("object_ids"))
    second = groups.select(A, "object_ids", G.point_wkb(F.lit(2.0), F.lit(2.0)).alias("wkb"))
    fixed = spatial.apply_geometry_fixes(t, first, second)
    return as_wkt(fixed).select(A, "ObjectId", "wkt")


@query("force_2d")
def _(t):
    return as_wkt(spatial.force_2d(t)).select(A, "ObjectId", "wkt")


@query("normalize_geometry")
def _(t):
    return as_wkt(spatial.normalize_geometry(t)).select(A, "ObjectId", "wkt", "repaired",
                                                        "still_invalid")


def ring(x0, y0, x1, y1):
    return np.array([[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]], float)


BOX, HALF = ring(0, 0, 8, 8), ring(2, 2, 6, 6)
# Shapes with faults, and some that look like it: each geometry gets the one of its id.
ODD_SHAPES = [
    (3, [(0, SHELL, BOX)]),                                              # a valid box
    (3, [(0, SHELL, BOX[[0, 2, 1, 3, 0]])]),                             # a bow-tie
    (3, [(0, SHELL, BOX[:4])]),                                          # an open ring
    (6, [(0, SHELL, BOX), (1, SHELL, BOX)]),                             # two equal shells
    (3, [(0, SHELL, BOX), (0, HOLE, ring(0, 2, 4, 6))]),                 # a hole on the border
    (3, [(0, SHELL, BOX), (0, HOLE, HALF), (0, HOLE, ring(3, 3, 5, 5))]),  # a hole in a hole
    (7, [(0, SHELL, BOX), (1, SHELL, HALF)]),                            # a collection: valid
    (3, [(0, SHELL, BOX[[0, 0, 1, 2, 3, 4]])]),                          # a repeated point: valid
    (1, [(0, POINT, np.array([[1.0, 2.0, 3.0]]))]),                      # a height
]


def odd_shapes(t):
    shapes = F.array(*[F.lit(write_rings(*shape)) for shape in ODD_SHAPES])
    odd = t["geo_object"].withColumn("wkb", F.get(shapes, F.col("ObjectId") % len(ODD_SHAPES)))
    return {"object": t["object"], "geo_object": odd}


@query("validity_report_shapes")
def _(t):
    return spatial.validity_report(odd_shapes(t))


@query("normalize_geometry_shapes")
def _(t):
    return spatial.normalize_geometry(odd_shapes(t)).select(A, "ObjectId", "repaired", "still_invalid")


@query("force_2d_shapes")
def _(t):
    return as_wkt(spatial.force_2d(odd_shapes(t))).select(A, "ObjectId", "wkt")


@query("force_2d_raised_shapes")
def _(t):
    """All rows, each shape raised: every point has a height of its own."""
    raised = [(gtype, [(part, kind, np.column_stack([p[:, :2], 1.5 + np.arange(len(p))])) for part, kind, p in rings])
              for gtype, rings in ODD_SHAPES]
    shapes = F.array(*[F.lit(write_rings(*shape)) for shape in raised])
    odd = t["geo_object"].withColumn("wkb", F.get(shapes, F.col("ObjectId") % len(raised)))
    return as_wkt(spatial.force_2d({"geo_object": odd})).select(A, "ObjectId", "wkt")


@query("geom_to_wkt")
def _(t):
    return spatial.geom_to_wkt(t)


@query("geom_measures")
def _(t):
    return spatial.geom_measures(t)
