"""One row per archive: counts, dates, project fields, centroid and place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trowel import schema as S
from trowel.functions.geometry import geom_stats, number_text, once, point_wkb
from trowel.functions.lists import element, fold
from trowel.operators.median import geometric_median
from trowel.operators.spatial import region_hits
from trowel.session import broadcast_if_small, cut_lineage

A = "archive"


def _count_of(condition: Column, column: str) -> Column:
    return F.count(F.when(condition, F.col(column)))


# Figures of an archive: the narrow rows they are taken from, with column names of their own, and the
# aggregates. `archive_figures` unites the rows, so that one grouping gives all figures.
def _objects(t):
    return t["object"].select(A, "ClassId")


def _project_count():
    return [_count_of(F.col("ClassId") == S.CLASS_PROJECT, "ClassId").alias("project_count")]


def _class_counts():
    return [_count_of(F.col("ClassId") == c, "ClassId").alias(name) for name, c in (
        ("surveyed_arch_object_count", S.CLASS_SURVEYED), ("fornlamning_count", S.CLASS_MONUMENT),
        ("omrade_or_schakt_count", S.CLASS_TRENCH))]


def _attributes(t):
    return t["attribute"].select(A, F.col("MetaId").alias("attribute_meta"), "Label")


def _attribute_counts():
    return [_count_of(F.col("attribute_meta") == meta, "Label").alias(name)
            for name, meta in (("sample_count", S.META_SAMPLE), ("find_count", S.META_FIND))]


def _spatial_types(t):
    """Geometries counted by definition first: few rows are left to join."""
    held = t["geo_object"].groupBy(A, "MetaId").agg(F.count(F.lit(1)).alias("held"))
    return (held.join(t["geo_object_def"].select(A, "MetaId", "Type"), [A, "MetaId"])
            .select(A, F.col("MetaId").alias("spatial_meta"), F.when(F.col("Type").isNotNull(), F.col("held")).alias("held")))


def _spatial_type_counts():
    return [F.coalesce(F.sum(F.when(F.col("spatial_meta").isin(*metas), F.col("held"))), F.lit(0)).alias(name)
            for name, metas in (("point_count", S.META_POINTS), ("polygon_count", [S.META_POLYGON]),
                                ("polyline_count", [S.META_POLYLINE]))]


def _events(t):
    return t["event"].select(A, F.date_format("Time", "yyyy-MM").alias("month"),
                             F.col("Description").startswith(S.MEASUREMENT_IMPORT).alias("measured"))


def _fieldwork_dates():
    measured = F.when(F.col("measured"), F.col("month"))
    return [F.min("month").alias("db_creation_date"), F.min(measured).alias("start_of_fieldwork"),
            F.max(measured).alias("end_of_fieldwork")]


def _noted_srids(t):
    """Notes are one attribute of many: sent to the values, which stay where they are."""
    noted = t["attribute"].where(F.col("MetaId") == S.META_SRID).select(A, "AttributeId")
    return t["attribute_value"].join(broadcast_if_small(noted), [A, "AttributeId"]).select(
        A, F.col("AttributeValueId").alias("srid_id"), F.struct("Value").alias("srid_value"))


def _recorded_srid():
    first = F.min_by("srid_value", "srid_id")
    return [first["Value"].try_cast("int").alias("intrasis_srid")]


def project_count(t) -> DataFrame:
    return _objects(t).groupBy(A).agg(*_project_count())


def class_counts(t) -> DataFrame:
    return _objects(t).groupBy(A).agg(*_class_counts())


def attribute_counts(t) -> DataFrame:
    return _attributes(t).groupBy(A).agg(*_attribute_counts())


def spatial_type_counts(t) -> DataFrame:
    """Points, polygons and lines of each archive that has a geometry with a definition."""
    return _spatial_types(t).groupBy(A).agg(*_spatial_type_counts())


def fieldwork_dates(t) -> DataFrame:
    return _events(t).groupBy(A).agg(*_fieldwork_dates())


def recorded_srid(t) -> DataFrame:
    """The SRID noted in the archive; the value with the lowest id if there are several."""
    return _noted_srids(t).groupBy(A).agg(*_recorded_srid())


def archive_figures(t) -> DataFrame:
    """All of these figures of an archive in one row, from one grouping; counts are 0, dates and
    SRID NULL where a source has no rows."""
    rows = _objects(t)
    for more in (_attributes(t), _spatial_types(t), _events(t), _noted_srids(t)):
        rows = rows.unionByName(more, allowMissingColumns=True)
    return rows.groupBy(A).agg(*_project_count(), *_class_counts(), *_attribute_counts(),
                               *_spatial_type_counts(), *_fieldwork_dates(), *_recorded_srid())


def multi_project_check(t) -> DataFrame:
    """Archives with more than one site marker."""
    return (t["attribute"].where(F.col("MetaId") == S.META_SITE_MARKER).groupBy(A)
            .agg(F.count(F.lit(1)).alias("site_markers")).where(F.col("site_markers") > 1))


def node_edge_count(t) -> DataFrame:
    """Geometries and links; an archive with neither still has a row of zeros."""
    nodes = t["geo_object"].select(A, F.col("wkb").isNotNull().cast("int").alias("node"),
                                   F.lit(0).alias("edge"))
    edges = t["object_rel"].select(A, F.lit(0), F.lit(1))
    every = archive_names(t).select(A, F.lit(0), F.lit(0))
    return nodes.union(edges).union(every).groupBy(A).agg(
        F.sum("node").alias("node_count"), F.sum("edge").alias("edge_count"))


def archive_names(t) -> DataFrame:
    """All archives: every one holds objects."""
    return t["object"].select(A).distinct()


def archive_list(t, own: tuple[str, ...] = (), system=S.SYSTEM_ARCHIVES) -> DataFrame:
    """Archives by name, without system databases and the server's ``own`` ones."""
    return archive_names(t).where(~F.col(A).isin(*system, *own)).orderBy(A)


def size_text(size: Column) -> Column:
    """Bytes in the largest unit that keeps at least 10 of it."""
    out = F.concat(size.cast("string"), F.lit(" bytes"))
    for power, unit in enumerate(("kB", "MB", "GB", "TB", "PB"), start=1):
        scale = 1024 ** power
        out = F.when(size >= 10 * scale, F.concat(
            F.round(size / scale).cast("bigint").cast("string"), F.lit(f" {unit}"))
        ).otherwise(out)
    return out


def blob_metrics(t, by_type: bool = False) -> DataFrame:
    """Stored files and their bytes per archive, on request per content type."""
    keys = [A, "MimeType"] if by_type else [A]
    counted = t["binary_value"].groupBy(*keys).agg(
        F.count("Value").alias("blob_count"),
        F.coalesce(F.sum(F.octet_length("Value").cast("bigint")), F.lit(0)).alias("blob_bytes"))
    return counted.withColumn("blob_storage_size", size_text(F.col("blob_bytes")))


# -- project fields ---------------------------------------------------------------
def site_attributes(t, **bounds: int) -> DataFrame:
    """Texts ``Label: Value`` of each project object, in order of the value's id."""
    projects = t["object"].where(F.col("ClassId") == S.CLASS_PROJECT).select(
        A, "ObjectId", F.col("Name").alias("site_name"))
    values = (projects.join(t["attribute"].select(A, "AttributeId", "ObjectId", "Label"),
                            [A, "ObjectId"])
              .join(t["attribute_value"].select(A, "AttributeId", "AttributeValueId", "Value"),
                    [A, "AttributeId"]))
    text = F.concat("Label", F.lit(": "), "Value")
    return fold(values, [A, "ObjectId", "site_name"], "AttributeValueId",
                {"site_attributes": element(text)}, **bounds)


# Output field and the label prefixes that fill it.
FIELD_LABELS = {
    "slutdatum": ("End date", "Slutdatum"),
    "undersokningstyp": ("Type of excavation", "Undersökningstyp"),
    "exploateringstyp": ("Type of exploatation", "Exploateringstyp"),
    "projektnamn": ("Projektnamn", "Project name"),
    "projektkod": ("Projektkod", "Project code"),
    "raa_dnr": ("Raä Dnr",),
    "lst_dnr": ("Lst Dnr",),
    "plats": ("Plats", "Place"),
    "undersöknings_id": ("Site Id", "Undersöknings Id"),
}


def unnest_site_attributes(sites: DataFrame, strict: bool = False) -> DataFrame:
    """Nine fields per archive from the texts in ``site_attributes``.

    ``strict`` keeps the known slip that a Swedish excavation type only counts when its
    text begins with a quotation mark.
    """
    texts = sites.select(A, F.explode("site_attributes").alias("text"))
    pattern = r"(?s): (.*)"
    value = F.regexp_extract("text", pattern, 1)
    parsed = texts.withColumn("value", F.when(F.col("text").rlike(pattern), value)).where(
        F.length("value") > 1)

    def field(name, labels):
        if strict and name == "undersokningstyp":
            labels = (labels[0], '"' + labels[1])
        match = F.lit(False)
        for label in labels:
            match = match | F.col("text").startswith(label)
        return F.max(F.when(match, F.col("value"))).alias(name)

    return parsed.groupBy(A).agg(*[field(n, p) for n, p in FIELD_LABELS.items()])


def project_information(archives: DataFrame, fields: DataFrame) -> DataFrame:
    """The project layer: site columns and fields, one row per archive of the site table."""
    names = ["site_name", "site_landskap", "lan_name", "parish_name", "geom"]
    kept = [F.col(n) if n in archives.columns else F.lit(None).cast("string").alias(n)
            for n in names]
    first = archives.where(F.col("part") == 0) if "part" in archives.columns else archives
    return (first.select(A, *kept).withColumn("pk", F.lit(1))
            .join(fields, A, "left")
            .select("pk", A, *names, *[F.col(f"`{n}`") for n in FIELD_LABELS]))


# -- centroid and place -------------------------------------------------------------
def centroid_points(t) -> DataFrame:
    """The distinct centroids of each archive's geometries."""
    measured = t["geo_object"].where(F.col("wkb").isNotNull()).select(
        A, once(geom_stats("wkb")).alias("g"))
    points = measured.where(F.col("g.cx").isNotNull())
    return points.select(A, F.col("g.cx").alias("x"), F.col("g.cy").alias("y")).distinct()


def site_centroid(t, **options) -> DataFrame:
    """Geometric median and extent of the distinct centroids, in the target system."""
    points = cut_lineage(centroid_points(t))
    extent = points.groupBy(A).agg(
        (F.max("x") - F.min("x")).alias("x_dispersion"),
        (F.max("y") - F.min("y")).alias("y_dispersion"))
    middle = geometric_median(points, A, **options)
    text = F.concat(F.lit("POINT("), number_text(F.col("x")), F.lit(" "),
                    number_text(F.col("y")), F.lit(")"))
    return cut_lineage(extent.join(middle, A).select(
        A, "x", "y", text.alias("geom_centroid_wkt"), "x_dispersion", "y_dispersion", "converged"))


def site_region(centres: DataFrame, layer: DataFrame, columns: list[str],
                cell: float = 1000.0) -> DataFrame:
    """Each archive's centre with the layer features it lies in, NULLs for none."""
    points = cut_lineage(centres.select(A, point_wkb("x", "y").alias("wkb")))  # bytes made by other tasks than measure them
    hits = region_hits(points, [A], layer, columns, cell)
    return centres.join(hits, A, "left")


def table_inventory(spark, database: str) -> DataFrame:
    """Names and number of the tables of a database, from the catalog."""
    rows = spark.sql(f"SHOW TABLES IN {database}").where(~F.col("isTemporary"))
    return rows.groupBy(F.col("namespace").alias(A)).agg(
        F.array_sort(F.collect_list("tableName")).alias("table_array"),
        F.count(F.lit(1)).alias("table_ct"))


def held_tables(t, names) -> DataFrame:
    """Which of the core tables hold rows of an archive: the per-archive inventory."""
    seen = None
    for name in names:
        rows = t[name].select(A).distinct().select(A, F.lit(name).alias("name"))
        seen = rows if seen is None else seen.union(rows)
    return seen.groupBy(A).agg(F.array_sort(F.collect_list("name")).alias("table_array"),
                               F.count(F.lit(1)).alias("table_ct"))


def site_summary(t, with_place: bool = True, inventory: DataFrame | None = None,
                 cell: float = 1000.0, **median_options) -> DataFrame:
    """The site table: one row per archive that has a project object with values.

    ``converged`` is false where the centre is only the best point found in the rounds allowed.
    Of several project objects the lowest id is kept, then the first place by name. Values too
    many for one row go on in further rows, ``part`` above 0, that repeat the other columns.
    """
    listed = site_attributes(t)
    least = listed.groupBy(A).agg(F.min("ObjectId").alias("ObjectId"))
    out = listed.join(least, [A, "ObjectId"], "left_semi").drop("ObjectId", "members")
    parts = [archive_figures(t)]
    if with_place:
        centres = site_centroid(t, **median_options)
        spots = centres.select(A, "x", "y")
        parish = site_region(spots, t["region"], ["namn", "lan"], cell).groupBy(A).agg(
            F.min(F.struct("namn", "lan")).alias("p")).select(
            A, F.col("p.namn").alias("parish_name"), F.col("p.lan").alias("lan_name"))
        zone = site_region(spots, t["zone"], ["eez_name"], cell).groupBy(A).agg(
            F.min("eez_name").alias("eez_name"))
        parts += [centres, parish, zone]
    if inventory is not None:
        parts.append(inventory)
    for part in parts:
        out = out.join(part, A, "left")
    if with_place:
        out = out.withColumn("geom", point_wkb("x", "y"))

    def given(name, kind):
        return F.col(name) if name in out.columns else F.lit(None).cast(kind).alias(name)

    def counted(name, alias):
        return F.coalesce(name, F.lit(0)).alias(alias)

    return out.select(
        A, "site_name", given("table_array", "array<string>"), given("table_ct", "bigint"),
        "db_creation_date", "start_of_fieldwork", "end_of_fieldwork",
        F.col(A).alias("site_archive"),
        counted("project_count", "project_ct"),
        counted("omrade_or_schakt_count", "omrade_schakt_ct"),
        counted("surveyed_arch_object_count", "arch_obj_ct"),
        counted("fornlamning_count", "fornlamn_ct"), counted("sample_count", "sample_ct"),
        counted("find_count", "find_ct"), counted("point_count", "point_ct"),
        counted("polygon_count", "polygon_ct"), counted("polyline_count", "polyline_ct"),
        given("parish_name", "string"), given("lan_name", "string"),
        given("geom_centroid_wkt", "string"), given("x_dispersion", "double"),
        given("y_dispersion", "double"), "intrasis_srid",
        F.lit(S.TARGET_SRID).alias("likely_srid"), "site_attributes",
        given("geom", "binary"), given("eez_name", "string"), given("converged", "boolean"), "part")
