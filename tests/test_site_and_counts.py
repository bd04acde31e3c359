from pyspark.sql import functions as F

from trowel.functions import patterns as P
from trowel.operators import counts, site


def test_summary_drops_archives_without_project_and_keeps_the_lowest(tables):
    got = {r.archive: r for r in site.site_summary(tables, with_place=False).collect()}
    assert set(got) == {"a1", "a2"}  # a3 has no project object
    assert got["a2"].site_name == "Site two" and got["a2"].project_ct == 2
    assert got["a1"].arch_obj_ct == 2 and got["a1"].point_ct == 2 and got["a1"].polygon_ct == 3
    assert got["a1"].site_attributes == ["Slutdatum: 2001-02-03"]
    assert got["a1"].db_creation_date is None and got["a1"].intrasis_srid is None


def test_summary_with_place(spark, tables):
    got = {r.archive: r for r in site.site_summary(tables, cell=4.0).collect()}
    assert got["a2"].geom_centroid_wkt == "POINT(2.5 2.5)"
    assert (got["a2"].parish_name, got["a2"].eez_name) == ("north", "sea")


def test_unnest(tables):
    df = tables["object"].sparkSession.createDataFrame([
        ("a1", ["Slutdatum: 2020", "Plats: ", "Projektkod: A", "Undersökningstyp: X: y\nz",
                None, "Raä Dnr no colon", "End date: 2021"])],
        "archive string, site_attributes array<string>")
    got = site.unnest_site_attributes(df).first()
    assert got.slutdatum == "2021" and got.plats is None and got.projektkod is None
    assert got.undersokningstyp == "X: y\nz" and got.raa_dnr is None
    assert site.unnest_site_attributes(df, strict=True).first().undersokningstyp is None


def test_multi_project_and_nodes(tables):
    assert [(r.archive, r.site_markers) for r in site.multi_project_check(tables).collect()] == [
        ("a2", 2)]
    got = {r.archive: (r.node_count, r.edge_count) for r in site.node_edge_count(tables).collect()}
    assert got == {"a1": (5, 4), "a2": (1, 1), "a3": (0, 0)}


def test_blobs_and_sizes(spark, tables):
    got = site.blob_metrics(tables).first()
    assert (got.blob_count, got.blob_bytes, got.blob_storage_size) == (1, 3, "3 bytes")
    sizes = spark.createDataFrame([(10239,), (10240,), (20 * 1024**2,), (30 * 1024**3,)], "n bigint")
    assert [r.t for r in sizes.select(site.size_text(F.col("n")).alias("t")).collect()] == [
        "10239 bytes", "10 kB", "20 MB", "30 GB"]


def test_find_count_keeps_null(tables):
    got = {(r.archive, r.find_type): r.find_count for r in counts.find_count(tables).collect()}
    assert got == {("a1", None): 2, ("a1", ""): 2, ("a1", "Stolphål"): 2, ("a2", "grop"): 1}


def test_feature_count(tables):
    got = {(r.archive, r.feature): (r.feature_count, round(r.feature_proportion, 4),
                                    r.total_features)
           for r in counts.feature_count(tables).collect()}
    # object 10 of archive a1 has two geometries: its seven values count twice
    assert got["a1", "Stolphål"] == (4, 0.29, 14)
    assert got["a1", P.POSTHOLE_LABEL] == (4, 0.29, 14)
    assert got["a2", P.POSTHOLE_LABEL] == (0, 0.0, 1)
    assert got["a3", P.POSTHOLE_LABEL] == (0, 0.0, 0)  # no values: no division by zero


def test_value_status(tables):
    got = {r.value: r.extraction_status for r in
           counts.value_status(counts.attribute_values(tables)).collect()}
    assert got["Stolphål"] == P.STATUS_USED and got["grop"] == got[None] == P.STATUS_UNUSED


def test_keyword_distance(spark):
    values = spark.createDataFrame([(1, "ett stolphål här"), (2, "mur"), (3, None),
                                    (4, "stolphäl stolphål")], "pk int, value string")
    got = {r.pk: (r.distance, r.word) for r in counts.keyword_distance(values).collect()}
    assert got == {1: (0, "stolphål"), 4: (0, "stolphål")}


def test_histogram_orders_nulls_last(tables):
    got = [r.Value for r in counts.value_histogram(tables).collect()]
    assert got[-1] is None and got[:-1] == sorted(got[:-1])


def exchanges(df):
    """Shuffles of a plan without broadcasts by size."""
    spark, key = df.sparkSession, "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        spark.conf.set(key, before)


def test_figures_of_one_grouping_are_those_of_the_operators(tables):
    figures = site.archive_figures(tables)
    assert exchanges(figures) <= 4
    got = {r.archive: r.asDict() for r in figures.collect()}
    assert set(got) == {r.archive for r in site.archive_names(tables).collect()}
    for operator in (site.project_count, site.class_counts, site.attribute_counts, site.spatial_type_counts,
                     site.fieldwork_dates, site.recorded_srid):
        part = operator(tables)
        held = {r.archive: r.asDict() for r in part.collect()}
        for archive, row in got.items():
            for name in part.columns[1:]:
                want = held[archive][name] if archive in held else 0 if name.endswith("count") else None
                assert row[name] == want, (archive, name)


def test_weighed_value_counts_equal_counted_rows(spark, tables):
    twice = {**tables, "geo_rel": tables["geo_rel"].union(tables["geo_rel"]),
             "object": tables["object"].union(tables["object"].where("archive = 'a1'"))}
    for t in (tables, twice):
        plain = counts.geo_values(t).groupBy("archive", "Value").count()
        got = sorted(map(tuple, counts.geo_value_counts(t).collect()), key=str)
        assert got and got == sorted(map(tuple, plain.collect()), key=str)
    assert exchanges(counts.geo_value_counts(tables)) <= 7


def test_a_centre_that_did_not_converge_is_marked(tables):
    for rounds, want in ((1, False), (100, True)):
        rows = site.site_summary(tables, cell=7.0, rounds=rounds).where("geom IS NOT NULL").collect()
        assert rows and (want in {r.converged for r in rows})
