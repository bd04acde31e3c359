import re

from pyspark.sql import functions as F

from tests.small import OPEN_RING
from trowel.functions.lists import element, fold
from trowel.functions.numbering import number_rows, start_numbers
from trowel.operators import eav, relations, site, spatial
from trowel.plans import features


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()),
                  key=lambda r: [(v is None, str(v)) for v in r])


def test_text_rules(tables):
    values = tables["attribute"].where("AttributeId = 1000 AND archive = 'a1'").join(
        tables["attribute_value"], ["archive", "AttributeId"])
    got = {r.AttributeValueId: r for r in values.select(
        "AttributeValueId", *[eav.attr_text(k).alias(k)
                              for k in ("csv", "table", "draft", "view")]).collect()}
    assert [got[i].csv for i in range(1, 7)] == [
        None, None, "Typ: Stolphål ", "Typ: Stolphål cm", "Typ:  cm", "Typ:  cm"]
    assert [got[i].table for i in (4, 5, 6)] == ["Typ: Stolphål cm", None, None]
    assert [got[i].draft for i in (5, 6)] == ["Typ: <null> cm", "Typ: <null> cm"]
    assert [got[i].view for i in range(1, 4)] == [None, "Typ: no data", "Typ: Stolphål"]


def test_arrays_keep_nulls_in_order_and_archives_apart(tables):
    got = {(r.archive, r.object_id): r.attr_array for r in eav.attr_arrays(tables).collect()}
    # two alternative definitions double every value of archive a1
    assert got["a1", 10] == [v for v in (None, None, "Typ: Stolphål ", "Typ: Stolphål cm",
                                         "Typ:  cm", "Typ:  cm") for _ in (0, 1)]
    assert got["a2", 10] == ["Typ: grop m"]


def test_left_join_keeps_values_without_definition(tables):
    loose = [r for r in eav.object_attributes(tables).collect() if r.AttributeId == 1006]
    assert [(r.Value, r.ObjectId, r.Label) for r in loose] == [("x", None, None)]


def test_large_groups_come_in_parts_and_lose_nothing(spark):
    df = spark.range(2000).select(
        F.when(F.col("id") < 1500, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50))
        .alias("k"), "id", F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("v"))
    out = fold(df, ["k"], "id", {"vs": element(F.col("v"))}, max_members=200).collect()
    assert {(r.part, r.members) for r in out if r.k != "hot"} == {(0, 10)}
    hot = sorted((r for r in out if r.k == "hot"), key=lambda r: r.part)
    assert [(r.part, len(r.vs), r.members) for r in hot] == [(i, 200, 1500) for i in range(7)] + [(7, 100, 1500)]
    assert [v for r in hot for v in r.vs] == [str(i) if i % 3 else None for i in range(1500)]
    bytewise = fold(df, ["k"], "id", {"vs": element(F.col("v"))}, max_bytes=2000).collect()
    hot = sorted((r for r in bytewise if r.k == "hot"), key=lambda r: r.part)
    assert len(hot) > 8 and all(len(r.vs) <= 2000 // 16 + 1 for r in hot)
    assert [v for r in hot for v in r.vs] == [str(i) if i % 3 else None for i in range(1500)]


def test_a_group_of_300000_members_is_whole_in_every_operator(spark, tables):
    many = spark.range(300_001)
    t = {**tables, "attribute_value": tables["attribute_value"].unionByName(many.select(
        F.lit("a1").alias("archive"), (F.col("id") + 10_000).alias("AttributeValueId"), F.lit(1004).cast("bigint").alias("AttributeId"),
        F.col("id").cast("string").alias("Value"), F.lit("").alias("Unit")).select(tables["attribute_value"].columns).select(
        *[F.col(f.name).cast(f.dataType) for f in tables["attribute_value"].schema.fields]))}
    rows = sorted((r for r in site.site_summary(t, with_place=False).collect() if r.archive == "a1"), key=lambda r: r.part)
    texts = [x for r in rows for x in r.site_attributes]
    assert len(rows) == 2 and texts[1:] == [f"Slutdatum: {i}" for i in range(300_001)]
    assert {r.project_ct for r in rows} == {1} and site.project_information(
        site.site_summary(t, with_place=False), site.unnest_site_attributes(site.site_summary(t, with_place=False))).count() == 2

    points = many.select(F.lit("a1").alias("archive"), (F.col("id") + 10_000).alias("ObjectId"), F.lit(38).alias("MetaId"),
                         F.lit(None).alias("SymbolId"), F.lit(OPEN_RING).alias("wkb"), F.lit(3006).alias("srid"))
    t = {**tables, "geo_object": tables["geo_object"].unionByName(points.select(
        *[F.col(f.name).cast(f.dataType) for f in tables["geo_object"].schema.fields]))}
    same = sorted((r for r in spatial.same_geometry(t).collect() if r.occurrence > 9), key=lambda r: r.part)
    assert [len(r.object_ids) for r in same] == [262_144, 300_002 - 262_144] and {r.occurrence for r in same} == {300_002}
    report = sorted((r for r in spatial.validity_report(t).collect() if r.archive == "a1"), key=lambda r: r.part)
    ids = [int(x) for r in report for x in r.invalid_objects.split(",")]
    assert {r.invalid_count for r in report} == {len(ids)} and ids == sorted(ids) and len(ids) > 300_000
    region = sorted((r for r in spatial.objects_in_region(t, 4.0).collect() if r.archive == "a1" and r.objects_in_lan > 9),
                    key=lambda r: (r.lan or "", r.part))
    assert region and all(len([x for r in region if r.lan == lan for x in r.object_ids]) == n
                          for lan, n in {(r.lan, r.objects_in_lan) for r in region})


def test_feature_rows_of_a_large_group_have_their_own_numbers(spark, tables):
    values = spark.range(300_001).select(
        F.lit("a1").alias("archive"), (F.col("id") + 10_000).alias("AttributeValueId"), F.lit(1000).alias("AttributeId"),
        F.col("id").cast("string").alias("Value"), F.lit("cm").alias("Unit"))
    t = {**tables, "attribute_value": tables["attribute_value"].unionByName(values.select(
        *[F.col(f.name).cast(f.dataType) for f in tables["attribute_value"].schema.fields]))}
    rows = [r for r in features.features_table(t).where("intrasis_archive = 'a1'").select(
        "pk", "object_id", "part", F.length("attributes").alias("n")).collect()]
    assert sorted(r.pk for r in rows) == list(range(1, len(rows) + 1))
    assert {r.part for r in rows if r.object_id == 10} >= {0, 1}
    wide = features.geo_object_attribute_arrays(t).where("archive = 'a1'").select("row_number", "part").collect()
    assert sorted(r.row_number for r in wide) == list(range(1, len(wide) + 1))


def test_numbering_equals_row_number(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"),
        (F.col("id") % 700 * 50_000).alias("k"), F.col("id").alias("tie"))
    starts = start_numbers(df, "g", "k")
    got = number_rows(df, starts, "g", "k", ["tie"]).createOrReplaceTempView("numbered")
    assert got is None
    wrong = spark.sql("""SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY g
        ORDER BY k, tie) AS want FROM numbered) WHERE pk <> want""")
    assert wrong.count() == 0


def test_relations(tables):
    assert rows(relations.relations_layer(tables), "archive", "parent_id", "child_id") == [
        ("a1", 1, 11), ("a1", 20, 10), ("a1", 21, 10)]
    parents = {(r.archive, r.object_id): r.parent_relations
               for r in relations.parent_relations(tables).collect()}
    assert parents["a1", 1] == ["Skapar 10", "contains 11"]
    assert ("a2", 1) not in parents  # archive a2 defines no relations


def test_groups_layer(tables):
    got = rows(relations.groups_layer(tables), "archive", "group_id", "group_name",
               "converted_text")
    assert got == [("a1", 20, "group g", " group note")] or got == [
        ("a1", 20, "group g", "group note")]


def test_feature_core_takes_the_first_geometry(tables):
    loose = rows(features.feature_core(tables), "archive", "object_id", "geoobject_id", "class")
    assert loose == [("a1", 10, 100, "Object"), ("a1", 11, 104, "Object"),
                     ("a1", 12, None, None), ("a2", 10, 100, "Object"),
                     ("a3", 10, None, "Object")]
    strict = rows(features.feature_core(tables, strict=True), "archive", "object_id",
                  "geoobject_id")
    assert strict == [("a1", 10, 100), ("a1", 11, 104), ("a2", 10, 100)]


def test_notes_and_groups_multiply_features(tables):
    out = features.features_table(tables).where("object_id = 10 AND intrasis_archive = 'a1'")
    got = out.orderBy("pk").collect()
    # two notes, two groups
    assert [(r.pk, r.object_description, r.group_name) for r in got] == [
        (1, "first note", "group g"), (2, "first note", "group h"),
        (3, "second note", "group g"), (4, "second note", "group h")]
    assert {r.group_description for r in got if r.group_name == "group g"} == {"group note"}


def test_geo_object_view(tables):
    got = features.geo_object_attribute_arrays(tables).where("archive = 'a1'").orderBy(
        "row_number").collect()
    assert [(r.ObjectId, r.geo_object_id) for r in got] == [(10, 100), (10, 101), (11, 104)]
    assert got[0].attribute_info == [None, "Typ: no data", "Typ: Stolphål", "Typ: Stolphål",
                                     "Typ: no data", None]
    assert got[0].object_definition == ["c, description: no description, help: no info"]
    assert got[2].attribute_info == [None] and got[2].object_definition == [None]
    assert got[0].parent_relations == ["parent: 20, relationship type: in",
                                       "parent: 21, relationship type: in"]


def test_objects_with_many_notes_and_groups_are_joined_in_blocks(spark, tables, monkeypatch):
    """Notes × groups cut into blocks give the rows and numbers of the plain join, for objects with
    many notes, many groups, both, or neither, and where an object has two rows in the core."""
    def more(name, rows):
        return tables[name].union(spark.createDataFrame(rows, tables[name].schema))

    notes = [("a1", 3000 + i, 900, 10 if i < 7 else 11, "Note") for i in range(9)]
    groups = [("a1", 400 + i, 9, 52, 400 + i, f"group {i}", 1, None) for i in range(6)]
    links = [("a1", 400 + i, 10, 500) for i in range(5)] + [("a1", 400 + i, 12, 500) for i in range(6)]
    group_notes = [("a1", 3100 + i, 900, 400 + i % 2, "Note") for i in range(3)]
    t = {**tables, "attribute": more("attribute", notes + group_notes), "object": more("object", groups),
         "object_rel": more("object_rel", links),
         "free_text": more("free_text", [("a1", r[1], rf"{{\rtf1 \fs17 text {r[1]}\par }}") for r in notes + group_notes]),
         "definition": tables["definition"].union(tables["definition"].where("archive = 'a1' AND MetaId = 183"))}

    def result():
        rows = features.features_table(t).collect()
        return sorted((tuple(r) for r in rows), key=lambda r: (r[1], r[0]))

    plain = result()
    assert len([r for r in plain if r[2] == 10 and r[1] == "a1"]) == 2 * 9 * (2 + 6)  # two core rows, notes, groups
    for rows, stretch in ((1, 1), (3, 2), (3, 4), (20, 256)):
        monkeypatch.setattr(features, "BLOCK_ROWS", rows)
        monkeypatch.setattr(features, "STRETCH", stretch)
        assert result() == plain


def test_one_object_with_very_many_notes_is_spread_over_tasks(spark, tables):
    number = F.col("id").cast("int") + 100_000
    notes = spark.range(20_000).select(
        F.lit("a1").alias("archive"), number.alias("AttributeId"), F.lit(900).alias("MetaId"),
        F.lit(10).alias("ObjectId"), F.lit("Note").alias("Label"), F.lit(r"{\rtf1 \fs17 text\par }").alias("Text"))
    links = spark.range(10).select(
        F.lit("a1").alias("archive"), (F.col("id").cast("int") % 2 + 20).alias("ParentId"),
        F.lit(10).alias("ChildId"), F.lit(500).alias("MetaId"))
    t = {**tables, "attribute": tables["attribute"].unionByName(notes.drop("Text")),
         "free_text": tables["free_text"].unionByName(notes.select("archive", "AttributeId", "Text")),
         "object_rel": tables["object_rel"].unionByName(links)}
    rows = features.features_table(t).where("object_id = 10 AND intrasis_archive = 'a1'")
    held = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(held) == 20_002 * 12
    assert max(held) < 2 * sum(held) / 4  # four tasks
    assert rows.agg(F.min("pk"), F.max("pk"), F.count_distinct("pk")).first()[2] == 20_002 * 12


def test_lists_are_laid_out_by_their_keys_alone(spark, tables):
    lists = eav.attr_arrays(tables)
    spread = re.findall(r"hashpartitioning\(([^)]*)\)", lists._jdf.queryExecution().executedPlan().toString())
    assert spread and all(re.fullmatch(r"archive#\d+, object_id#\d+L, \d+", s) for s in spread), spread
    assert {r.part for r in lists.collect()} == {0}


def test_texts_of_links_are_made_for_the_wanted_objects_only(tables):
    every = relations.relation_items(tables)
    some = every.select("archive", "object_id").distinct().orderBy("archive", "object_id").limit(2)
    key = ["archive", "object_id", "kind", "member", "text"]
    want = sorted(tuple(r) for r in every.join(some, key[:2], "left_semi").select(*key).collect())
    assert sorted(tuple(r) for r in relations.relation_items(tables, of=some).select(*key).collect()) == want
    assert 0 < len(want) < every.count()


def test_numbered_rows_stay_where_they_are_for_their_bytes(tables):
    table = features.features_table(tables)
    plan = table._jdf.queryExecution().executedPlan().toString()
    # one layout of bytes by geometry, none of rows that hold lists and notes
    assert len(re.findall(r"Window \[row_number", plan)) == 1
    before_window = plan[:plan.index("Window [row_number")]
    assert "geoobject_id" not in "".join(re.findall(r"hashpartitioning\([^)]*\)", before_window))
    assert table.where(F.col("geom").isNotNull()).count() > 0
