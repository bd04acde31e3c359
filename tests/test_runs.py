from pyspark.sql import functions as F

from trowel.operators import eav, relations
from trowel.plans import extraction, layers, runs
from trowel.sinks import writers
from trowel.sources import pending


NAMES = ("features", "project_information", "object_relations", "groups", "attributes")


def layer_rows(spark, path, names=NAMES):
    """Rows of each layer and archive."""
    return {(name, r.archive): r["count"] for name in names
            for r in writers.read_layers(spark, path, name).groupBy("archive").count().collect()}


def test_layers_of_pending_archives_only(spark, tables, tmp_path):
    path, manifest = str(tmp_path / "out"), str(tmp_path / "manifest")
    first = {n: df.where("archive <> 'a2'") if "archive" in df.columns else df for n, df in tables.items()}
    assert layers.export_layers(first, path, manifest, 10) == {"done": ["a1", "a3"], "failed": []}
    assert layers.export_layers(tables, path, manifest, 10) == {"done": ["a2"], "failed": []}
    assert layers.export_layers(tables, path, manifest, 10) == {"done": [], "failed": []}
    assert len(list((tmp_path / "out" / "layer=features").glob("run=*"))) == 2
    parts = layer_rows(spark, path)
    whole = str(tmp_path / "whole")
    layers.export_layers(tables, whole, str(tmp_path / "manifest2"), 10)
    assert parts == layer_rows(spark, whole) and len({a for _, a in parts}) > 1
    assert writers.read_layers(spark, path, "features").schema["geom"].metadata["srid"] == 3006


LINKS = ("object_relations", "attributes")


def two_layers(t, archives=None):
    return {"object_relations": lambda: relations.relations_layer(t), "attributes": lambda: eav.attributes_layer(t)}


def test_a_run_that_breaks_off_shows_nothing_half(spark, tables, tmp_path, monkeypatch):
    path, manifest = str(tmp_path / "out"), str(tmp_path / "manifest")
    monkeypatch.setattr(layers, "layers", two_layers)
    layers.export_layers(tables, path, manifest, 10)
    before, write = layer_rows(spark, path, LINKS), writers.write_layers

    class Killed(BaseException):
        pass

    def broken(named, *args, **options):
        if "attributes" in named:
            raise Killed
        write(named, *args, **options)

    monkeypatch.setattr(writers, "write_layers", broken)
    changed = {**tables, "object_rel": tables["object_rel"].limit(0)}
    try:
        layers.export_layers(changed, path, manifest, 11)
    except Killed:
        pass
    assert layer_rows(spark, path, LINKS) == before
    monkeypatch.setattr(writers, "write_layers", write)
    assert layers.export_layers(changed, path, manifest, 11)["done"] == ["a1", "a2", "a3"]
    # a new version takes the place of the old one
    assert layer_rows(spark, path, LINKS) == {k: n for k, n in before.items() if k[0] == "attributes"} != before


def test_a_bad_layer_fails_its_archive_alone(spark, tables, tmp_path, monkeypatch):
    path, manifest, write = str(tmp_path / "out"), str(tmp_path / "manifest"), writers.write_layers
    monkeypatch.setattr(layers, "layers", two_layers)

    def picky(named, *args, **options):
        for name, rows in named.items():
            if name == "attributes" and rows.where("archive = 'a2'").count():
                raise ValueError("bad value")
        write(named, *args, **options)

    monkeypatch.setattr(writers, "write_layers", picky)
    outcome = layers.export_layers(tables, path, manifest, 10)
    assert sorted(outcome["done"]) == ["a1", "a3"] and outcome["failed"] == ["a2"]
    failed = pending.latest_status(spark.read.parquet(manifest)).where("status = 'failed'").collect()
    assert [(r.archive, r.step) for r in failed] == [("a2", "layers")]
    assert failed[0].message.startswith("layer attributes: bad value")
    assert "a2" not in {a for _, a in layer_rows(spark, path, LINKS)}


def test_extraction_twice_changes_nothing(spark, tables, tmp_path):
    root = str(tmp_path)
    first = {n: df.where("archive <> 'a2'") if "archive" in df.columns else df
             for n, df in tables.items()}

    def sizes():
        return {n: spark.read.parquet(f"{root}/{n}").count()
                for n in (*extraction.RESULTS, "site_summary")}

    extraction.extract_sites(first, root, with_place=False)
    before = sizes()
    assert before["site_summary"] == 1  # a3 has no project object
    extraction.extract_sites(first, root, with_place=False)
    assert sizes() == before
    extraction.extract_sites(tables, root, with_place=False)
    after = sizes()
    assert after["site_summary"] == 2 and after["find_count"] == before["find_count"] + 1
    rows = spark.read.parquet(f"{root}/find_count").where(F.col("archive") == "a2").collect()
    assert [(r.find_type, r.find_count) for r in rows] == [("grop", 1)]


def test_runs_take_pending_archives_and_change_nothing_twice(spark, tables, tmp_path):
    root, manifest = str(tmp_path), str(tmp_path / "manifest")
    first = {n: df.where("archive <> 'a2'") if "archive" in df.columns else df for n, df in tables.items()}
    steps = {
        "notes": lambda t: runs.clean_notes(t, f"{root}/free_text", manifest),
        "validity": lambda t: runs.check_validity(t, f"{root}/validity", manifest),
        "moved": lambda t: runs.move_to_target(t, f"{root}/moved", manifest),
        "csv": lambda t: runs.export_csv(t, f"{root}/csv", manifest, with_place=False),
        "regions": lambda t: runs.regions(t, f"{root}/regions", manifest, cell=7.0),
    }
    for run in steps.values():
        assert run(first) == {"done": ["a1", "a3"], "failed": []}
        assert run(first) == {"done": [], "failed": []}
        assert run(tables) == {"done": ["a2"], "failed": []}
    assert spark.read.parquet(f"{root}/validity").count() == 3
    notes = spark.read.parquet(f"{root}/free_text").collect()
    assert {r.converted_text for r in notes} == {"first note", "second note", "group note"}
    stored_text = {**tables, "free_text": spark.read.parquet(f"{root}/free_text").withColumn("Text", F.lit("gone"))}
    assert {r.description for r in relations.object_texts(stored_text).collect()} == {"first note", "second note", "group note"}
    assert spark.read.parquet(f"{root}/moved").count() == tables["geo_object"].count()
    assert {r.archive for r in spark.read.option("header", True).csv(f"{root}/csv").select("archive").distinct().collect()} == {"a1", "a2"}
    assert spark.read.parquet(f"{root}/regions/regions").select("archive").distinct().count() == 2


def test_one_bad_archive_fails_alone(spark, tables, tmp_path):
    def work(t):
        if t["object"].where("archive = 'a2'").count():
            raise ValueError("bad archive")

    manifest = str(tmp_path / "manifest")
    assert runs.run_step(tables, manifest, "s", 1, work) == {"done": ["a1", "a3"], "failed": ["a2"]}
    assert runs.run_step(tables, manifest, "s", 1, lambda t: None) == {"done": ["a2"], "failed": []}


def test_geometries_are_compared_once(spark, tables, tmp_path):
    for _ in range(2):
        runs.compare_geometries(tables, str(tmp_path))
        same = spark.read.parquet(f"{tmp_path}/same_geometry")
        assert same.count() == same.select("pk").distinct().count() == 6


def test_values_are_judged(spark):
    values = spark.createDataFrame([(1, "Stolphål"), (2, "grop"), (3, None)], "pk int, value string")
    got = {r.pk: r for r in runs.judge_values(values).collect()}
    assert got[1].distance == 0 and got[1].word == "Stolphål" and got[1].extraction_status.startswith("1.")
    assert got[2].extraction_status.startswith("0.") and got[3].distance is None


def test_compared_geometries_in_parts_are_those_of_all_at_once(spark, tmp_path):
    from tests.small import box, point
    rows = [("a", 1, box(0, 0, 5, 5)), ("a", 2, point(1, 1)), ("a", 3, point(9, 9)), ("b", 1, box(0, 0, 5, 5)),
            ("b", 2, box(4, 4, 10, 10)), ("b", 3, None), ("c", 1, point(9, 9)), ("c", 2, point(50, 50)), ("c", 3, point(1, 1))]
    all_rows = spark.createDataFrame([(a, i, w, 3006) for a, i, w in rows], "archive string, ObjectId bigint, wkb binary, srid int")

    def compared(path, *parts):
        for part in parts:
            runs.compare_geometries({"geo_object": all_rows.where(F.col("archive").isin(*part))}, path)
        same = spark.read.parquet(f"{path}/same_geometry").where("db_occurrence > 0")
        met = spark.read.parquet(f"{path}/geometry_intersects").where("intersect_pk is not null and size(intersect_pk) > 0")
        return (sorted((r.pk, tuple(r.databases), r.db_occurrence, r.srid) for r in same.collect()),
                sorted((r.pk, tuple(r.databases), r.part, tuple(r.intersect_pk), tuple(r.intersect_dbs)) for r in met.collect()))

    once = compared(str(tmp_path / "once"), "abc")
    assert len(once[0]) == 6 and len(once[1]) == 4
    path = str(tmp_path / "parts")
    assert compared(path, "a", "bc") == once
    # an archive that changes takes what it held along: b keeps one geometry, that of nobody else
    moved = spark.createDataFrame([("b", 8, point(1, 2), 3006)], all_rows.schema)
    runs.compare_geometries({"geo_object": moved}, path)
    same, met = compared(path)
    assert sorted(r[1] for r in same) == [("a",), ("a", "c"), ("a", "c"), ("b",), ("c",)]
    assert sorted((r[1], sorted(r[4])) for r in met) == [(("a",), ["a,c", "b"]), (("a", "c"), ["a"]), (("b",), ["a"])]


def test_notes_stay_in_place_and_only_those_asked_for_come(spark, tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        every = relations.object_texts(tables)
        plan = every._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = every.collect()
    assert len({r.object_id for r in rows}) > 1
    one = spark.createDataFrame([rows[0][:2]] * 2, "archive string, object_id bigint")
    got = relations.object_texts(tables, of=one).collect()
    assert sorted(got) == sorted(r for r in rows if r[:2] == rows[0][:2])
    assert len(relations.object_texts(tables, keep_unowned=True).collect()) >= len(rows)
