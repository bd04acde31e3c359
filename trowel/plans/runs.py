"""Whole runs over the archives a step is still open for; a second run changes nothing.

Each run takes the pending archives at once, stores its result per archive and records the
step in the manifest.  A batch that fails is tried again in halves, so that one bad archive
keeps none of the others from being done and costs a few attempts more, not one for each archive.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trowel.functions.text import clean_text
from trowel.operators import counts, reproject, site, spatial
from trowel.plans.extraction import restricted
from trowel.plans.features import features_csv
from trowel.schema import CORE_TABLES, TARGET_SRID
from trowel.session import read_if_there, stored
from trowel.sinks import writers
from trowel.sources.pending import pending_archives

A = "archive"


def run_step(t, manifest_path: str, step: str, version: int,
             work: Callable[[dict[str, DataFrame]], None]) -> dict[str, list[str]]:
    """Do ``work`` for the archives whose step is open: {status: archive names}.

    ``work`` gets the tables cut down to those archives and must replace what it stored for
    them before, so that a run that broke off can be repeated.
    """
    spark = t["object"].sparkSession
    manifest = read_if_there(spark, manifest_path, CORE_TABLES["manifest"])
    todo = stored(pending_archives(site.archive_names(t), manifest, step, version), "todo")
    names = [r[0] for r in todo.orderBy(A).collect()]  # names of archives, not their rows
    outcome: dict[str, list[str]] = {"done": [], "failed": []}

    def attempt(archives: DataFrame) -> str | None:
        try:
            work(restricted(t, archives))
        except Exception as problem:  # whatever an archive holds: recorded, not hidden
            return str(problem)[:1000]
        return None

    batches = [names] if names else []
    while batches:
        batch = batches.pop()
        part = todo.where(F.col(A).between(batch[0], batch[-1]))  # names stand in order
        problem = attempt(part)
        if problem is not None and len(batch) > 1:
            batches += [batch[len(batch) // 2:], batch[:len(batch) // 2]]
            continue
        status = "done" if problem is None else "failed"
        writers.update_status(part, manifest_path, step, status, version, problem)
        outcome[status] += batch
    return outcome


def export_csv(t, path: str, manifest_path: str, version: int = 1, **summary_options):
    """The flat feature export with the site columns, a folder of CSV files per archive."""
    def work(tables):
        sites = stored(site.site_summary(tables, **summary_options), "sites")
        rows = features_csv(tables, sites.where(F.col("part") == 0), site.unnest_site_attributes(sites))
        writers.write_csv(rows.withColumnRenamed("intrasis_archive", A), path, replace_archives=True)

    return run_step(t, manifest_path, "csv", version, work)


def clean_notes(t, path: str, manifest_path: str, version: int = 1):
    """The notes with their cleaned text stored as ``converted_text``, in the place of
    ``free_text``: `object_texts` then takes the stored text."""
    def work(tables):
        # cleaned behind the shuffle, which then carries one text for each note
        writers.overwrite_archives(tables["free_text"], path, lambda rows: rows.withColumn(
            "converted_text", clean_text(F.col("Text"))))

    return run_step(t, manifest_path, "clean_text", version, work)


def check_validity(t, path: str, manifest_path: str, version: int = 1):
    """How many geometries of each archive are invalid, and which."""
    return run_step(t, manifest_path, "validity", version, lambda tables: writers.overwrite_archives(
        spatial.validity_report(tables), path))


def move_to_target(t, path: str, manifest_path: str, version: int = 1, srids: DataFrame | None = None):
    """The geometries in the target system, in the place of ``geo_object``."""
    def work(tables):
        own = reproject.likely_srid(tables) if srids is None else srids
        writers.overwrite_archives(reproject.reproject(tables, own, TARGET_SRID), path)

    return run_step(t, manifest_path, "reproject", version, work)


def regions(t, path: str, manifest_path: str, version: int = 1, cell: float = 1000.0):
    """Objects per region, and the error rows of geometries that cannot be read."""
    def work(tables):
        good, bad = spatial.error_rows(tables)
        placed = spatial.objects_in_region({**tables, "geo_object": good}, cell, shapes=tables["geo_object"])
        writers.overwrite_archives(placed, f"{path}/regions")
        writers.overwrite_archives(bad, f"{path}/errors")

    return run_step(t, manifest_path, "regions", version, work)


def compare_geometries(t, path: str) -> None:
    """Geometries over all archives with those they meet, renewed as archives come or change.

    Below ``path`` are kept: ``occurrences`` (geometry and archive), ``pairs`` (geometries that
    meet), and the results ``same_geometry`` and ``geometry_intersects``. The archives of ``t``
    replace what was known of them. Only geometries that are new look for partners, and only keys
    that such an archive holds or held, and their partners, are written anew; so runs over parts
    give what one run over all gives, and a run that broke off can be repeated. A geometry that no
    archive holds any more stays with an empty list of archives and of partners.
    """
    spark = t["geo_object"].sparkSession
    new = stored(spatial.occurrences(t), "occurrences")
    known = read_if_there(spark, f"{path}/occurrences", new.schema)
    held = known.join(new.select(A).distinct(), A, "left_semi")
    touched = stored(new.select("pk").union(held.select("pk")).distinct(), "touched")
    every = known.join(new.select(A).distinct(), A, "left_anti").unionByName(new)
    groups = spatial.grouped_geometries(every.join(touched, "pk", "left_semi"))
    none = F.array().cast("array<string>")
    groups = stored(touched.join(groups, "pk", "left").select(
        F.coalesce("databases", none).alias("databases"), F.coalesce("db_occurrence", F.lit(0)).alias("db_occurrence"),
        "the_geom", "srid", "pk"), "groups")
    there = F.col("db_occurrence") > 0
    before = read_if_there(spark, f"{path}/same_geometry", groups.schema).where(there)
    fresh = stored(groups.where(there).join(before, "pk", "left_anti").select("pk"), "fresh")
    writers.replace_keys(groups, f"{path}/same_geometry", touched, "pk")
    now = spark.read.schema(groups.schema).parquet(f"{path}/same_geometry").where(there)
    writers.insert_if_absent(spatial.geometry_pairs(now, fresh), f"{path}/pairs", ["pk", "other"])
    pairs = spark.read.parquet(f"{path}/pairs")
    renewed = stored(touched.union(pairs.join(touched, "pk", "left_semi").select("other")).distinct(), "renewed")
    lists = spatial.partner_lists(now, pairs.join(renewed, "pk", "left_semi"))
    stored_lists = read_if_there(spark, f"{path}/geometry_intersects", lists.schema)
    lists = stored(lists, "lists")
    alone = stored_lists.where("part = 0").join(renewed, "pk", "left_semi").join(lists, "pk", "left_anti").select(*[
        none.alias(c) if c in ("databases", "intersect_pk", "intersect_dbs") else F.col(c) for c in lists.columns])
    writers.replace_keys(lists.unionByName(alone), f"{path}/geometry_intersects", renewed, "pk")
    writers.overwrite_archives(new, f"{path}/occurrences")


def judge_values(values: DataFrame, key: str = "pk", **options) -> DataFrame:
    """Values with their status, word and distance written back from the two operators."""
    wide = values
    for name, kind in (("extraction_status", "string"), ("distance", "int"), ("word", "string")):
        if name not in wide.columns:
            wide = wide.withColumn(name, F.lit(None).cast(kind))
    status = counts.value_status(values.select(key, "value")).select(key, "extraction_status")
    wide = writers.update_from(wide, status, [key], ["extraction_status"])
    return writers.update_from(wide, counts.keyword_distance(values, key=key, **options), [key],
                               ["distance", "word"])
