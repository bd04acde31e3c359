"""The layer export: five layers of every open archive, shown together or not at all."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from trowel.operators import eav, relations, site
from trowel.plans.features import features_table
from trowel.plans.runs import run_step
from trowel.schema import TARGET_SRID
from trowel.sinks import writers

A = "archive"


def layers(t, archives: DataFrame | None = None) -> dict[str, Callable[[], DataFrame]]:
    """The layers by name, each planned when called for.

    ``archives`` is the stored site table; without it the project layer holds the site
    names and fields only.
    """

    def project_information():
        about = site.site_summary(t, with_place=False) if archives is None else archives
        return site.project_information(about, site.unnest_site_attributes(about))

    return {
        "features": lambda: features_table(t).withColumnRenamed("intrasis_archive", A),
        "project_information": project_information,
        "object_relations": lambda: relations.relations_layer(t),
        "groups": lambda: relations.groups_layer(t),
        "attributes": lambda: eav.attributes_layer(t),
    }


def export_layers(t, path: str, manifest_path: str, version: int,
                  archives: DataFrame | None = None) -> dict[str, list[str]]:
    """Write all layers of the archives that lack this version: {status: archive names}.

    The files of an attempt lie in folders of their own and count for nobody until all five layers
    are written; then one row for each archive makes them its layers, in the place of older ones.
    So a run that breaks off shows nothing half, and a bad archive fails alone, with the name of
    the layer in the manifest. `read_layers` reads what is published.
    """
    def work(tables):
        run = f"r{uuid.uuid4().hex}"
        names = site.archive_names(tables)
        about = None if archives is None else archives.join(names, A, "left_semi")
        for name, layer in layers(tables, about).items():
            try:
                writers.write_layers({name: layer()}, path, TARGET_SRID, run=run)
            except Exception as problem:
                raise RuntimeError(f"layer {name}: {problem}") from problem
        writers.publish(names, path, run)

    return run_step(t, manifest_path, "layers", version, work)
