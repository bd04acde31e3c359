"""The site extraction: result tables filled for the archives they lack."""

from __future__ import annotations

from pyspark.sql import DataFrame

from trowel.operators import counts, site
from trowel.session import read_if_there
from trowel.sinks.writers import insert_if_absent
from trowel.sources.pending import pending_by_except

A = "archive"

# Result table -> operator and key.
RESULTS = {
    "find_count": (counts.find_count, [A, "find_type"]),
    "geo_attribute_values": (counts.geo_attribute_values, ["value"]),
    "feature_count": (counts.feature_count, [A, "feature"]),
    "node_edge_count": (site.node_edge_count, [A]),
}


def restricted(t, archives: DataFrame) -> dict[str, DataFrame]:
    """The tables cut down to some archives; folders of the others are not read."""
    return {name: df.join(archives.select(A), A, "left_semi") if A in df.columns else df
            for name, df in t.items()}


def extract_sites(t, root: str, **summary_options) -> None:
    """One run over all archives without a site row yet, whatever their number."""
    spark = t["object"].sparkSession
    path = f"{root}/site_summary"
    todo = pending_by_except(site.archive_list(t), read_if_there(spark, path, f"{A} string"))
    open_tables = restricted(t, todo)
    for name, (operator, keys) in RESULTS.items():
        insert_if_absent(operator(open_tables), f"{root}/{name}", keys)
    # last, as this table says which archives are done
    insert_if_absent(site.site_summary(open_tables, **summary_options), path, [A, "part"])
