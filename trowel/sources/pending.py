"""Which archives still need a step: the manifest keeps every outcome, the latest counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

A = "archive"


def latest_status(manifest: DataFrame) -> DataFrame:
    """The last row of every archive and step."""
    last = F.max_by(F.struct("version", "status", "message"), "updated_at")
    return manifest.groupBy(A, "step").agg(last.alias("last"),
                                           F.max("updated_at").alias("updated_at")).select(
        A, "step", "last.*", "updated_at")


def pending_archives(archives: DataFrame, manifest: DataFrame, step: str,
                     version: int | None = None, limit: int | None = None) -> DataFrame:
    """Archives whose step is not done, or only in an older version; by name."""
    done = (F.col("step") == step) & (F.col("status") == "done")
    if version is not None:
        done = done & (F.col("version") >= version)
    finished = latest_status(manifest).where(done).select(A)
    out = archives.select(A).join(finished, A, "left_anti").orderBy(A)
    return out.limit(limit) if limit is not None else out


def pending_by_except(archives: DataFrame, processed: DataFrame) -> DataFrame:
    return archives.select(A).subtract(processed.select(A))


def pending_by_output(archives: DataFrame, output: DataFrame) -> DataFrame:
    """Archives without rows in an output that was read back."""
    return archives.select(A).join(output.select(A).distinct(), A, "left_anti")
