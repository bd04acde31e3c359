"""Incremental runs: new files of a core table are worked off once, results kept unique."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from trowel.schema import CORE_TABLES
from trowel.sinks.writers import overwrite_archives


A = "archive"


def run_incremental(spark: SparkSession, source: str, table: str,
                    operator: Callable[[dict[str, DataFrame]], DataFrame],
                    target: str, checkpoint: str) -> None:
    """Renew an operator's result for the archives of the files that arrived since the last run.

    Every run takes what is there and stops.  An archive that a batch touches is computed anew
    from all its rows in the source, and its result replaced: rows that come in a later file
    count like those of the first, and a batch repeated after a failure changes nothing.
    """
    schema = StructType.fromDDL(CORE_TABLES[table])
    arrived = spark.readStream.schema(schema).parquet(source)

    def work(batch: DataFrame, _: int) -> None:
        touched = batch.select(A).distinct()
        whole = spark.read.schema(schema).parquet(source).join(touched, A, "left_semi")
        overwrite_archives(operator({table: whole}), target)

    query = (arrived.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
