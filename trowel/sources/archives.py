"""The archive store: core tables as parquet, large ones with a folder per archive."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trowel.schema import CORE_TABLES
from trowel.session import scratch_path
from trowel.sources.testdata import TestTables

# The id a table is laid out by: rows that are joined together lie together.
LAYOUT = {
    "object": "ObjectId", "geo_object": "ObjectId", "geo_rel": "ObjectId",
    "attribute": "AttributeId", "attribute_value": "AttributeId", "free_text": "AttributeId",
    "binary_value": "AttributeId", "object_rel": "ParentId", "event": "ObjectId",
}


# Columns that a run may have added to a table in the store; NULL where it has not.
STORED_COLUMNS = {"free_text": ", converted_text STRING"}


def write_table(df: DataFrame, root: str, name: str) -> None:
    """Write one core table; ranges of (archive, id) spread a large archive over tasks.

    Dictionaries are small: they are written as they come.
    """
    path = f"{root}/{name}"
    if name in LAYOUT:
        df = df.repartitionByRange("archive", LAYOUT[name])
        df.write.mode("overwrite").partitionBy("archive").parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One core table; a filter on ``archive`` reads only that archive's folders."""
    schema = StructType.fromDDL(CORE_TABLES[name] + STORED_COLUMNS.get(name, ""))
    return spark.read.schema(schema).parquet(f"{root}/{name}").select(schema.names)


def read_archives(spark: SparkSession, root: str,
                  names: Iterable[str] = tuple(CORE_TABLES)) -> dict[str, DataFrame]:
    """The store's tables by name: all archives at once, in place of a loop over them."""
    return {name: read_table(spark, root, name) for name in names}


def read_table_jdbc(spark: SparkSession, url: str, table: str, column: str, lower: int,
                    upper: int, partitions: int, archive: str, **options: str) -> DataFrame:
    """A table of one archive's database, read in parallel over ranges of an id."""
    return (spark.read.format("jdbc").options(**options)
            .option("url", url).option("dbtable", table).option("partitionColumn", column)
            .option("lowerBound", lower).option("upperBound", upper)
            .option("numPartitions", partitions).load()
            .withColumn("archive", F.lit(archive)))


def read_reference_layer(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A polygon layer: its columns and the geometry."""
    return spark.read.parquet(path).select(*columns, "wkb", "srid").where(
        F.col("wkb").isNotNull())


class StoredTables(dict):
    """Core tables derived from test tables, written to a store when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        super().__init__()
        self.spark, self.source = spark, TestTables(spark, folder)
        self.root = scratch_path(spark, "store")

    def __missing__(self, name: str) -> DataFrame:
        write_table(self.source[name], self.root, name)
        self[name] = read_table(self.spark, self.root, name)
        return self[name]


_STORES: dict[tuple[str, str], StoredTables] = {}


def stored_tables(spark: SparkSession, folder: str) -> StoredTables:
    """The store of a test folder, shared by the queries of one application."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _STORES:
        _STORES[key] = StoredTables(spark, folder)
    return _STORES[key]
