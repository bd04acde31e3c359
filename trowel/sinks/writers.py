"""Files, layers and result tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from trowel.session import read_if_there, stored

A = "archive"
NULL_ITEM = "∅"


def joined_lists(df: DataFrame, mark: str = "|") -> DataFrame:
    """List columns as text, for formats without lists. A mark, backslash or sign for a missing
    item that a member holds has a backslash before it."""
    out = df
    for field in df.schema:
        if isinstance(field.dataType, ArrayType):
            signs = "[" + "".join(f"\\{c}" for c in (mark, "\\", NULL_ITEM)) + "]"
            items = F.transform(F.col(f"`{field.name}`"), lambda x: F.coalesce(
                F.regexp_replace(x.cast("string"), f"({signs})", r"\\$1"), F.lit(NULL_ITEM)))
            out = out.withColumn(field.name, F.array_join(items, mark))
    return out


def clustered(df: DataFrame) -> DataFrame:
    """Laid out by archive, so that an archive's rows come from few tasks, and a large archive's from
    several: files follow the data, not tasks times archives. Ranges would have to be found first,
    by computing the rows once more; here adaptive execution cuts what was shuffled."""
    return df.hint("rebalance", A if A in df.columns else "intrasis_archive")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", replace_archives: bool = False) -> None:
    """One folder of CSV files per archive; ``replace_archives`` leaves those alone that the
    rows don't name."""
    (clustered(joined_lists(df)).write.mode(mode).partitionBy(A)
     .option("partitionOverwriteMode", "dynamic" if replace_archives else "static")
     .option("header", True).option("quote", '"').option("escape", '"')
     .option("nullValue", "").option("emptyValue", '""').csv(path))


def write_json_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines per archive, with the schema in a file beside them."""
    df.write.mode(mode).partitionBy(A).json(f"{path}/data")
    schema = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
    schema.coalesce(1).write.mode(mode).text(f"{path}/schema")


def write_layers(layers: dict[str, DataFrame], path: str, srid: int, mode: str = "overwrite",
                 run: str | None = None):
    """Layers as parquet below ``layer=name/archive=name``; the SRID is column metadata.

    An archive without rows in a layer gets no folder there. With ``run`` the files lie in a folder
    of that name and are not read before `publish` names the run for their archive.
    """
    below = f"/run={run}" if run else ""
    for name, layer in layers.items():
        for column in ("geom", "wkb"):
            if column in layer.columns:
                layer = layer.withMetadata(column, {"srid": srid, "encoding": "WKB"})
        clustered(layer).write.mode(mode).partitionBy(A).parquet(f"{path}/layer={name}{below}")


PUBLISHED = "archive string, run string, at timestamp"


def publish(archives: DataFrame, path: str, run: str) -> None:
    """Make the files of a run the layers of some archives. An archive is one row, so it is
    published whole or not at all."""
    archives.select(A, F.lit(run).alias("run"), F.current_timestamp().alias("at")).write.mode(
        "append").parquet(f"{path}/published")


def create_features_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Create a table from a query unless it exists, partitioned by archive."""
    key = A if A in df.columns else "intrasis_archive"
    writer = clustered(df).write.mode("ignore").partitionBy(key).format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def overwrite_archives(df: DataFrame, path: str, finish: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
    """Replace only the archives present in ``df``; ``finish`` adds what is dear to compute, row by
    row, once the rows lie where they are written."""
    (finish(clustered(df)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(A).parquet(path))


def new_rows(rows: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows to insert where a key does nothing if present; a NULL key never conflicts."""
    complete = F.lit(True)
    for key in keys:
        complete = complete & F.col(key).isNotNull()
    first = rows.where(complete).dropDuplicates(keys).join(
        existing.select(*keys), keys, "left_anti").select(rows.columns)
    return first.unionByName(rows.where(~complete))


def insert_if_absent(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Append rows whose key is not in the result table yet."""
    existing = read_if_there(rows.sparkSession, path, rows.schema)
    new_rows(rows, existing, keys).write.mode("append").parquet(path)


BUCKETS = 64


def replace_keys(rows: DataFrame, path: str, keys: DataFrame, key: str) -> None:
    """Put ``rows`` in the place of all stored rows with a key in ``keys``. The table lies in
    folders by a bucket of the key, and only the folders of those keys are written again, each in
    one go. Every key in ``keys`` needs a row, or its bucket others, to be taken out."""
    spark, bucket = rows.sparkSession, F.pmod(F.crc32(F.col(key)), F.lit(BUCKETS)).cast("int").alias("bucket")
    added = rows.select("*", bucket)
    old = read_if_there(spark, path, added.schema)
    buckets = keys.select(bucket).distinct()  # at most BUCKETS rows
    kept = old.join(F.broadcast(buckets), "bucket", "left_semi").join(keys, key, "left_anti")
    whole = stored(kept.select(added.columns).unionByName(added), "replaced")
    (whole.hint("rebalance", "bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path))


def update_from(target: DataFrame, source: DataFrame, keys: list[str],
                columns: list[str]) -> DataFrame:
    """Target rows with columns taken from the matching source row, if there is one.

    Of several source rows of a key the one with the least values is taken.
    """
    packed = F.struct(*columns)
    one = source.groupBy(*keys).agg(F.min(packed).alias("_new"))
    joined = target.join(one, keys, "left")
    return joined.select(*[
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c)
        if c in columns else F.col(c) for c in target.columns])


def status_rows(archives: DataFrame, step: str, status: str, version: int | None = None,
                message: str | None = None) -> DataFrame:
    """Manifest rows for some archives, stamped now."""
    return archives.select(
        A, F.lit(step).alias("step"), F.lit(version).cast("int").alias("version"),
        F.lit(status).alias("status"), F.lit(message).cast("string").alias("message"),
        F.current_timestamp().alias("updated_at"))


def update_status(archives: DataFrame, manifest_path: str, step: str, status: str,
                  version: int | None = None, message: str | None = None) -> None:
    """Append to the manifest; the latest row of a step counts."""
    status_rows(archives, step, status, version, message).write.mode("append").parquet(
        manifest_path)


def export_blobs(blobs: DataFrame, folder: str, suffix: str = "bin") -> DataFrame:
    """Write every stored file below ``folder/archive`` and list what was written.

    ``folder`` must be mounted on the executors.  A file is written under a passing name
    and then renamed, so a repeated task leaves no half file.
    """
    if "://" in folder:
        raise ValueError(f"{folder} is no mounted folder: files are written with plain file calls")
    schema = "archive string, attribute_id bigint, path string, bytes bigint"

    def save(frames):
        import os
        import uuid

        import pandas as pd
        for frame in frames:
            done = []
            for archive, number, data in zip(frame.archive, frame.AttributeId, frame.Value):
                os.makedirs(os.path.join(folder, archive), exist_ok=True)
                path = os.path.join(folder, archive, f"{number}.{suffix}")
                passing = f"{path}.{uuid.uuid4().hex}"
                with open(passing, "wb") as out:
                    out.write(data)
                os.replace(passing, path)
                done.append((archive, number, path, len(data)))
            yield pd.DataFrame(done, columns=["archive", "attribute_id", "path", "bytes"])

    wanted = blobs.where(F.col("Value").isNotNull()).select(A, "AttributeId", "Value")
    return wanted.mapInPandas(save, schema)


def write_table_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
                     **options: str) -> None:
    df.write.format("jdbc").mode(mode).options(**options).option("url", url).option(
        "dbtable", table).save()


def read_layers(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """A layer of all archives; of one written in runs, each archive's run published last."""
    folder = f"{path}/layer={layer}"
    # names of archives that look like numbers stay text
    schema = spark.read.parquet(folder).schema
    rows = spark.read.schema(StructType([
        StructField(f.name, StringType(), f.nullable, f.metadata) if f.name in (A, "run") else f
        for f in schema])).parquet(folder)
    if "run" not in schema.names:
        return rows
    last = read_if_there(spark, f"{path}/published", PUBLISHED).groupBy(A).agg(
        F.max_by("run", F.struct("at", "run")).alias("run"))
    return rows.join(last, [A, "run"], "left_semi").drop("run")
