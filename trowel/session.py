"""Session settings and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "trowel", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution and UTC times; further settings by keyword."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of the cluster; a temporary one only on a local master."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    folder = os.path.join(tempfile.gettempdir(), f"trowel-{os.getuid()}-{os.getpid()}")
    os.makedirs(folder, exist_ok=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below the shared folder."""
    return f"{scratch_root(spark)}/trowel/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_root(spark))
    return df.checkpoint()


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: columns can be pruned, and what
    reads them twice does not compute them twice."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema) -> DataFrame:
    """The stored rows; none before the first run has written any."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


BROADCAST_BYTES = 64 * 1024 * 1024


def broadcast_if_small(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The rows, stored once and measured; marked for broadcast if they are small enough.

    Larger ones stay as they are: the join then shuffles, with skew handled at run time.
    Meant for tables of one row per archive and for reference layers, whose other side
    would otherwise be shuffled whole.
    """
    df = cut_lineage(df)
    text = F.length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    size = df.agg(F.sum(text.cast("bigint"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def attached(wide: DataFrame, narrow: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``wide.join(narrow, keys, how)`` for few wide rows and a long narrow table: only the narrow
    rows that have a wide one are kept, and while they are few the wide rows stay where they are."""
    wanted = wide.select(*keys).distinct()
    return wide.join(broadcast_if_small(narrow.join(wanted, keys, "left_semi")), keys, how)
