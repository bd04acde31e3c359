"""What the operators share: stored tables, row keys, held-out folds, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trowel.session import scratch_path


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read again: later steps read the files, so
    neither a lost executor nor a second use computes them anew."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as the empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "utf-8")) % folds


def sha256_hex(text: Column) -> Column:
    return F.sha2(F.encode(text, "utf-8"), 256)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them until no column of ``df`` is called so."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def ranked(rows: DataFrame, keys: list[str], order: list[str], rank_col: str = "rank",
           size_col: str = "size") -> DataFrame:
    """The rows with their place from 0 among those of equal keys, by ``order`` (nulls first), and
    the number of these; equal rows come in any order, a null key is a key of its own.

    Sorted by ranges of keys, order and a row number, so that a key or a tie with any share of
    the rows is spread over tasks. Each task's rows then start where those of the tasks before it
    end: a table of one row for each task and key, and a task's rows are the most a join key has.
    """
    row, at, task, first, n, before = free_names(
        rows, "row", "at", "task", "first", "n", "before")
    own = [f"{task}_{k}" for k in keys]
    numbered = stored(rows.withColumn(row, F.monotonically_increasing_id()), "unranked")
    by = [*keys, *order, row]
    laid = stored(numbered.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(
        at, F.monotonically_increasing_id()), "sorted").withColumn(task, F.shiftright(at, 33))
    runs = stored(laid.groupBy(task, *keys).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(n)), "runs")
    whole = Window.partitionBy(*keys)
    earlier = whole.orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        F.col(task).alias(f"{task}_of"), *[F.col(k).alias(o) for k, o in zip(keys, own)], first,
        F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(before), F.sum(n).over(whole).alias(size_col))
    same = F.col(task) == F.col(f"{task}_of")
    for key, other in zip(keys, own):
        same = same & F.col(key).eqNullSafe(F.col(other))
    return laid.join(starts, same).withColumn(rank_col, F.col(at) - F.col(first) + F.col(before)).drop(
        row, at, task, first, before, f"{task}_of", *own)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (a, b) with a > b.

    Large: every neighbour above u is tied to the least of u and its neighbours.
    Small: u and its neighbours below u are tied to the least of them.
    """
    if large:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
            edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        sides = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    least = stored(sides.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("w"), F.least("u", "m").alias("m")), "least")
    tied = sides.join(least, F.col("u") == F.col("w")).where(F.col("v") != F.col("m"))
    if large:
        tied = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
        # the edge to the least itself stays where it led downwards
        return tied.union(least.where(F.col("w") > F.col("m")).select("w", "m")).distinct()
    return tied.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
        least.select("w", "m")).distinct()


def components(links: DataFrame) -> DataFrame:
    """Connected components of links (a, b) of longs: rows (node, root), root being the
    smallest node reachable. Nodes without a link to another node are not in it.

    Star contraction: each round ties neighbourhoods to their least node, until nothing
    changes; the rounds grow with the logarithm of the longest path. Nothing but a count and a
    checksum of the edges comes to the driver. A node with very many links is a skewed join
    key on one side only, which adaptive execution splits.
    """
    edges = stored(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == mark:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select("b", "b").distinct())
        mark = now
        edges = stored(_star(_star(edges, large=True), large=False), "edges")
