"""Row numbers 1..n within a group, without sorting the group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trowel.session import stored

BLOCK_BITS = 16  # ids are summed up in blocks of 65,536


def start_numbers(rows: DataFrame, group: str, id_col: str, number: str | None = None) -> DataFrame:
    """How many rows of the group come before each id: group, id, ``before``.

    Counts per id are summed up within blocks of ids, and the blocks' sums within the
    group, so no window spans more than a block or the list of blocks. With ``number`` a row
    stands for as many rows as that column says.
    """
    count = F.count(F.lit(1)) if number is None else F.sum(number)
    per_id = rows.groupBy(group, id_col).agg(count.alias("_n")).withColumn(
        "_block", F.shiftright(id_col, BLOCK_BITS))
    blocks = per_id.groupBy(group, "_block").agg(F.sum("_n").alias("_n"))

    def before(by, order):
        window = (Window.partitionBy(*by).orderBy(order)
                  .rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(F.sum("_n").over(window), F.lit(0))

    blocks = blocks.select(group, "_block", before([group], "_block").alias("_base"))
    ids = per_id.select(group, id_col, "_block",
                        before([group, "_block"], id_col).alias("_start"))
    return ids.join(blocks, [group, "_block"]).select(
        group, id_col, (F.col("_start") + F.col("_base")).alias("before"))


def places_in_groups(rows: DataFrame, keys: list[str], order: list[str], weight: str) -> DataFrame:
    """The rows with ``place`` (from 0) in their group, by ``order``, and ``weight_before``, the
    weight of the rows ahead of them; equal rows come in any order.

    Sorted by ranges of keys and order, so a group of any size is spread over tasks. The sorted
    rows are written once, and each task's share of a group then starts where those of the tasks
    before it end: a table of one row per task and group.
    """
    keyed = stored(rows.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    by = [*keys, *order, "_row"]
    laid = stored(keyed.repartitionByRange(*by).sortWithinPartitions(*by).withColumn(
        "_at", F.monotonically_increasing_id()), "sorted").withColumn("_task", F.shiftright("_at", 33))
    ahead = Window.partitionBy(*keys).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy(*keys, "_task").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    runs = laid.groupBy(*keys, "_task").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"),
                                            F.sum(weight).alias("_w"))
    starts = runs.select(
        *[F.col(k).alias(f"_{k}") for k in keys], F.col("_task").alias("_of"), "_first",
        F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_base"),
        F.coalesce(F.sum("_w").over(ahead), F.lit(0)).alias("_weight"))
    same = F.col("_task") == F.col("_of")
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    own = laid.withColumn("_before", F.coalesce(F.sum(weight).over(within), F.lit(0)))
    return own.join(starts, same).withColumn("place", F.col("_at") - F.col("_first") + F.col("_base")).withColumn(
        "weight_before", F.col("_before") + F.col("_weight")).drop(
        "_row", "_at", "_task", "_of", "_first", "_base", "_before", "_weight", *[f"_{k}" for k in keys])


def number_rows(df: DataFrame, starts: DataFrame, group: str, id_col: str, ties: list[str],
                out: str = "pk") -> DataFrame:
    """``row_number() over (partition by group order by id_col, ties)``."""
    within = F.row_number().over(Window.partitionBy(group, id_col).orderBy(*ties))
    return (df.join(starts, [group, id_col])
            .withColumn(out, F.col("before") + within).drop("before"))
