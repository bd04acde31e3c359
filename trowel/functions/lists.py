"""Value lists per group that stay bounded when one group holds a large share of the rows.

One rule for groups of every size: members are numbered in the order of their ids, and a list
is cut wherever it reaches the bound of members or of bytes.  An ordinary group is one row,
``part`` 0; a larger one goes on in rows with rising parts.  Every row carries the total of
the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trowel.functions.numbering import places_in_groups
from trowel.session import stored

MEMBERS = 262_144  # members of one row, at most
BYTES = 64 * 1024 * 1024  # text of one row, about


def fold(df: DataFrame, keys: Sequence[str], member: str,
         lists: dict[str, tuple[Column, Column | None]], count: str = "members",
         max_members: int = MEMBERS, max_bytes: int = BYTES) -> DataFrame:
    """Rows folded to lists per key: keys, part, ``count`` (of the whole group), lists.

    ``lists`` maps an output name to the value to collect, wrapped as
    ``element(value, condition)``; lists come out in the order of ``member``, a list without
    a wanted value is NULL.  The rows are written once; a count of the keys then shows which
    groups are over a bound, and only their rows are numbered, by ranges of key and member,
    so that no task holds a whole group.  Ordinary groups are shuffled once.
    """
    keys = list(keys)
    # a value that is not wanted is NULL, a wanted NULL is wrapped
    items = [(F.struct(value.alias("v")) if cond is None
              else F.when(cond, F.struct(value.alias("v")))).alias(name)
             for name, (value, cond) in lists.items()]
    size = F.lit(16)
    for value, _ in lists.values():
        size = size + F.coalesce(F.octet_length(value.cast("string")), F.lit(0))
    rows = stored(df.select(
        *keys, F.struct(F.col(member).alias("m"), *items).alias("_item"),
        size.cast("bigint").alias("_size")), "items")
    large = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(count), F.sum("_size").alias("_bytes")).where(
        (F.col(count) > max_members) | (F.col("_bytes") > max_bytes))
    large = stored(large.select(*[F.col(k).alias(f"_{k}") for k in keys], count), "large")
    if large.isEmpty():
        return _collected(rows, keys, list(lists), F.count(F.lit(1)).alias(count))
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    ordinary = rows.join(large, same, "left_anti")
    cut = places_in_groups(rows.join(large, same).drop(*[f"_{k}" for k in keys]), keys,
                           ["_item.m"], "_size")
    # both quotients only rise, so a part is one stretch below both bounds
    part = F.floor(F.col("place") / max_members) + F.floor(F.col("weight_before") / max_bytes)
    return _collected(ordinary, keys, list(lists), F.count(F.lit(1)).alias(count)).union(
        _collected(cut.withColumn("part", part.cast("int")), keys, list(lists),
                   F.max(count).alias(count)))


def _collected(rows: DataFrame, keys: list[str], names: list[str], total: Column) -> DataFrame:
    by = [*keys, "part"] if "part" in rows.columns else keys
    folded = rows.groupBy(*by).agg(total, F.array_sort(F.collect_list("_item")).alias("_items"))
    if by is keys:  # not a key of the grouping: a join by the keys then needs no second shuffle
        folded = folded.withColumn("part", F.lit(0))
    count = [c for c in folded.columns if c not in (*keys, "part", "_items")][0]
    split = folded.select(*keys, "part", count, *[F.transform(F.filter(
        "_items", _wanted(name)), _value(name)).alias(name) for name in names])
    return split.select(*keys, "part", count, *[
        F.when(F.size(name) > 0, F.col(name)).alias(name) for name in names])


def _wanted(name: str):
    return lambda item: item[name].isNotNull()


def _value(name: str):
    return lambda item: item[name]["v"]


def element(value: Column, condition: Column | None = None) -> tuple[Column, Column | None]:
    return value, condition
