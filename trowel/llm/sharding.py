"""Shards by weighted rendezvous hashing of stable keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trowel.llm.common import free_names, read, stored

SHARDS = 40
ROW_BYTES = 16


def _draw(key: Column, shard: int) -> Column:
    """A number in (0, 1) that key and shard decide: 52 bits of an MD5 sum."""
    digest = F.md5(F.encode(F.concat_ws(":", key, F.lit(str(shard))), "utf-8"))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (bits + 0.5) / float(1 << 52)


def _bids(key: Column, weights: dict[int, float]) -> list[Column]:
    """Each shard's bid for the key, least wins: -ln(draw) / weight is exponential with the
    weight as its rate, so a shard wins with a chance in proportion to its weight."""
    return [F.struct((-F.log(_draw(key, s)) / F.lit(float(w))).alias("bid"), F.lit(s).alias("shard"))
            for s, w in weights.items()]


def key_text(key: Column) -> Column:
    """The key as text; a null key is the empty text."""
    return F.coalesce(key.cast("string"), F.lit(""))


def assign(docs: DataFrame, weights: dict[int, float], key_col: str = "doc_id",
           grown: dict[int, float] | None = None, shard_col: str = "shard",
           grown_col: str = "grown_shard") -> DataFrame:
    """The rows with their shard, decided by the key and the weighted shards alone: no shuffle,
    no state, the same on every run and machine.

    ``grown`` are further shards; ``grown_col`` is then the shard with these added too. A key
    changes its shard only if an added shard outbids all others, so rows move into added
    shards only, as many as their share of the weights. Rows with one key stay together.

    Defined cases: null keys count as one key of their own; equal bids go to the smaller shard
    number; columns named as the results are replaced, all others pass through; an empty table
    gives an empty one; weights must be above 0.
    """
    every = {**weights, **(grown or {})}
    if not weights or min(every.values()) <= 0:
        raise ValueError("each shard needs a weight above 0")
    least = lambda bids: F.least(*bids) if len(bids) > 1 else bids[0]
    key = key_text(F.col(key_col))
    now, then = free_names(docs, "bid_now", "bid_then")
    best = docs.withColumn(now, least(_bids(key, weights)))
    if grown:
        best = best.withColumn(then, F.least(now, least(_bids(key, grown)))).withColumn(
            grown_col, F.col(then)["shard"])
    return best.withColumn(shard_col, F.col(now)["shard"]).drop(now, then)


def number_slots(assigned: DataFrame, order: list[str], shard_col: str = "shard",
                 slot_col: str = "slot") -> DataFrame:
    """The rows with a gapless number from 0 in their shard, in the order of ``order``.

    Sorted by ranges of shard, order and a row number, so that neither a large shard nor a key
    that many rows share lands in one task. The sorted rows are written once; the place of each
    task's rows in a shard then follows from a table of one row for each task and shard.

    Defined cases: nulls come first in the order; equal rows get numbers of their own, in any
    order; an empty table gives an empty one; names used on the way avoid those of the rows.
    """
    row, at, task, first, n, before = free_names(assigned, "row", "at", "task", "first", "n", "before")
    numbered = stored(assigned.withColumn(row, F.monotonically_increasing_id()), "assigned")
    keys = [shard_col, *order, row]
    laid = stored(numbered.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(
        at, F.monotonically_increasing_id()), "sorted").withColumn(task, F.shiftright(at, 33))
    runs = stored(laid.groupBy(task, shard_col).agg(F.min(at).alias(first), F.count(F.lit(1)).alias(n)), "runs")
    # A shard's rows lie in neighbouring tasks: tasks + shards rows in all, whatever the rows
    earlier = Window.partitionBy(shard_col).orderBy(task).rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.withColumn(before, F.coalesce(F.sum(n).over(earlier), F.lit(0))).drop(n)
    placed = laid.join(F.broadcast(starts), [task, shard_col])
    return placed.withColumn(slot_col, F.col(at) - F.col(first) + F.col(before)).drop(
        row, at, task, first, before)


def write_shards(assigned: DataFrame, path: str, shard_col: str = "shard", files_per_shard: int = 1) -> None:
    """Each shard as a folder of parquet files below ``path``; a shard's rows are dealt to
    ``files_per_shard`` tasks, so that no shard depends on one.

    Defined cases: nulls, empty and long texts are written as they are, repeated rows each; an
    empty table, as a shard without rows, leaves no folder of a shard; ``path`` must be new.
    """
    deal = F.pmod(F.monotonically_increasing_id(), F.lit(files_per_shard))
    assigned.repartition(shard_col, deal).write.partitionBy(
        shard_col).parquet(path)


def op2_sharding(spark, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    text = F.encode(F.coalesce("text", F.lit("")), "utf-8")
    rows = docs.select("doc_id", (F.octet_length(text).cast("bigint") + ROW_BYTES).alias("size"),
                       F.crc32(text).alias("text_crc32"))
    placed = assign(rows, {s: 1.0 for s in range(SHARDS)}, grown={SHARDS: 1.0})
    return number_slots(placed, ["doc_id", "text_crc32", "size"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


_BID = ("-ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || s), 1, 13))::BIGINT::DOUBLE"
        " + 0.5) / 4503599627370496.0)")

# CRC-32 by its definition: eight shifts for each byte.
SQL = f"""
WITH RECURSIVE steps(v, c, k) AS (
    SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i)
    UNION ALL
    SELECT v, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY v) AS t FROM steps WHERE k = 8),
docs AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(hex(encode(text)), '') AS bytes FROM documents),
sums AS (
    SELECT row_no, doc_id, length(bytes) // 2 + {ROW_BYTES} AS size,
           xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, length(bytes) // 2),
                   lambda i: ('0x' || substr(bytes, (2 * i + 1)::INT, 2))::BIGINT),
                   lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS text_crc32
    FROM docs, crc_table),
bids AS (SELECT row_no, s, {_BID} AS bid FROM docs, range({SHARDS + 1}) r(s)),
won AS (
    SELECT row_no, arg_min(s, bid) FILTER (s < {SHARDS}) AS shard, arg_min(s, bid) AS grown_shard
    FROM bids GROUP BY row_no)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       grown_shard::INT AS grown_shard
FROM sums JOIN won USING (row_no)
"""
