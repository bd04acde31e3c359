"""SimHash near-duplicates, found by Golay-code fuzzy hashing."""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trowel.llm import golay
from trowel.llm.common import components, read, stored

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
DENSE_BUCKET = 512  # buckets with more fingerprints first link to one of their members
_PIECE = 1 << 16    # shingles whose bits are held at a time

# Upper 23, middle 23 and lower 18 bits. If at most three bits differ, at least two of the
# three segments differ in one bit or none.
SEGMENTS = ((41, 23), (18, 23), (0, 18))
PAIRS = ((0, 1), (0, 2), (1, 2))


def simhash(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """The 64-bit fingerprint as a signed integer; 0 for a text without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: ASCII rules only
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles, n = iter([b" ".join(words)]), 1
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle_words))))
        n = len(words) - shingle_words + 1
    ones, hashes = np.zeros(64, np.int64), map(xxhash.xxh64_intdigest, shingles, repeat(SEED))
    for start in range(0, n, _PIECE):
        h = np.fromiter(hashes, ">u8", min(_PIECE, n - start))
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle_words: int = SHINGLE_WORDS) -> Column:
    """The fingerprint of a text column as a long."""

    @F.pandas_udf("long")
    def hashed(texts: pd.Series) -> pd.Series:
        return pd.Series([simhash(t, shingle_words) for t in texts], dtype="int64")

    return hashed(text)


def _segments(fps: np.ndarray) -> list[np.ndarray]:
    return [(fps >> shift) & ((1 << bits) - 1) for shift, bits in SEGMENTS]


def _bucket(pair: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return (pair << 2 * golay.INDEX_BITS) | (first << golay.INDEX_BITS) | second


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _own_buckets(fps: pd.Series) -> pd.Series:
    """One bucket for each pair of segments: the indices of both."""
    index = [golay.index(s) for s in _segments(fps.to_numpy(np.int64))]
    return pd.Series(list(np.stack([_bucket(p, index[i], index[j])
                                    for p, (i, j) in enumerate(PAIRS)], 1).astype(np.int32)))


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _nearby_buckets(fps: pd.Series) -> pd.Series:
    """The buckets of all fingerprints that differ in one bit at most in both segments of a
    pair: up to 36 for each pair."""
    near = [golay.nearby_indices(s) for s in _segments(fps.to_numpy(np.int64))]
    found = np.concatenate([_bucket(p, near[i][:, :, None], near[j][:, None, :]).reshape(len(fps), -1)
                            for p, (i, j) in enumerate(PAIRS)], 1)
    found.sort(axis=1)
    new = np.ones(found.shape, bool)
    new[:, 1:] = found[:, 1:] != found[:, :-1]
    return pd.Series([row[keep].astype(np.int32) for row, keep in zip(found, new)])


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def links(prints: DataFrame, max_bits: int = MAX_BITS, dense_bucket: int = DENSE_BUCKET) -> DataFrame:
    """Links (a, b) between the distinct fingerprints of ``prints`` (one column, fp).

    Two fingerprints are in one component of the result exactly if they are in one component
    of all links at ``max_bits`` (3 at most) or fewer differing bits. All such links are listed,
    but for those that buckets of more than ``dense_bucket`` fingerprints add between members
    which are already connected through the bucket's smallest one. So a bucket of near copies,
    however large, gives no list of all its pairs; candidates are compared in the join.
    """
    if max_bits > 3:
        raise ValueError("the segments guarantee at most three differing bits")
    own = stored(prints.select(F.col("fp").alias("b"), F.explode(_own_buckets("fp")).alias("bucket")),
                 "buckets")
    probes = prints.select(F.col("fp").alias("a"), F.explode(_nearby_buckets("fp")).alias("bucket"))
    dense = stored(own.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("hub"))
                   .where(F.col("n") > dense_bucket).select("bucket", "hub"), "dense")
    found = lambda p, o: p.join(o, "bucket").where(
        (F.col("a") != F.col("b")) & _near("a", "b", max_bits)).select("a", "b")
    if dense.isEmpty():
        return found(probes, own)
    sparse = found(probes.join(F.broadcast(dense) if dense.count() <= 100_000 else dense, "bucket", "left_anti"),
                   own.join(dense, "bucket", "left_anti"))
    hot_probes = stored(probes.join(dense, "bucket"), "probes")
    hubs = stored(hot_probes.where((F.col("a") != F.col("hub")) & _near("a", "hub", max_bits))
                  .select("a", F.col("hub").alias("b")).distinct(), "hubs")
    known = stored(components(hubs), "known")
    labelled = lambda rows, c: rows.join(
        known.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root")), c, "left").withColumn(
        f"{c}_root", F.coalesce(f"{c}_root", c))
    rest = labelled(hot_probes.drop("hub"), "a").join(
        labelled(own.join(dense.drop("hub"), "bucket", "left_semi"), "b"), "bucket").where(
        (F.col("a_root") != F.col("b_root")) & _near("a", "b", max_bits)).select("a", "b")
    return sparse.union(hubs).union(rest)


def _rows(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, keep: list[str]) -> DataFrame:
    return stored(docs.select(
        F.col(id_col).alias("doc_id"), fingerprint(F.col(text_col), shingle_words).alias("fp"),
        F.monotonically_increasing_id().alias("row_no"),
        *[F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)]), "prints")


def _members(rows: DataFrame, max_bits: int, dense_bucket: int) -> DataFrame:
    rows = rows.select("doc_id", "fp", "row_no")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(prints.select("fp"), max_bits, dense_bucket))
    rooted = stored(prints.join(roots.select(F.col("node").alias("fp"), "root"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_print = stored(rooted.join(named, "root").select("fp", "root", "component_id"), "named")
    return rows.join(of_print, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                    dense_bucket: int = DENSE_BUCKET) -> DataFrame:
    """Every row with its fingerprint and component: (doc_id, fp, component_id).

    Links join fingerprints that differ in ``max_bits`` bits or fewer; a component holds all
    rows reachable over links, and its id is the smallest doc_id in it. Defined cases: a null
    or empty text or one without words has fingerprint 0, which links like any other; repeated
    rows stay separate rows of one component; null ids take part but never name a component
    unless all of its ids are null (then it is null); an empty table gives an empty one; other
    columns don't matter.
    """
    rows = _rows(docs, id_col, text_col, shingle_words, [])
    return _members(rows, max_bits, dense_bucket).select("doc_id", "fp", "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         shingle_words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS,
                         dense_bucket: int = DENSE_BUCKET) -> DataFrame:
    """One row of each component: the one with the smallest id (null ids last), and one of
    those where rows repeat. Columns and their order stay; texts are shuffled once."""
    rows = _rows(docs, id_col, text_col, shingle_words, docs.columns)
    members = _members(rows, max_bits, dense_bucket)
    first = stored(members.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_no")).alias("first"))
        .select(F.col("first.row_no").alias("row_no")), "first")
    return rows.join(first, "row_no", "left_semi").select(
        *[F.col(f"keep_{i}").alias(c) for i, c in enumerate(docs.columns)])


def op8_simhash_near_dedup(spark, folder: str) -> DataFrame:
    found = near_duplicates(read(spark, folder, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        "component_id")
