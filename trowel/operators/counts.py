"""Counting finds, values and features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trowel import schema as S
from trowel.functions import patterns as P
from trowel.session import stored

A = "archive"


def select_finds(t, meta_id: int = S.META_FIND_TYPE) -> DataFrame:
    """Objects with their find-type attribute and its values."""
    attributes = t["attribute"].where(F.col("MetaId") == meta_id).select(
        A, "ObjectId", "AttributeId", "MetaId", "Label")
    values = t["attribute_value"].select(A, "AttributeId", "AttributeValueId", "Value")
    return (t["object"].join(attributes, [A, "ObjectId"])
            .join(values, [A, "AttributeId"], "left")
            .select(A, "ObjectId", "ClassId", "SubClassId", "PublicId", "Name", "SiteId",
                    "Origin", "AttributeId", "MetaId", "Label", "AttributeValueId", "Value"))


def find_count(t, meta_id: int = S.META_FIND_TYPE) -> DataFrame:
    return select_finds(t, meta_id).groupBy(A, F.col("Value").alias("find_type")).agg(
        F.count(F.lit(1)).alias("find_count"))


def attribute_values(t) -> DataFrame:
    """All values of all archives, once each."""
    return t["attribute_value"].select(F.col("Value").alias("value")).distinct()


def geo_values(t) -> DataFrame:
    """Values of objects that have a geometry, one row per value and link."""
    links = t["geo_rel"].join(
        t["geo_object"].select(A, F.col("ObjectId").alias("GeoObjectId")), [A, "GeoObjectId"])
    return (links.select(A, "ObjectId").join(t["object"].select(A, "ObjectId"), [A, "ObjectId"])
            .join(t["attribute"].select(A, "AttributeId", "ObjectId"), [A, "ObjectId"])
            .join(t["attribute_value"].select(A, "AttributeId", "Value"), [A, "AttributeId"])
            .select(A, "Value"))


def geo_value_counts(t) -> DataFrame:
    """How often each value occurs in `geo_values`: objects are weighed by their links before
    their values are looked up, so no link meets a value."""
    links = t["geo_rel"].join(
        t["geo_object"].select(A, F.col("ObjectId").alias("GeoObjectId")), [A, "GeoObjectId"])
    weights = (links.select(A, "ObjectId", F.lit(1).alias("links"), F.lit(0).alias("own"))
               .union(t["object"].select(A, "ObjectId", F.lit(0), F.lit(1)))
               .groupBy(A, "ObjectId").agg((F.sum("links") * F.sum("own")).alias("weight"))
               .where("weight > 0"))
    return (t["attribute"].select(A, "AttributeId", "ObjectId").join(weights, [A, "ObjectId"])
            .select(A, "AttributeId", "weight")
            .join(t["attribute_value"].select(A, "AttributeId", "Value"), [A, "AttributeId"])
            .groupBy(A, "Value").agg(F.sum("weight").alias("n")))


def geo_attribute_values(t) -> DataFrame:
    return geo_values(t).select(F.col("Value").alias("value")).distinct()


def feature_count(t, pattern: str = P.POSTHOLE_COUNT, label: str = P.POSTHOLE_LABEL) -> DataFrame:
    """Values that match the pattern, with their share of all values, and a total row.

    Values are counted per archive once and stored; the pattern then runs on distinct values
    only, and shares and totals come from those counts.
    """
    hit = F.coalesce(P.marked(F.col("Value")).rlike(pattern), F.lit(False))
    counted = stored(geo_value_counts(t).withColumn("hit", hit), "counted")
    # archives without any such value have a row of zeros
    known = counted.select(A, "n", F.when(F.col("hit"), F.col("n")).otherwise(0).alias("hits"))
    none = F.lit(0).cast("bigint")
    totals = known.union(t["object"].select(A).distinct().select(A, none, none)).groupBy(A).agg(
        F.sum("n").alias("total_features"), F.sum("hits").alias("all_hits"))
    every = totals.select(A, F.lit(label).alias("feature"), F.col("all_hits").alias("feature_count"),
                          "total_features")
    each = counted.where("hit").join(totals, A).select(
        A, F.col("Value").alias("feature"), F.col("n").alias("feature_count"), "total_features")
    share = F.round(F.col("feature_count").cast("decimal(20,10)")
                    / F.greatest("total_features", F.lit(1)).cast("decimal(20,0)"), 2)
    return every.union(each).select(A, "feature", "feature_count",
                                    share.cast("float").alias("feature_proportion"),
                                    "total_features")


def value_status(values: DataFrame, pattern: str = P.POSTHOLE_STATUS) -> DataFrame:
    """Whether a value counts as the feature."""
    used = F.when(P.marked(F.col("value")).rlike(pattern), P.STATUS_USED).otherwise(P.STATUS_UNUSED)
    return values.withColumn("extraction_status", used)


def value_histogram(t, keep: Column | None = None, ordered: bool = True) -> DataFrame:
    """How often each value occurs over all archives, among those ``keep`` selects."""
    rows = t["attribute_value"].select("Value")
    if keep is not None:
        rows = rows.where(keep)
    out = rows.groupBy("Value").agg(F.count(F.lit(1)).alias("value_occurrence"))
    return out.orderBy(F.asc_nulls_last("Value")) if ordered else out


def prototype_histograms(t) -> DataFrame:
    """Values that each of the prototype patterns finds, with their occurrence."""
    value = P.marked(F.col("Value"))
    found = [value_histogram(t, value.rlike(pattern), ordered=False).withColumn("prototype", F.lit(name))
             for name, pattern in P.POSTHOLE_PROTOTYPES.items()]
    return found[0].union(found[1]).union(found[2])


def histogram_difference(t, keep: Column, drop: Column) -> DataFrame:
    """Value counts found under one rule and not under the other."""
    return value_histogram(t, keep, ordered=False).subtract(
        value_histogram(t, drop, ordered=False)).orderBy(F.asc_nulls_last("Value"))


def keyword_distance(values: DataFrame, keyword: str = P.POSTHOLE_WORD, longer_than: int = 3,
                     below: int = 11, key: str | list[str] = "pk") -> DataFrame:
    """Edit distance from the nearest word of each value to a keyword.

    Words are split at word borders; of equally near words the first by spelling stays.
    """
    keys = [key] if isinstance(key, str) else list(key)
    # within the row, so nothing is shuffled; a key that repeats keeps its own row for each
    words = F.filter(F.split("value", r"(?U)\b"), lambda w: F.length(w) > longer_than)
    near = F.filter(F.transform(words, lambda w: F.struct(
        F.levenshtein(F.upper(w), F.lit(keyword)).alias("distance"), w.alias("word"))),
        lambda s: s["distance"] < below)
    return values.select(*keys, F.array_min(near).alias("best")).where(
        F.col("best").isNotNull()).select(*keys, "best.distance", "best.word")
