"""Objects with their attributes, folded from the entity-attribute-value tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trowel.functions.lists import element, fold

A = "archive"


def object_attributes(t) -> DataFrame:
    """Every attribute value with its attribute's metadata, where that is defined."""
    metadata = (
        t["attribute"].select(A, "AttributeId", "MetaId", "ObjectId", "Label")
        .join(t["attribute_def"].select(A, "MetaId", "MultipleAllowed", "FreeValueAllowed",
                                        "NotNull", "DataType", "Length"), [A, "MetaId"])
        .withColumnRenamed("MetaId", "attribute_metaid"))
    return (t["attribute_value"].join(metadata, [A, "AttributeId"], "left")
            .select(A, "AttributeId", "AttributeValueId", "Unit", "Value", "attribute_metaid",
                    "ObjectId", "Label", "MultipleAllowed", "FreeValueAllowed", "NotNull",
                    "DataType", "Length"))


def objects_and_attributes(t) -> DataFrame:
    values = object_attributes(t).drop("MultipleAllowed", "FreeValueAllowed", "NotNull")
    return (t["object"].join(values.where(F.col("ObjectId").isNotNull()), [A, "ObjectId"], "left")
            .select(A, "ObjectId", "ClassId", "SubClassId", "PublicId", "Name", "SiteId",
                    "Origin", "AttributeId", "AttributeValueId", "Unit", "Value",
                    "attribute_metaid", "Label", "DataType", "Length"))


def value_with_unit() -> Column:
    """Value and unit; NULL when the unit is NULL, a trailing blank when it is empty."""
    return F.concat(F.col("Value"), F.lit(" "), F.col("Unit"))


def attr_text(empty: str = "csv") -> Column:
    """``Label: Value Unit`` under one of four rules for missing values.

    csv: a missing or empty value is left blank; table: it makes the text NULL; draft: it
    is written ``<null>``.  In all three a missing unit makes the text NULL.  view: an
    empty value is written ``no data``, a missing one makes the text NULL, no unit.
    """
    value = F.col("Value")
    blank = value.isNull() | (value == "")
    if empty == "view":
        return F.concat("Label", F.lit(": "), F.when(value == "", "no data").otherwise(value))
    filler = {"csv": F.lit(""), "table": F.lit(None).cast("string"), "draft": F.lit("<null>")}
    return F.concat("Label", F.lit(": "), F.when(blank, filler[empty]).otherwise(value),
                    F.lit(" "), F.col("Unit"))


def attr_detail(t, empty: str = "csv") -> DataFrame:
    """Attribute values with definition texts; one row per alternative definition."""
    names = t["definition"].select(
        A, "MetaId", F.col("Name").alias("definition_name"),
        F.col("Description").alias("definition_description"),
        F.col("VersionReferenceId").alias("definition_versionreference"))
    alternatives = t["alternative_def"].select(
        A, "MetaId", F.col("Value").alias("alternative_def_value"))
    attributes = (
        t["attribute"].select(A, "AttributeId", "MetaId", "ObjectId", "Label")
        .join(t["attribute_def"].select(A, "MetaId"), [A, "MetaId"])
        .join(names, [A, "MetaId"], "left").join(alternatives, [A, "MetaId"], "left"))
    return attributes.join(t["attribute_value"], [A, "AttributeId"]).select(
        A, F.col("AttributeId").alias("attribute_id"), F.col("MetaId").alias("attribute_meta_id"),
        F.col("ObjectId").alias("object_id"), F.col("Label").alias("attribute_label"),
        F.col("AttributeValueId").alias("attributevalue_id"),
        value_with_unit().alias("attributevalue_value"), "definition_name",
        "definition_description", "definition_versionreference", "alternative_def_value",
        attr_text(empty).alias("attributevalue"))


def attr_items(t, empty: str = "csv") -> DataFrame:
    """The texts to fold: archive, object_id, kind, member, text."""
    return attr_detail(t, empty).select(
        A, "object_id", F.lit("attr").alias("kind"),
        F.col("attributevalue_id").alias("member"), F.col("attributevalue").alias("text"))


def attr_arrays(t, empty: str = "csv", **bounds: int) -> DataFrame:
    """Attribute texts per object, in order of the value's id."""
    return fold(attr_items(t, empty), [A, "object_id"], "member",
                {"attr_array": element(F.col("text"))}, **bounds)


def attributes_layer(t) -> DataFrame:
    """Values of linked objects, one row per geometry link."""
    return (t["attribute"].select(A, "AttributeId", "ObjectId", "Label")
            .join(t["attribute_value"], [A, "AttributeId"])
            .join(t["geo_rel"].select(A, "ObjectId"), [A, "ObjectId"])
            .select(A, F.col("ObjectId").alias("object_id"),
                    F.col("Label").alias("attribute_label"),
                    value_with_unit().alias("attribute_value")))


def object_definitions(t) -> DataFrame:
    return (t["object_def"].select(A, "MetaId", "PublicId", "Code")
            .join(t["definition"].select(A, "MetaId", "Name", "Description", "Help"),
                  [A, "MetaId"])
            .select(A, "PublicId", "Code", F.col("Name").alias("definition"),
                    F.col("Description").alias("definition_description"),
                    F.col("Help").alias("definition_help")))


# Dictionary tables and the columns looked up in them.
LOOKUPS = {
    "definition": ["Name"], "alternative_def": ["Value"], "attribute": ["Label"],
    "attribute_def": ["Label"], "object_def": ["Code"], "sub_class_def": ["ClassId"],
}


def definitions_by_id(t, meta_ids) -> DataFrame:
    """Every dictionary row about some definition ids, with the table it is in."""
    out = None
    for table, (column,) in LOOKUPS.items():
        rows = t[table].where(F.col("MetaId").isin(*meta_ids)).select(
            A, F.lit(table).alias("source"), "MetaId", F.col(column).cast("string").alias("text"))
        out = rows if out is None else out.union(rows)
    return out


def object_lists(items: DataFrame, names: dict[str, str], **bounds: int) -> DataFrame:
    """Several kinds of items folded per object in one pass."""
    lists = {name: element(F.col("text"), F.col("kind") == kind) for name, kind in names.items()}
    return fold(items, [A, "object_id"], "member", lists, **bounds)
