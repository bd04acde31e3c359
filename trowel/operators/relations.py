"""Typed links between objects, and groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trowel.functions.lists import element, fold
from trowel.functions.text import clean_text
from trowel.schema import CREATES_TEXT, GROUP_SUBCLASSES, NON_GROUP_CLASSES
from trowel.session import attached

A = "archive"


def _edges(t) -> DataFrame:
    texts = t["relation_def"].select(A, "MetaId", "ParentText", "ChildText")
    return t["object_rel"].join(texts, [A, "MetaId"])


def relation_items(t, of: DataFrame | None = None) -> DataFrame:
    """One text per link and end: the parent's about its child, the child's about its parent. With
    ``of`` (archive, object_id) only the texts of these objects: the others are not made."""
    ends = F.array(
        F.struct(F.col("ParentId").alias("object_id"), F.lit("parent").alias("kind"),
                 F.col("ChildId").alias("member")),
        F.struct(F.col("ChildId").alias("object_id"), F.lit("child").alias("kind"),
                 F.col("ParentId").alias("member")))
    links = t["object_rel"].select(A, "MetaId", F.inline(ends))
    if of is not None:
        links = links.join(of, [A, "object_id"], "left_semi")
    start = F.when(F.col("kind") == "parent", F.col("ParentText")).otherwise(F.col("ChildText"))
    return _edges({"object_rel": links, "relation_def": t["relation_def"]}).select(
        A, "object_id", "kind", "member", F.concat(start, F.lit(" "), F.col("member").cast("string")).alias("text"))


def described_items(t) -> DataFrame:
    """The same with the relation's definition name: a child's parents, a parent's children."""
    names = t["definition"].select(A, "MetaId", F.col("Name").alias("relation"))
    ends = F.array(
        F.struct(F.col("ChildId").alias("object_id"), F.lit("parent").alias("kind"),
                 F.col("ParentId").alias("member"),
                 F.concat(F.lit("parent: "), F.col("ParentId").cast("string"),
                          F.lit(", relationship type: "), "relation").alias("text")),
        F.struct(F.col("ParentId").alias("object_id"), F.lit("child").alias("kind"),
                 F.col("ChildId").alias("member"),
                 F.concat(F.lit("child: "), F.col("ChildId").cast("string"),
                          F.lit(", relationship type: "), "relation").alias("text")))
    return t["object_rel"].join(names, [A, "MetaId"]).select(A, F.inline(ends))


def parent_relations(t, **bounds: int) -> DataFrame:
    """Texts about the children of each parent."""
    items = relation_items(t).where(F.col("kind") == "parent")
    return fold(items, [A, "object_id"], "member",
                {"parent_relations": element(F.col("text"))}, **bounds)


def child_relations(t, **bounds: int) -> DataFrame:
    """Texts about the parents of each child."""
    items = relation_items(t).where(F.col("kind") == "child")
    return fold(items, [A, "object_id"], "member",
                {"child_relations": element(F.col("text"))}, **bounds)


def relation_arrays_described(t, **bounds: int) -> DataFrame:
    """Both kinds of described links per object, in one pass."""
    return fold(described_items(t), [A, "object_id"], "member", {
        "parent_relations": element(F.col("text"), F.col("kind") == "parent"),
        "child_relations": element(F.col("text"), F.col("kind") == "child")}, **bounds)


def relations_layer(t) -> DataFrame:
    return _edges(t).where(F.col("ParentText") != CREATES_TEXT).select(
        A, F.col("ParentId").alias("parent_id"), F.col("ChildId").alias("child_id"),
        F.col("ParentText").alias("parent_text"), F.col("ChildText").alias("child_text"))


def group_members(t, subclasses=GROUP_SUBCLASSES) -> DataFrame:
    """Group objects and their children; a group without children has one row."""
    groups = t["object"].where(F.col("SubClassId").isin(*subclasses)).select(
        A, F.col("ObjectId").alias("group_id"), F.col("Name").alias("group_name"))
    links = t["object_rel"].select(A, F.col("ParentId").alias("group_id"),
                                   F.col("ChildId").alias("object_id"))
    return groups.join(links, [A, "group_id"], "left")


def object_texts(t, clean=clean_text, keep_unowned: bool = False, of: DataFrame | None = None) -> DataFrame:
    """Cleaned notes with their object; several notes of one object stay several rows. With ``of``
    (archive, object_id) only the notes of these objects.

    A stored ``converted_text`` is used as it is when ``clean`` is the default; notes that have
    none yet are cleaned.
    """
    notes = t["free_text"]
    if clean is clean_text and "converted_text" in notes.columns:
        text = F.coalesce("converted_text", clean(F.col("Text")))
    else:
        text = clean(F.col("Text"))
    owners = t["attribute"].select(A, "AttributeId", F.col("ObjectId").alias("object_id"))
    if of is not None:
        owners = owners.join(of, [A, "object_id"], "left_semi")
    noted = notes.select(A, "AttributeId", text.alias("description"))
    return (attached(noted, owners, [A, "AttributeId"], "left" if keep_unowned else "inner")
            .select(A, "object_id", F.col("AttributeId").alias("text_id"), "description"))


def groups_layer(t, classes=NON_GROUP_CLASSES) -> DataFrame:
    """Objects without geometry that have linked children and a note; one note each.

    Geometry ids count as candidates again after linked objects were taken out.
    """
    linked = t["geo_rel"].select(A, "ObjectId").distinct()
    plain = t["object"].where(~F.col("ClassId").isin(*classes)).select(A, "ObjectId")
    candidates = plain.subtract(linked).union(
        t["geo_rel"].select(A, F.col("GeoObjectId"))).distinct()
    with_children = (
        t["object_rel"].select(A, F.col("ParentId").alias("ObjectId"),
                               F.col("ChildId").alias("child"))
        .join(linked.withColumnRenamed("ObjectId", "child"), [A, "child"], "left_semi")
        .select(A, "ObjectId").distinct())
    first_note = Window.partitionBy(A, "object_id").orderBy("text_id")
    notes = (object_texts(t).withColumn("_n", F.row_number().over(first_note))
             .where(F.col("_n") == 1)
             .select(A, F.col("object_id").alias("ObjectId"),
                     F.col("description").alias("converted_text")))
    return (candidates.join(with_children, [A, "ObjectId"], "left_semi")
            .join(t["object"].select(A, "ObjectId", "Name"), [A, "ObjectId"])
            .join(notes, [A, "ObjectId"])
            .select(A, F.col("ObjectId").alias("group_id"), F.col("Name").alias("group_name"),
                    "converted_text"))
