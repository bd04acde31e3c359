"""Core tables and the constants that carry meaning in them.

Ids are unique per archive only, so ``archive`` belongs in every join key.
Ids are BIGINT here: the data model allows INT, and wider ids cost nothing.
"""

from __future__ import annotations

# Table name -> Spark DDL.  Every per-archive table starts with `archive`.
CORE_TABLES: dict[str, str] = {
    "object": "archive STRING, ObjectId BIGINT, ClassId INT, SubClassId INT, PublicId BIGINT, "
    "Name STRING, SiteId BIGINT, Origin INT",
    "geo_object": "archive STRING, ObjectId BIGINT, MetaId INT, SymbolId INT, wkb BINARY, srid INT",
    "geo_rel": "archive STRING, ObjectId BIGINT, GeoObjectId BIGINT",
    "attribute": "archive STRING, AttributeId BIGINT, MetaId INT, ObjectId BIGINT, Label STRING",
    "attribute_value": "archive STRING, AttributeValueId BIGINT, AttributeId BIGINT, Value STRING, "
    "Unit STRING",
    "attribute_def": "archive STRING, MetaId INT, Label STRING, MultipleAllowed BOOLEAN, "
    "FreeValueAllowed BOOLEAN, NotNull BOOLEAN, DataType STRING, Unit STRING, Length SMALLINT",
    "free_text": "archive STRING, AttributeId BIGINT, Text STRING",
    "binary_value": "archive STRING, AttributeId BIGINT, Value BINARY, Reference STRING, "
    "MimeType STRING",
    "definition": "archive STRING, MetaId INT, VersionReferenceId INT, Name STRING, "
    "Description STRING, ToolTip STRING, Help STRING, ExternalId INT, IsSystemDefinition BOOLEAN",
    "alternative_def": "archive STRING, MetaId INT, AttributeDefId INT, Value STRING",
    "geo_object_def": "archive STRING, MetaId INT, Code STRING, Type STRING, IsVisible BOOLEAN",
    "object_def": "archive STRING, MetaId INT, Code STRING, PublicId BIGINT, Color INT, "
    "CanAddAttribute BOOLEAN, IsVisible BOOLEAN",
    "sub_class_def": "archive STRING, MetaId INT, ClassId INT",
    "relation_def": "archive STRING, MetaId INT, ParentText STRING, ChildText STRING, "
    "Equal BOOLEAN, RelationTypeDefId INT",
    "object_rel": "archive STRING, ParentId BIGINT, ChildId BIGINT, MetaId INT",
    "event": "archive STRING, EventId BIGINT, ObjectId BIGINT, Time TIMESTAMP_NTZ, "
    "Description STRING",
    "region": "namn STRING, lan STRING, wkb BINARY, srid INT",
    "zone": "eez_name STRING, wkb BINARY, srid INT",
    "manifest": "archive STRING, step STRING, version INT, status STRING, message STRING, "
    "updated_at TIMESTAMP",
}

# Class ids of objects.
CLASS_PROJECT = 1
CLASS_MONUMENT = 2
CLASS_TRENCH = 9
CLASS_SURVEYED = 11

# Definition ids of attributes.
META_SAMPLE = 131
META_FIND = 119
META_FIND_TYPE = 122
META_SRID = 489
META_SITE_MARKER = 69

# Definition ids of geometries.
META_POINTS = (38, 39)
META_POLYLINE = 76
META_POLYGON = 80

# Sub-classes whose objects act as groups, and classes that never do.
GROUP_SUBCLASSES = (52, 10394, 9906)
NON_GROUP_CLASSES = (3, 19, 21, 14, 15)

# Relation text that marks provenance rather than a link between features.
CREATES_TEXT = "Skapar"

MEASUREMENT_IMPORT = "Import from Measurement File"

# Databases of a server that hold no archive (fixed values); a server's own working
# databases are added by the caller.
SYSTEM_ARCHIVES = (
    "postgres",
    "template0",
    "template1",
    "postgis_db",
    "postgis20",
    "template_postgis_20",
    "m20007",
    "m200123",
    "v20012",
)

TARGET_SRID = 3006
