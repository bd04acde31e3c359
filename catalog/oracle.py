"""The registered queries once more, as SQL over the generic test tables."""

from __future__ import annotations

from trowel.sources import testdata as D


def _values(rows):
    return ", ".join("(" + ", ".join(repr(v) for v in row) + ")" for row in rows)


def _dictionary(name, columns, rows, select):
    return (f"{name} AS (SELECT n.archive, {select} FROM nat n, "
            f"(VALUES {_values(rows)}) v({columns}))")


# The core tables of every archive.
ARCHIVE_TABLES = (
    "object", "geo_object", "geo_rel", "attribute", "attribute_value", "attribute_def", "free_text",
    "binary_value", "definition", "alternative_def", "geo_object_def", "object_def", "sub_class_def",
    "relation_def", "object_rel", "event")

# Geometries are kept as numbers: kind, x0, y0, x1, y1.
PREFIX = f"""
WITH nat AS (SELECT 'nation_' || n_nationkey AS archive, n_nationkey AS k, n_name, n_regionkey
             FROM nation),
cus AS (SELECT 'nation_' || c_nationkey AS archive, c_custkey AS k, c_name, c_acctbal,
               c_mktsegment FROM customer),
ord AS (SELECT c.archive, o_orderkey AS k, o_custkey, o_orderstatus, o_orderpriority
        FROM orders JOIN cus c ON o_custkey = c.k),
doc AS (SELECT o.archive, doc_id, text, o.o_custkey FROM documents JOIN ord o ON doc_id = o.k),
pag AS (SELECT o.archive, page_id, html FROM pages JOIN ord o ON page_id = o.k),
object AS (
  SELECT archive, 1::BIGINT AS "ObjectId", 1 AS "ClassId", NULL::INT AS "SubClassId",
         1::BIGINT AS "PublicId", n_name AS "Name", NULL::BIGINT AS "SiteId",
         NULL::INT AS "Origin" FROM nat
  UNION ALL
  SELECT archive, 10 + 5 * k, 9, CASE WHEN c_mktsegment = 'BUILDING' THEN 52 ELSE 183 END,
         1010 + 5 * k, c_name, 1, NULL FROM cus
  UNION ALL
  SELECT archive, 11 + 5 * k, CASE o_orderstatus WHEN 'F' THEN 11 WHEN 'O' THEN 2 ELSE 3 END,
         10000 + CAST(substr(o_orderpriority, 1, 1) AS INT), 1011 + 5 * k,
         CASE WHEN k % 13 <> 0 THEN 'A' || k END, 1, NULL FROM ord),
geo_rel AS (
  SELECT archive, 10 + 5 * k AS "ObjectId", 12 + 5 * k AS "GeoObjectId" FROM cus WHERE k % 10 <> 0
  UNION ALL SELECT archive, 11 + 5 * k, 13 + 5 * k FROM ord WHERE k % 3 = 0
  UNION ALL SELECT archive, 11 + 5 * k, 14 + 5 * k FROM ord WHERE k % 30 = 0),
geo_object AS (
  SELECT archive, id AS "ObjectId", m AS "MetaId", (k % 4)::INT AS "SymbolId", side, 3006 AS srid,
         CASE WHEN k % 50 <> 1 THEN 500000 + (k % 97) * 10 END AS x,
         CASE WHEN k % 50 <> 1 THEN 6500000 + (k % 89) * 10 END AS y
  FROM (SELECT archive, 12 + 5 * k AS id, 38 AS m, k, 0 AS side FROM cus WHERE k % 10 <> 0
        UNION ALL SELECT archive, 13 + 5 * k, 80, k, 5 FROM ord WHERE k % 39 <> 0 AND k % 3 = 0
        UNION ALL SELECT archive, 14 + 5 * k, 80, k, 5 FROM ord
                  WHERE k % 39 <> 0 AND k % 30 = 0)),
geo_text AS (SELECT *, CASE WHEN x IS NULL THEN NULL
    WHEN side = 0 THEN 'POINT(' || x || ' ' || y || ')'
    ELSE 'POLYGON((' || x || ' ' || y || ',' || (x + 5) || ' ' || y || ',' || (x + 5) || ' '
         || (y + 5) || ',' || x || ' ' || (y + 5) || ',' || x || ' ' || y || '))' END AS wkt
  FROM geo_object),
nation_attribute AS (
  SELECT n.archive, a::BIGINT AS "AttributeId", m AS "MetaId", l AS "Label",
         CASE a WHEN 1 THEN n_name WHEN 2 THEN '2020-01-01' WHEN 3 THEN r_name WHEN 4 THEN ''
                WHEN 5 THEN '3006' ELSE 'S' || k END AS "Value"
  FROM nat n JOIN region ON n_regionkey = r_regionkey,
       (VALUES {_values(D.NATION_ATTRIBUTES)}) v(a, m, l) WHERE a <> 6 OR k % 5 = 0),
attribute AS (
  SELECT archive, "AttributeId", "MetaId", 1::BIGINT AS "ObjectId", "Label" FROM nation_attribute
  UNION ALL SELECT archive, 10 + 5 * k, 119, 10 + 5 * k, 'Segment' FROM cus
  UNION ALL SELECT archive, 11 + 5 * k, 131, 10 + 5 * k, 'Balance' FROM cus
  UNION ALL SELECT archive, 12 + 5 * k, 122, 11 + 5 * k, 'Typ' FROM ord
  UNION ALL SELECT archive, 13 + 5 * doc_id, 900, CASE WHEN doc_id % 4 = 1
              THEN 10 + 5 * o_custkey ELSE 11 + 5 * doc_id END, 'Beskrivning' FROM doc
  UNION ALL SELECT archive, 14 + 5 * page_id, 901, 11 + 5 * page_id, 'Bild' FROM pag),
named AS (SELECT o.*, p_name FROM ord o JOIN part
          ON p_partkey = o.k % (SELECT count(*) FROM part)),
attribute_value AS (
  SELECT archive, "AttributeId" * 2 AS "AttributeValueId", "AttributeId", "Value",
         NULL::VARCHAR AS "Unit" FROM nation_attribute
  UNION ALL SELECT archive, 20 + 10 * k, 10 + 5 * k, c_mktsegment, NULL FROM cus
  UNION ALL SELECT archive, 22 + 10 * k, 11 + 5 * k,
              CAST(CAST(round(c_acctbal * 100, 0) AS BIGINT) AS VARCHAR), 'kr' FROM cus
  UNION ALL SELECT archive, 24 + 10 * k, 12 + 5 * k,
              CASE WHEN k % 7 = 0 THEN '' WHEN k % 11 = 0 THEN NULL ELSE p_name END,
              CASE k % 3 WHEN 1 THEN '' WHEN 2 THEN 'cm' END FROM named
  UNION ALL SELECT archive, 25 + 10 * k, 12 + 5 * k, 'extra ' || p_name, NULL FROM named
            WHERE k % 5 = 0),
free_text AS (
  SELECT archive, 13 + 5 * doc_id AS "AttributeId",
         CASE WHEN doc_id % 9 = 0 THEN '{{\\rtf1 ' ELSE '{{\\rtf1 \\fs17 ' END
         || replace(replace(replace(text, 'ä', '\\''e4'), 'ö', '\\''f6'), 'å', '\\''e5')
         || CASE WHEN doc_id % 5 = 2 THEN '\\b0 x\\f0\\ul\\par }}' ELSE '\\par }}' END AS "Text"
  FROM doc),
binary_value AS (SELECT archive, 14 + 5 * page_id AS "AttributeId",
  CASE WHEN page_id % 8 <> 0 THEN encode(html) END AS "Value", 'text/html' AS "MimeType" FROM pag),
object_rel AS (
  SELECT archive, 1::BIGINT AS "ParentId", 10 + 5 * k AS "ChildId", 1600 AS "MetaId" FROM cus
  UNION ALL SELECT archive, 10 + 5 * o_custkey, 11 + 5 * k,
    CASE o_orderstatus WHEN 'F' THEN 1601 WHEN 'O' THEN 1602 ELSE 1603 END FROM ord),
event AS (SELECT c.archive, event_id AS "EventId", 10 + 5 * user_id AS "ObjectId", ts AS "Time",
  CASE event_type WHEN 'purchase' THEN 'Import from Measurement File ' || event_id
       WHEN 'view' THEN NULL ELSE event_type END AS "Description"
  FROM events JOIN cus c ON user_id = c.k),
{_dictionary("definition", "m, n", D.DEFINITIONS,
             '''m AS "MetaId", CASE WHEN m % 4 = 0 THEN 1 END AS "VersionReferenceId",
             n AS "Name", CASE WHEN m % 2 = 0 THEN '' ELSE 'd' || m END AS "Description",
             CASE m % 3 WHEN 0 THEN '' WHEN 1 THEN 'h' END AS "Help"''')},
{_dictionary("attribute_def", "m, l", D.ATTRIBUTE_DEFS,
             '''m AS "MetaId", l AS "Label", false AS "MultipleAllowed",
             true AS "FreeValueAllowed", false AS "NotNull", 'text' AS "DataType",
             250::SMALLINT AS "Length"''')},
{_dictionary("relation_def", "m, p, c", D.RELATION_DEFS,
             'm AS "MetaId", p AS "ParentText", c AS "ChildText"')},
{_dictionary("geo_object_def", "m, t", D.GEO_DEFS, 'm AS "MetaId", t AS "Type"')},
{_dictionary("object_def", "m, p", D.OBJECT_DEFS,
             '''m AS "MetaId", 'o' || m AS "Code", p::BIGINT AS "PublicId"''')},
{_dictionary("alternative_def", "m, a, v", D.ALTERNATIVE_DEFS,
             'm AS "MetaId", a AS "AttributeDefId", v AS "Value"')},
{_dictionary("sub_class_def", "m, c", D.SUB_CLASSES, 'm AS "MetaId", c AS "ClassId"')},
region_box AS (SELECT 'parish_' || k AS namn, 'county_' || k % 5 AS lan,
  500000 + (k % 5) * 200 AS x0, 6500000 + (k // 5) * 180 AS y0,
  500000 + (k % 5) * 200 + CASE k WHEN 7 THEN 150 WHEN 12 THEN 250 ELSE 200 END AS x1,
  6500000 + (k // 5) * 180 + 180 AS y1 FROM nat),
zone_box AS (SELECT 'zone_' || k AS eez_name,
  CASE k WHEN 0 THEN 499000 ELSE 500400 END AS x0, 6499000 AS y0,
  CASE k WHEN 0 THEN 500600 ELSE 502000 END AS x1, 6502000 AS y1 FROM nat WHERE k < 2),
manifest AS (SELECT n.archive, v.* FROM nat n, LATERAL (VALUES
  ('validity', NULL::INT, CASE WHEN n.k % 3 <> 0 THEN 'done' ELSE 'failed' END, 1),
  ('layers', (n.k % 4 + 8)::INT, 'done', 1),
  ('layers', (n.k % 4 + 9)::INT, CASE WHEN n.k % 7 = 0 THEN 'failed' ELSE 'done' END, 2),
  ('features', NULL, CASE WHEN n.k % 2 = 0 THEN 'done' END, 1)) v(step, version, status, day)),
last_status AS (SELECT archive, step, version, status FROM manifest
  QUALIFY row_number() OVER (PARTITION BY archive, step ORDER BY day DESC) = 1),
attrs AS (
  SELECT a.archive, a."AttributeId" AS attribute_id, a."MetaId" AS attribute_meta_id,
         a."ObjectId" AS object_id, a."Label" AS attribute_label,
         v."AttributeValueId" AS attributevalue_id,
         v."Value" || ' ' || v."Unit" AS attributevalue_value, d."Name" AS definition_name,
         d."Description" AS definition_description,
         d."VersionReferenceId" AS definition_versionreference,
         l."Value" AS alternative_def_value,
         a."Label" || ': ' || coalesce(v."Value", '') || ' ' || v."Unit" AS text_csv,
         a."Label" || ': ' || nullif(v."Value", '') || ' ' || v."Unit" AS text_table,
         a."Label" || ': ' || coalesce(nullif(v."Value", ''), '<null>') || ' ' || v."Unit"
           AS text_draft
  FROM attribute a JOIN attribute_value v USING (archive, "AttributeId")
  JOIN attribute_def f ON f.archive = a.archive AND f."MetaId" = a."MetaId"
  LEFT JOIN definition d ON d.archive = a.archive AND d."MetaId" = a."MetaId"
  LEFT JOIN alternative_def l ON l.archive = a.archive AND l."MetaId" = a."MetaId"),
view_attributes AS (
  SELECT v.archive, v."AttributeId", "AttributeValueId", v."Unit", "Value",
         m."MetaId" AS attribute_metaid, "ObjectId", m."Label", "MultipleAllowed",
         "FreeValueAllowed", "NotNull", "DataType", "Length"
  FROM attribute_value v LEFT JOIN (
    SELECT a.archive, a."AttributeId", a."MetaId", a."ObjectId", a."Label", "MultipleAllowed",
           "FreeValueAllowed", "NotNull", "DataType", "Length"
    FROM attribute a JOIN attribute_def d ON d.archive = a.archive AND d."MetaId" = a."MetaId") m
  ON m.archive = v.archive AND m."AttributeId" = v."AttributeId"),
edges AS (SELECT r.archive, "ParentId", "ChildId", "ParentText", "ChildText"
  FROM object_rel r JOIN relation_def d ON d.archive = r.archive AND d."MetaId" = r."MetaId"),
described AS (SELECT r.archive, "ParentId", "ChildId", d."Name" AS relation
  FROM object_rel r JOIN definition d ON d.archive = r.archive AND d."MetaId" = r."MetaId"),
texts AS (
  SELECT archive, "AttributeId", regexp_replace(regexp_replace(regexp_replace(body,
      '[\\s\\p{{Z}}]+$', ''), '^ ', ''), '[\\s\\p{{Z}}]+d ', '') AS clean, raw
  FROM (SELECT archive, "AttributeId", {{CLEAN}} AS body, {{CSV}} AS raw FROM free_text)),
owned AS (SELECT t.archive, a."ObjectId" AS object_id, t."AttributeId" AS text_id, clean, raw
  FROM texts t JOIN attribute a ON a.archive = t.archive AND a."AttributeId" = t."AttributeId"),
groups AS (SELECT o.archive, o."ObjectId" AS group_id, o."Name" AS group_name,
    r."ChildId" AS object_id
  FROM object o LEFT JOIN object_rel r ON r.archive = o.archive AND r."ParentId" = o."ObjectId"
  WHERE o."SubClassId" IN (52, 10394, 9906)),
core_any AS (SELECT * FROM (
  SELECT o.archive, o."ObjectId" AS object_id, o."PublicId" AS b_id, o."ClassId", o."SubClassId",
         o."Name" AS object_name, c."Name" AS class, s."Name" AS subclass,
         g."ObjectId" AS geoobject_id, g."MetaId" AS geo_meta, g."SymbolId", g.wkt,
         d."Type" AS spatial_type,
         row_number() OVER (PARTITION BY o.archive, o."ObjectId" ORDER BY r."GeoObjectId") AS n,
         row_number() OVER (PARTITION BY o.archive, o."ObjectId"
           ORDER BY (g."ObjectId" IS NULL OR d."Type" IS NULL), r."GeoObjectId") AS strict_n
  FROM object o JOIN geo_rel r ON r.archive = o.archive AND r."ObjectId" = o."ObjectId"
  LEFT JOIN geo_text g ON g.archive = r.archive AND g."ObjectId" = r."GeoObjectId"
  LEFT JOIN geo_object_def d ON d.archive = g.archive AND d."MetaId" = g."MetaId"
  LEFT JOIN definition c ON c.archive = o.archive AND c."MetaId" = o."ClassId"
  LEFT JOIN definition s ON s.archive = o.archive AND s."MetaId" = o."SubClassId")),
core AS (SELECT * FROM core_any WHERE n = 1),
core_strict AS (SELECT * FROM core_any WHERE strict_n = 1 AND geoobject_id IS NOT NULL
  AND spatial_type IS NOT NULL AND class IS NOT NULL AND subclass IS NOT NULL),
geo_values AS (SELECT a.archive, v."Value" FROM geo_object g
  JOIN geo_rel r ON r.archive = g.archive AND r."GeoObjectId" = g."ObjectId"
  JOIN object o ON o.archive = r.archive AND o."ObjectId" = r."ObjectId"
  JOIN attribute a ON a.archive = o.archive AND a."ObjectId" = o."ObjectId"
  JOIN attribute_value v ON v.archive = a.archive AND v."AttributeId" = a."AttributeId"),
region_hit AS (SELECT g.archive, g."ObjectId" AS object_id, namn, lan FROM geo_object g
  LEFT JOIN region_box b ON g.x <= b.x1 AND g.x + side >= b.x0 AND g.y <= b.y1
    AND g.y + side >= b.y0),
site_values AS (SELECT o.archive, o."ObjectId", o."Name" AS site_name, "AttributeValueId",
    a."Label" || ': ' || v."Value" AS text
  FROM object o JOIN attribute a ON a.archive = o.archive AND a."ObjectId" = o."ObjectId"
  JOIN attribute_value v ON v.archive = a.archive AND v."AttributeId" = a."AttributeId"
  WHERE o."ClassId" = 1),
parsed AS (SELECT archive, text, substr(text, position(': ' IN text) + 2) AS value
  FROM site_values WHERE position(': ' IN text) > 0
  AND length(substr(text, position(': ' IN text) + 2)) > 1),
fields AS (SELECT archive,
  max(value) FILTER (text LIKE 'End date%' OR text LIKE 'Slutdatum%') AS slutdatum,
  max(value) FILTER (text LIKE 'Type of excavation%' OR text LIKE 'Undersökningstyp%')
    AS undersokningstyp,
  max(value) FILTER (text LIKE 'Type of exploatation%' OR text LIKE 'Exploateringstyp%')
    AS exploateringstyp,
  max(value) FILTER (text LIKE 'Projektnamn%' OR text LIKE 'Project name%') AS projektnamn,
  max(value) FILTER (text LIKE 'Projektkod%' OR text LIKE 'Project code%') AS projektkod,
  max(value) FILTER (text LIKE 'Raä Dnr%') AS raa_dnr,
  max(value) FILTER (text LIKE 'Lst Dnr%') AS lst_dnr,
  max(value) FILTER (text LIKE 'Plats%' OR text LIKE 'Place%') AS plats,
  max(value) FILTER (text LIKE 'Site Id%' OR text LIKE 'Undersöknings Id%') AS undersoknings_id
  FROM parsed GROUP BY archive)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _clean_sql(variant: str) -> str:
    from trowel.functions import text as X

    mark = r"(?s)\\fs1\d(.*)" if variant == "clean" else r"(?s)\\fs17 (.*)"
    out = (f"CASE WHEN regexp_matches(\"Text\", {_quoted(mark)}) "
           f"THEN regexp_extract(\"Text\", {_quoted(mark)}, 1) END")
    for escape, letter in X.ACCENTS:
        out = f"replace({out}, {_quoted(escape)}, {_quoted(letter)})"
    marks = X.MARKS if variant == "clean" else [r"\par"]
    for m in marks:
        out = f"replace({out}, {_quoted(m)}, '')"
    if variant == "csv":
        for pattern in X.MARKUP_PATTERNS:
            pattern = pattern.replace(r"\w", r"[\p{L}\p{M}\p{N}_]")
            out = f"regexp_replace({out}, {_quoted(pattern)}, '')"
    return out


PREFIX = PREFIX.replace("{CLEAN}", _clean_sql("clean")).replace("{CSV}", _clean_sql("csv"))


def joined(value: str, order: str) -> str:
    return f"string_agg(coalesce({value}, '∅'), '|' ORDER BY {order})"


FIND = """SELECT a.archive, v."Value" AS find_type, count(*) AS find_count
  FROM attribute a JOIN object o ON o.archive = a.archive AND o."ObjectId" = a."ObjectId"
  LEFT JOIN attribute_value v ON v.archive = a.archive AND v."AttributeId" = a."AttributeId"
  WHERE a."MetaId" = 122 GROUP BY ALL"""

FEATURES = f"""SELECT row_number() OVER (PARTITION BY c.archive ORDER BY c.object_id,
    t.text_id NULLS FIRST, g.group_id NULLS FIRST, gt.text_id NULLS FIRST) AS pk,
  c.archive AS intrasis_archive, c.object_id, {{B_ID}} object_name, class, subclass, wkt AS geom,
  spatial_type, attributes, t.clean AS object_description, group_name,
  gt.clean AS group_description
  FROM core c LEFT JOIN (SELECT archive, object_id,
      coalesce(string_agg(text_table, ',' ORDER BY attributevalue_id), '') AS attributes
      FROM attrs GROUP BY ALL) l ON l.archive = c.archive AND l.object_id = c.object_id
  LEFT JOIN owned t ON t.archive = c.archive AND t.object_id = c.object_id
  LEFT JOIN groups g ON g.archive = c.archive AND g.object_id = c.object_id
  LEFT JOIN owned gt ON gt.archive = g.archive AND gt.object_id = g.group_id"""

SUMMARY = """SELECT s.archive, s.site_name, db_creation_date, start_of_fieldwork,
  end_of_fieldwork, project_ct, omrade_schakt_ct, arch_obj_ct, fornlamn_ct, sample_ct, find_ct,
  point_ct, polygon_ct, polyline_ct, 3006 AS intrasis_srid, 3006 AS likely_srid,
  site_attributes, 0 AS part
  FROM (SELECT archive, site_name, string_agg(coalesce(text, '∅'), '|' ORDER BY
        "AttributeValueId") AS site_attributes FROM site_values GROUP BY ALL) s
  JOIN (SELECT archive, count(*) FILTER ("ClassId" = 1) AS project_ct,
        count(*) FILTER ("ClassId" = 9) AS omrade_schakt_ct,
        count(*) FILTER ("ClassId" = 11) AS arch_obj_ct,
        count(*) FILTER ("ClassId" = 2) AS fornlamn_ct FROM object GROUP BY ALL) USING (archive)
  JOIN (SELECT archive, count(*) FILTER ("MetaId" = 131) AS sample_ct,
        count(*) FILTER ("MetaId" = 119) AS find_ct FROM attribute GROUP BY ALL) USING (archive)
  LEFT JOIN (SELECT archive, count(*) FILTER ("MetaId" IN (38, 39)) AS point_ct,
        count(*) FILTER ("MetaId" = 80) AS polygon_ct,
        count(*) FILTER ("MetaId" = 76) AS polyline_ct FROM geo_object GROUP BY ALL)
        USING (archive)
  LEFT JOIN (SELECT archive, min(strftime("Time", '%Y-%m')) AS db_creation_date,
        min(strftime("Time", '%Y-%m')) FILTER ("Description" LIKE 'Import from%')
          AS start_of_fieldwork,
        max(strftime("Time", '%Y-%m')) FILTER ("Description" LIKE 'Import from%')
          AS end_of_fieldwork FROM event GROUP BY ALL) USING (archive)"""

QUERIES = {
    # sources
    "archive_list": "SELECT DISTINCT archive FROM object",
    "read_archives": " UNION ALL ".join(
        f"SELECT archive, '{name}' AS name, count(*) AS n FROM {name} GROUP BY ALL" for name in ARCHIVE_TABLES),
    "read_reference_layer": """SELECT namn, lan, x0::BIGINT AS x0, y0::BIGINT AS y0,
        x1::BIGINT AS x1, y1::BIGINT AS y1 FROM region_box""",
    "pending_archives": """SELECT archive FROM (SELECT DISTINCT archive FROM object) WHERE archive
        NOT IN (SELECT archive FROM last_status WHERE step = 'layers' AND status = 'done'
                AND version >= 10) ORDER BY archive""",
    "pending_by_except": """SELECT DISTINCT archive FROM object EXCEPT
        SELECT archive FROM last_status WHERE step = 'validity' AND status = 'done'""",
    "pending_by_output": """SELECT DISTINCT archive FROM object WHERE archive NOT IN
        (SELECT archive FROM attribute WHERE "MetaId" = 69 GROUP BY ALL HAVING count(*) > 1)""",
    "table_inventory": """SELECT archive, string_agg(name, '|' ORDER BY name) AS table_array,
        count(*) AS table_ct FROM (""" + " UNION ".join(
            f"SELECT archive, '{name}' AS name FROM {name}" for name in ARCHIVE_TABLES) + ") GROUP BY ALL",
    # sinks
    "write_csv": FIND,
    "write_json_table": """SELECT archive, count("Value") AS blob_count,
        coalesce(sum(octet_length("Value")), 0)::BIGINT AS blob_bytes
        FROM binary_value GROUP BY ALL""",
    "create_features_table": FEATURES.replace("{B_ID}", "b_id,"),
    "insert_if_absent": FIND,
    "update_from": """SELECT r.archive, r."ObjectId", coalesce(n.c, 0)::BIGINT AS links
        FROM object r LEFT JOIN (SELECT archive, "ParentId", count(*) AS c FROM object_rel
        GROUP BY ALL) n ON n.archive = r.archive AND n."ParentId" = r."ObjectId\"""",
    "update_status": """SELECT archive, 'features' AS step, 2 AS version, 'done' AS status
        FROM (SELECT DISTINCT archive FROM object) UNION ALL
        SELECT archive, step, version, status FROM last_status WHERE step <> 'features'""",
    "error_rows": """SELECT archive, 'read' AS outcome, count(*) AS n FROM geo_object
        GROUP BY ALL UNION ALL SELECT archive, 'failed', count(*) FROM binary_value
        WHERE "Value" IS NOT NULL GROUP BY ALL""",
    "export_blobs": """SELECT archive, "AttributeId" AS attribute_id,
        octet_length("Value")::BIGINT AS bytes FROM binary_value WHERE "Value" IS NOT NULL""",
    "incremental_class_counts": """SELECT archive, count(*) FILTER ("ClassId" = 11) AS surveyed
        FROM object GROUP BY ALL""",
    # attributes and relations
    "object_attributes": "SELECT * FROM view_attributes",
    "objects_and_attributes": """SELECT o.*, "AttributeId", "AttributeValueId", v."Unit", v."Value",
        attribute_metaid, v."Label", "DataType", "Length" FROM object o LEFT JOIN view_attributes v
        ON v.archive = o.archive AND v."ObjectId" = o."ObjectId\"""",
    "attr_detail": """SELECT archive, attribute_id, attribute_meta_id, object_id, attribute_label,
        attributevalue_id, attributevalue_value, definition_name, definition_description,
        definition_versionreference, alternative_def_value, text_csv AS attributevalue
        FROM attrs""",
    "attr_text": """SELECT archive, attributevalue_id, text_csv, text_table, text_draft,
        attribute_label || ': ' || CASE WHEN v."Value" = '' THEN 'no data' ELSE v."Value" END
          AS text_view FROM attrs JOIN attribute_value v USING (archive)
        WHERE v."AttributeValueId" = attributevalue_id""",
    "value_with_unit": """SELECT archive, "AttributeValueId", "Value" || ' ' || "Unit"
        AS value_with_unit FROM attribute_value""",
    "attr_arrays": f"""SELECT archive, object_id, {joined('text_csv', 'attributevalue_id')}
        AS attr_array, 0 AS part FROM attrs GROUP BY ALL""",
    "attributes_layer": """SELECT a.archive, a."ObjectId" AS object_id,
        a."Label" AS attribute_label, v."Value" || ' ' || v."Unit" AS attribute_value
        FROM attribute a JOIN attribute_value v ON v.archive = a.archive
          AND v."AttributeId" = a."AttributeId"
        JOIN geo_rel r ON r.archive = a.archive AND r."ObjectId" = a."ObjectId\"""",
    "parent_relations": f"""SELECT archive, "ParentId" AS object_id,
        {joined('''"ParentText" || ' ' || "ChildId"''', '"ChildId"')} AS parent_relations, 0 AS part
        FROM edges GROUP BY ALL""",
    "child_relations": f"""SELECT archive, "ChildId" AS object_id,
        {joined('''"ChildText" || ' ' || "ParentId"''', '"ParentId"')} AS child_relations, 0 AS part
        FROM edges GROUP BY ALL""",
    "relation_arrays_described": f"""SELECT archive, object_id, max(p) AS parent_relations,
        max(c) AS child_relations FROM (
        SELECT archive, "ChildId" AS object_id, {joined("""'parent: ' || "ParentId"
          || ', relationship type: ' || relation""", '"ParentId"')} AS p, NULL AS c
          FROM described GROUP BY ALL
        UNION ALL SELECT archive, "ParentId", NULL, {joined("""'child: ' || "ChildId"
          || ', relationship type: ' || relation""", '"ChildId"')}
          FROM described GROUP BY ALL) GROUP BY ALL""",
    "relations_layer": """SELECT archive, "ParentId" AS parent_id, "ChildId" AS child_id,
        "ParentText" AS parent_text, "ChildText" AS child_text FROM edges
        WHERE "ParentText" <> 'Skapar'""",
    "group_members": "SELECT archive, group_id, group_name, object_id FROM groups",
    "groups_layer": """SELECT o.archive, o."ObjectId" AS group_id, o."Name" AS group_name,
        t.clean AS converted_text FROM (
          SELECT archive, "ObjectId" FROM object WHERE "ClassId" NOT IN (3, 19, 21, 14, 15)
          EXCEPT SELECT archive, "ObjectId" FROM geo_rel
          UNION SELECT archive, "GeoObjectId" FROM geo_rel) c
        JOIN object o ON o.archive = c.archive AND o."ObjectId" = c."ObjectId"
        JOIN (SELECT DISTINCT r.archive, "ParentId" FROM object_rel r JOIN geo_rel g
              ON g.archive = r.archive AND g."ObjectId" = r."ChildId") l
          ON l.archive = c.archive AND l."ParentId" = c."ObjectId"
        JOIN (SELECT archive, object_id, arg_min([clean], text_id)[1] AS clean FROM owned
              GROUP BY ALL) t ON t.archive = c.archive AND t.object_id = c."ObjectId\"""",
    "object_definitions": """SELECT o.archive, o."PublicId", o."Code", d."Name" AS definition,
        d."Description" AS definition_description, d."Help" AS definition_help
        FROM object_def o JOIN definition d ON d.archive = o.archive AND d."MetaId" = o."MetaId\"""",
    "definitions_by_id": """SELECT archive, 'definition' AS source, "MetaId", "Name" AS text
          FROM definition WHERE "MetaId" IN (122, 183, 10004)
        UNION ALL SELECT archive, 'alternative_def', "MetaId", "Value" FROM alternative_def
          WHERE "MetaId" IN (122, 183, 10004)
        UNION ALL SELECT archive, 'attribute', "MetaId", "Label" FROM attribute
          WHERE "MetaId" IN (122, 183, 10004)
        UNION ALL SELECT archive, 'attribute_def', "MetaId", "Label" FROM attribute_def
          WHERE "MetaId" IN (122, 183, 10004)
        UNION ALL SELECT archive, 'object_def', "MetaId", "Code" FROM object_def
          WHERE "MetaId" IN (122, 183, 10004)
        UNION ALL SELECT archive, 'sub_class_def', "MetaId", "ClassId"::VARCHAR
          FROM sub_class_def WHERE "MetaId" IN (122, 183, 10004)""",
    "geo_object_attribute_arrays": f"""SELECT o.archive,
        row_number() OVER (PARTITION BY o.archive ORDER BY o."ObjectId", g."ObjectId",
          d."Code" NULLS FIRST) AS row_number,
        o."ObjectId", g."ObjectId" AS geo_object_id, o."ClassId", o."SubClassId", o."PublicId",
        o."Name", coalesce(i.info, '∅') AS attribute_info, d."Code",
        coalesce(d.object_definition, '∅') AS object_definition, p.v AS parent_relations,
        c.v AS child_relations, g.wkt AS the_geom
        FROM object o JOIN geo_rel r ON r.archive = o.archive AND r."ObjectId" = o."ObjectId"
        JOIN geo_text g ON g.archive = r.archive AND g."ObjectId" = r."GeoObjectId"
        LEFT JOIN (SELECT archive, "ObjectId", {joined(""""Label" || ': ' || CASE WHEN "Value" = ''
            THEN 'no data' ELSE "Value" END""", '"AttributeValueId"')} AS info
            FROM view_attributes WHERE "ObjectId" IS NOT NULL GROUP BY ALL) i
          ON i.archive = o.archive AND i."ObjectId" = o."ObjectId"
        LEFT JOIN (SELECT archive, "PublicId", "Code",
            string_agg(coalesce(s, '∅'), '|' ORDER BY s NULLS FIRST) AS object_definition FROM (
              SELECT b.archive, b."PublicId", b."Code", f."Name" || ', description: '
                || CASE WHEN f."Description" = '' THEN 'no description' ELSE f."Description" END
                || ', help: ' || CASE WHEN f."Help" = '' THEN 'no info' ELSE f."Help" END AS s
              FROM object_def b JOIN definition f ON f.archive = b.archive
                AND f."MetaId" = b."MetaId") GROUP BY ALL) d
          ON d.archive = o.archive AND d."PublicId" = o."PublicId"
        LEFT JOIN (SELECT archive, "ChildId" AS id, {joined("""'parent: ' || "ParentId"
            || ', relationship type: ' || relation""", '"ParentId"')} AS v
            FROM described GROUP BY ALL) p ON p.archive = o.archive AND p.id = o."ObjectId"
        LEFT JOIN (SELECT archive, "ParentId" AS id, {joined("""'child: ' || "ChildId"
            || ', relationship type: ' || relation""", '"ChildId"')} AS v
            FROM described GROUP BY ALL) c ON c.archive = o.archive AND c.id = o."ObjectId\"""",
    # exports
    "feature_core": """SELECT archive, object_id, b_id AS object_public_id,
        "ClassId" AS object_class_id, "SubClassId" AS object_subclass_id, object_name, class,
        subclass, geoobject_id, geo_meta AS geoobject_meta_id, "SymbolId" AS geoobject_symbol_id,
        spatial_type FROM core""",
    "feature_core_strict": """SELECT archive, object_id, b_id AS object_public_id,
        "ClassId" AS object_class_id, "SubClassId" AS object_subclass_id, object_name, class,
        subclass, geoobject_id, geo_meta AS geoobject_meta_id, "SymbolId" AS geoobject_symbol_id,
        spatial_type FROM core_strict""",
    "features_table": FEATURES.replace("{B_ID}", "b_id,"),
    "features_table_v1": FEATURES.replace("{B_ID}", ""),
    "features_csv": f"""SELECT row_number() OVER (PARTITION BY c.archive ORDER BY c.object_id,
          t.text_id NULLS FIRST, g.group_id NULLS FIRST, gt.text_id NULLS FIRST) AS pk,
        s.site_name, f.slutdatum, f.projektnamn, f.projektkod, f.plats,
        f.undersoknings_id, c.archive AS intrasis_archive, c.object_id, object_name, class,
        subclass, 'SRID=3006;' || wkt AS geom_wkt, spatial_type, l.v AS attr_array,
        p.v AS parent_relations, k.v AS child_relations, t.raw AS feature_description,
        group_name, gt.raw AS group_description
        FROM core_strict c LEFT JOIN (SELECT archive, object_id,
            {joined('text_csv', 'attributevalue_id')} AS v FROM attrs GROUP BY ALL) l
          ON l.archive = c.archive AND l.object_id = c.object_id
        LEFT JOIN (SELECT archive, "ParentId" AS id, {joined('''"ParentText" || ' '
            || "ChildId"''', '"ChildId"')} AS v FROM edges GROUP BY ALL) p
          ON p.archive = c.archive AND p.id = c.object_id
        LEFT JOIN (SELECT archive, "ChildId" AS id, {joined('''"ChildText" || ' '
            || "ParentId"''', '"ParentId"')} AS v FROM edges GROUP BY ALL) k
          ON k.archive = c.archive AND k.id = c.object_id
        LEFT JOIN owned t ON t.archive = c.archive AND t.object_id = c.object_id
        LEFT JOIN groups g ON g.archive = c.archive AND g.object_id = c.object_id
        LEFT JOIN owned gt ON gt.archive = g.archive AND gt.object_id = g.group_id
        LEFT JOIN (SELECT DISTINCT archive, site_name FROM site_values) s
          ON s.archive = c.archive
        LEFT JOIN fields f ON f.archive = c.archive""",
    "project_information": """SELECT 1 AS pk, s.archive, site_name, slutdatum, projektnamn,
        projektkod, plats, undersoknings_id FROM (SELECT DISTINCT archive, site_name
        FROM site_values) s LEFT JOIN fields f USING (archive)""",
    "object_texts": """SELECT archive, object_id, text_id, clean AS description FROM owned""",
    # site
    "site_summary": SUMMARY,
    "site_attributes": f"""SELECT archive, "ObjectId", site_name,
        {joined('text', '"AttributeValueId"')} AS site_attributes FROM site_values GROUP BY ALL""",
    "project_count": """SELECT archive, count(*) FILTER ("ClassId" = 1) AS project_count
        FROM object GROUP BY ALL""",
    "attribute_counts": """SELECT archive, count("Label") FILTER ("MetaId" = 131) AS sample_count,
        count("Label") FILTER ("MetaId" = 119) AS find_count FROM attribute GROUP BY ALL""",
    "class_counts": """SELECT archive, count(*) FILTER ("ClassId" = 11)
        AS surveyed_arch_object_count, count(*) FILTER ("ClassId" = 2) AS fornlamning_count,
        count(*) FILTER ("ClassId" = 9) AS omrade_or_schakt_count FROM object GROUP BY ALL""",
    "spatial_type_counts": """SELECT archive, count(*) FILTER ("MetaId" IN (38, 39)) AS point_count,
        count(*) FILTER ("MetaId" = 80) AS polygon_count,
        count(*) FILTER ("MetaId" = 76) AS polyline_count
        FROM geo_object GROUP BY ALL""",
    "fieldwork_dates": """SELECT archive, min(strftime("Time", '%Y-%m')) AS db_creation_date,
        min(strftime("Time", '%Y-%m')) FILTER ("Description" LIKE 'Import from Measurement File%')
          AS start_of_fieldwork,
        max(strftime("Time", '%Y-%m')) FILTER ("Description" LIKE 'Import from Measurement File%')
          AS end_of_fieldwork FROM event GROUP BY ALL""",
    "site_extent": """SELECT archive, (max(x + side / 2) - min(x + side / 2))::DOUBLE
        AS x_dispersion, (max(y + side / 2) - min(y + side / 2))::DOUBLE AS y_dispersion
        FROM geo_object WHERE x IS NOT NULL GROUP BY ALL""",
    "recorded_srid": """SELECT archive, TRY_CAST(arg_min("Value", "AttributeValueId") AS INT)
        AS intrasis_srid FROM attribute JOIN attribute_value USING (archive, "AttributeId")
        WHERE "MetaId" = 489 GROUP BY ALL""",
    "multi_project_check": """SELECT archive, count(*) AS site_markers FROM attribute
        WHERE "MetaId" = 69 GROUP BY ALL HAVING count(*) > 1""",
    "unnest_site_attributes": "SELECT * FROM fields",
    "node_edge_count": """SELECT archive, coalesce(n, 0) AS node_count, coalesce(e, 0) AS edge_count
        FROM (SELECT DISTINCT archive FROM object)
        LEFT JOIN (SELECT archive, count(x) AS n FROM geo_object GROUP BY ALL) USING (archive)
        LEFT JOIN (SELECT archive, count(*) AS e FROM object_rel GROUP BY ALL) USING (archive)""",
    "blob_metrics": f"""SELECT *, CASE {" ".join(
            f"WHEN blob_bytes >= {10 * 1024 ** p} THEN round(blob_bytes / {1024 ** p})::BIGINT || ' {u}'"
            for p, u in ((5, "PB"), (4, "TB"), (3, "GB"), (2, "MB"), (1, "kB")))}
          ELSE blob_bytes || ' bytes' END AS blob_storage_size
        FROM (SELECT archive, "MimeType", count("Value") AS blob_count,
          coalesce(sum(octet_length("Value")), 0)::BIGINT AS blob_bytes FROM binary_value GROUP BY ALL)""",
    # counting
    "find_count": FIND,
    "select_finds": """SELECT o.*, a."AttributeId", a."MetaId", a."Label", v."AttributeValueId",
        v."Value" FROM attribute a JOIN object o ON o.archive = a.archive
          AND o."ObjectId" = a."ObjectId" LEFT JOIN attribute_value v ON v.archive = a.archive
          AND v."AttributeId" = a."AttributeId" WHERE a."MetaId" = 122""",
    "attribute_values": 'SELECT DISTINCT "Value" AS value FROM attribute_value',
    "geo_attribute_values": 'SELECT DISTINCT "Value" AS value FROM geo_values',
    "feature_count": """SELECT archive, feature, feature_count, round(feature_count::DECIMAL(20,10)
          / greatest(total_features, 1), 2)::FLOAT AS feature_proportion, total_features FROM (
        SELECT o.archive, '0. all postholes' AS feature,
          count(g."Value") FILTER (regexp_matches(g."Value", '(?i)bolt|ring')) AS feature_count,
          count(g.archive) AS total_features
          FROM (SELECT DISTINCT archive FROM object) o LEFT JOIN geo_values g USING (archive)
          GROUP BY ALL
        UNION ALL SELECT archive, "Value", count(*), any_value(t) FROM geo_values
          JOIN (SELECT archive, count(*) AS t FROM geo_values GROUP BY ALL) USING (archive)
          WHERE regexp_matches("Value", '(?i)bolt|ring') GROUP BY archive, "Value")""",
    "value_status": """SELECT DISTINCT "Value" AS value, CASE WHEN regexp_matches("Value",
        '(?i)bolt|ring') THEN '1. value used to define posthole features'
        ELSE '0. value not used' END AS extraction_status FROM attribute_value""",
    "value_histogram": """SELECT "Value", count(*) AS value_occurrence FROM attribute_value
        WHERE "Value" ILIKE '%b_l%' GROUP BY ALL""",
    "histogram_difference": """SELECT "Value", count(*) AS value_occurrence FROM attribute_value
          WHERE "Value" ILIKE '%r_n%' GROUP BY ALL
        EXCEPT SELECT "Value", count(*) FROM attribute_value
          WHERE regexp_matches("Value", '(?i)red|hot') GROUP BY ALL""",
    "keyword_distance": """SELECT archive, pk, min(levenshtein(upper(word), 'GIZMO'))::INT
          AS distance, arg_min(word, {'d': levenshtein(upper(word), 'GIZMO'), 'w': word}) AS word FROM (SELECT archive, "AttributeValueId" AS pk,
            unnest(regexp_extract_all("Value", '[A-Za-z0-9_]+|[^A-Za-z0-9_]+')) AS word
          FROM attribute_value) WHERE length(word) > 3
        AND levenshtein(upper(word), 'GIZMO') < 11 GROUP BY ALL""",
    # text
    "clean_text": """SELECT archive, "AttributeId", clean AS converted_text FROM texts""",
    "clean_text_csv": """SELECT archive, "AttributeId", raw AS converted_text FROM texts""",
    "clean_text_span": """SELECT archive, "AttributeId", CASE WHEN doc_end > 0 AND doc_end >= start
          THEN {SPAN} WHEN doc_end > 0 AND start IS NOT NULL THEN '' END AS converted_text FROM (
        SELECT archive, "AttributeId", position('\\par' IN "Text") AS doc_end,
          position(nullif(regexp_extract("Text", '[\\p{L}\\p{N}_]{2}\\d{2} [\\p{L}\\p{N}_]'), '')
            IN "Text") + 5 AS start,
          replace(replace(replace("Text", '\\''e4', 'ä'), '\\''f6', 'ö'), '\\''e5', 'å') AS body
        FROM free_text)""",
    # spatial
    "validity_report": """SELECT DISTINCT archive, 0::BIGINT AS invalid_count,
        'No invalid objects found' AS invalid_objects, 0 AS part FROM object""",
    "validity_report_shapes": """SELECT archive, count(*) FILTER (bad) AS invalid_count,
        coalesce(string_agg("ObjectId"::VARCHAR, ',' ORDER BY "ObjectId") FILTER (bad),
                 'No invalid objects found') AS invalid_objects, 0 AS part
        FROM (SELECT DISTINCT archive FROM object) LEFT JOIN (
            SELECT archive, "ObjectId", "ObjectId" % 9 IN (1, 2, 3, 4, 5) AS bad FROM geo_object)
        USING (archive) GROUP BY ALL""",
    "normalize_geometry_shapes": """SELECT archive, "ObjectId", "ObjectId" % 9 IN (2, 7) AS repaired,
        "ObjectId" % 9 IN (1, 3, 4, 5) AS still_invalid FROM geo_object""",
    "force_2d_shapes": """SELECT archive, "ObjectId", CASE "ObjectId" % 9
        WHEN 0 THEN 'POLYGON((0 0,8 0,8 8,0 8,0 0))'
        WHEN 1 THEN 'POLYGON((0 0,8 8,8 0,0 8,0 0))'
        WHEN 2 THEN 'POLYGON((0 0,8 0,8 8,0 8))'
        WHEN 3 THEN 'MULTIPOLYGON(((0 0,8 0,8 8,0 8,0 0)),((0 0,8 0,8 8,0 8,0 0)))'
        WHEN 4 THEN 'POLYGON((0 0,8 0,8 8,0 8,0 0),(0 2,4 2,4 6,0 6,0 2))'
        WHEN 5 THEN 'POLYGON((0 0,8 0,8 8,0 8,0 0),(2 2,6 2,6 6,2 6,2 2),(3 3,5 3,5 5,3 5,3 3))'
        WHEN 6 THEN 'GEOMETRYCOLLECTION(POLYGON((0 0,8 0,8 8,0 8,0 0)),POLYGON((2 2,6 2,6 6,2 6,2 2)))'
        WHEN 7 THEN 'POLYGON((0 0,0 0,8 0,8 8,0 8,0 0))'
        WHEN 8 THEN 'POINT(1 2)' END AS wkt FROM geo_object""",
    "force_2d_raised_shapes": """SELECT archive, "ObjectId", CASE "ObjectId" % 9
        WHEN 0 THEN 'POLYGON((0 0,8 0,8 8,0 8,0 0))'
        WHEN 1 THEN 'POLYGON((0 0,8 8,8 0,0 8,0 0))'
        WHEN 2 THEN 'POLYGON((0 0,8 0,8 8,0 8))'
        WHEN 3 THEN 'MULTIPOLYGON(((0 0,8 0,8 8,0 8,0 0)),((0 0,8 0,8 8,0 8,0 0)))'
        WHEN 4 THEN 'POLYGON((0 0,8 0,8 8,0 8,0 0),(0 2,4 2,4 6,0 6,0 2))'
        WHEN 5 THEN 'POLYGON((0 0,8 0,8 8,0 8,0 0),(2 2,6 2,6 6,2 6,2 2),(3 3,5 3,5 5,3 5,3 3))'
        WHEN 6 THEN 'GEOMETRYCOLLECTION(POLYGON((0 0,8 0,8 8,0 8,0 0)),POLYGON((2 2,6 2,6 6,2 6,2 2)))'
        WHEN 7 THEN 'POLYGON((0 0,0 0,8 0,8 8,0 8,0 0))'
        WHEN 8 THEN 'POINT(1 2)' END AS wkt FROM geo_object""",
    "likely_srid": "SELECT DISTINCT archive, 3006 AS likely_srid FROM object",
    "srid_intersect": """SELECT archive, CASE WHEN count(namn) > 0 THEN 3006 END AS srid
        FROM object LEFT JOIN region_hit USING (archive) GROUP BY ALL""",
    "same_geometry": f"""SELECT archive, wkt, {joined('"ObjectId"::VARCHAR', '"ObjectId"')}
        AS object_ids, count(*) AS occurrence, 0 AS part FROM geo_text GROUP BY ALL""",
    "same_geometry_all": """SELECT wkt, string_agg(DISTINCT archive, '|' ORDER BY archive)
        AS databases, count(DISTINCT archive)::INT AS db_occurrence FROM geo_text GROUP BY ALL""",
    "geometry_intersects": """SELECT a.wkt, b.wkt AS intersects, b.dbs AS intersect_dbs
        FROM (SELECT DISTINCT wkt, x, y, side FROM geo_text WHERE x IS NOT NULL) a
        JOIN (SELECT wkt, x, y, side, string_agg(DISTINCT archive, ',' ORDER BY archive) AS dbs
              FROM geo_text WHERE x IS NOT NULL GROUP BY ALL) b
        ON a.wkt <> b.wkt AND a.x <= b.x + b.side AND a.x + a.side >= b.x
        AND a.y <= b.y + b.side AND a.y + a.side >= b.y""",
    "objects_in_region": f"""SELECT *, row_number() OVER (PARTITION BY archive
          ORDER BY objects_in_lan DESC, lan NULLS LAST) AS count_rank FROM (
        SELECT archive, lan, count(*) AS objects_in_lan,
          {joined('object_id::VARCHAR', 'object_id')} AS object_ids
        FROM region_hit GROUP BY ALL)""",
    "region_union": """SELECT archive, "ObjectId" FROM geo_object g WHERE EXISTS (
        SELECT 1 FROM zone_box b WHERE g.x <= b.x1 AND g.x + side >= b.x0
        AND g.y <= b.y1 AND g.y + side >= b.y0)""",
    "apply_geometry_fixes": """SELECT archive, "ObjectId", CASE WHEN "ObjectId" % 10 = 2 THEN
        'POINT(1 ' || "ObjectId" || ')' WHEN "ObjectId" % 10 = 3 THEN 'POINT(2 2)'
        ELSE wkt END AS wkt FROM geo_text""",
    "force_2d": """SELECT archive, "ObjectId", wkt FROM geo_text""",
    "normalize_geometry": """SELECT archive, "ObjectId", wkt, false AS repaired,
        false AS still_invalid FROM geo_text""",
    "geom_to_wkt": """SELECT archive, "ObjectId", wkt, 'SRID=3006;' || wkt AS ewkt FROM geo_text""",
    "geom_measures": """SELECT archive, "ObjectId", srid, CASE WHEN x IS NULL THEN NULL WHEN side = 0
        THEN 1 ELSE 3 END AS gtype, CASE WHEN x IS NULL THEN NULL WHEN side = 0 THEN 1 ELSE 5 END
        AS npoints, x::DOUBLE AS xmin, y::DOUBLE AS ymin, (x + side)::DOUBLE AS xmax,
        (y + side)::DOUBLE AS ymax, (x + side / 2)::DOUBLE AS cx, (y + side / 2)::DOUBLE AS cy
        FROM geo_object""",
    "reproject": """SELECT archive, "ObjectId", wkt FROM geo_text""",
}

_SPAN = "substr(body, start, doc_end - start)"


def _span_sql() -> str:
    from trowel.functions import text as X

    out = f"replace({_SPAN}, '\\par', '')"
    for pattern in X.MARKUP_PATTERNS:
        pattern = pattern.replace(r"\w", r"[\p{L}\p{M}\p{N}_]")
        out = f"regexp_replace({out}, {_quoted(pattern)}, '')"
    return out


QUERIES["clean_text_span"] = QUERIES["clean_text_span"].replace("{SPAN}", _span_sql())


# The layers' columns, in the order in which `write_layers` joins them to a text.
LAYER_COLUMNS = {
    "features": ("pk", "object_id", "b_id", "object_name", "class", "subclass", "geom", "spatial_type", "attributes",
                 "object_description", "group_name", "group_description"),
    "project_information": ("pk", "site_name", "slutdatum", "projektnamn", "projektkod", "plats", "undersoknings_id"),
    "object_relations": ("parent_id", "child_id", "parent_text", "child_text"),
    "groups": ("group_id", "group_name", "converted_text"),
    "attributes": ("object_id", "attribute_label", "attribute_value"),
}


def _layer_sql(layer: str, operator: str) -> str:
    text = ", ".join(f"coalesce({c}::VARCHAR, '∅')" for c in LAYER_COLUMNS[layer])
    key = "intrasis_archive" if layer == "features" else "archive"
    return f"SELECT '{layer}' AS layer, {key} AS archive, concat_ws('|', {text}) AS row FROM ({QUERIES[operator]})"


QUERIES["write_layers"] = " UNION ALL ".join(_layer_sql(*pair) for pair in (
    ("features", "features_table"), ("project_information", "project_information"),
    ("object_relations", "relations_layer"), ("groups", "groups_layer"), ("attributes", "attributes_layer")))

# What a run stores is what its operator gives over all archives.
for run, operator in (("run_clean_notes", "clean_text"), ("run_check_validity", "validity_report"),
                      ("run_move_to_target", "reproject"), ("run_compare_geometries", "same_geometry_all"),
                      ("run_compare_partners", "geometry_intersects"), ("run_regions", "objects_in_region")):
    QUERIES[run] = QUERIES[operator]


def oracle_sql() -> dict[str, str]:
    return {name: PREFIX + sql for name, sql in QUERIES.items()}
