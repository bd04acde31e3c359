"""Merkle manifest of a data set: digests rolled up as nested structs, a proof for each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trowel.llm.common import ranked, read, sha256_hex, stored

FANOUT = 3
LEVELS = 5  # levels of the tree in one block: a block holds 243 nodes of the level below it
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def record_digest(*values: Column) -> Column:
    """The digest of a record: each value as its number of UTF-8 bytes, a colon and itself; a
    null is a minus sign, so no two records have one encoding."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return sha256_hex(F.concat(*[part(v) for v in values]))


def _height(nodes: Column) -> Column:
    """How often runs of FANOUT nodes are folded until one is left."""
    return sum((F.when(nodes > FANOUT ** k, 1).otherwise(0) for k in range(1, 39)),
               F.when(nodes > 1, 1).otherwise(0))


def _blocks(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks (keys, block, height, node) of nodes (keys, place, height, node).

    A node is a struct of its digest and its children. The places' digits are grouped away one by
    one, the lowest first, all within the one shuffle by keys and block: the children of each
    group become an array inside their parent. A tree that is already folded keeps its digest.
    """
    digit = [f"digit{k}" for k in range(LEVELS)]
    rows = nodes.select(
        *keys, F.expr(f"place div {FANOUT ** LEVELS}").alias("block"), "height", "node",
        *[F.expr(f"place div {FANOUT ** k} % {FANOUT}").cast("int").alias(d) for k, d in enumerate(digit)])
    rows = rows.repartition(*keys, "block")
    for k, d in enumerate(digit):
        nested = rows.groupBy(*keys, "block", "height", *digit[k + 1:]).agg(
            F.sort_array(F.collect_list(F.struct(d, "node"))).alias("sorted"))
        nested = nested.withColumn("children", F.col("sorted.node"))
        digest = F.when(F.col("height") > k, sha256_hex(F.array_join(F.col("children.digest"), "")))
        rows = nested.select(
            *keys, "block", "height", *digit[k + 1:],
            F.struct(F.coalesce(digest, F.col("children")[0]["digest"]).alias("digest"), "children").alias("node"))
    return stored(rows, "blocks")


def _tiers(nodes: DataFrame, keys: list[str]) -> list[DataFrame]:
    """Blocks of the nodes, blocks of these blocks' digests, and so on to one block a tree."""
    tiers = [_blocks(nodes, keys)]
    while (tiers[-1].agg(F.max("height")).first()[0] or 0) > LEVELS:
        below = tiers[-1]
        tiers.append(_blocks(below.select(
            *keys, F.col("block").alias("place"), F.greatest(F.col("height") - LEVELS, F.lit(0)).alias("height"),
            F.struct(F.col("node.digest").alias("digest"), F.col("block").alias("item")).alias("node")), keys))
    return tiers


def _step(digests: Column, at: Column) -> Column:
    join = lambda part: F.array_join(part, "")
    return F.struct(join(F.slice(digests, F.lit(1), at)).alias("left"),
                    join(F.slice(digests, at + 2, F.lit(FANOUT))).alias("right"))


def _opened(blocks: DataFrame) -> Column:
    """All lowest nodes of a block, each with its way up: ``path`` of the block, and before it a
    step for each level inside."""
    def children(level: int):
        def of(parent: Column) -> Column:
            def child(node: Column, at: Column) -> Column:
                step = F.array(_step(parent["node"]["children"]["digest"], at))
                return F.struct(node.alias("node"), F.when(
                    F.col("height") > level, F.concat(step, parent["path"])).otherwise(parent["path"]).alias("path"))
            return F.transform(parent["node"]["children"], child)
        return of

    found = F.array(F.struct("node", "path"))
    for level in reversed(range(LEVELS)):
        found = F.flatten(F.transform(found, children(level)))
    return F.explode(found)


def _descended(tiers: list[DataFrame], keys: list[str], above: DataFrame) -> DataFrame:
    """From the trees' tops (keys, path, top) down through the tiers to rows (keys, node, path,
    top). The ways from above meet their blocks in one group each, a row of either kind."""
    above = above.withColumn("block", F.lit(0).cast("bigint"))
    for tier in reversed(tiers):
        both = tier.unionByName(above, allowMissingColumns=True)
        met = both.groupBy(*keys, "block").agg(*[
            F.first(c, ignorenulls=True).alias(c) for c in ("height", "node", "path", "top")])
        rows = met.select(*keys, "top", _opened(met).alias("found")).select(
            *keys, "top", "found.node", "found.path")
        above = rows.select(*keys, "top", "path", F.col("node.item").alias("block"))
    return rows


def proofs(rows: DataFrame, group: str, order: str, leaf: str, keep: list[str]) -> DataFrame:
    """A Merkle tree over each group's rows and one over the groups, and each row's proof.

    ``leaf`` holds the rows' digests. In a group they ascend by ``order``; runs of three are folded
    to the digest of their concatenated hex texts until one is left, the subroot. The subroots, by
    group, give the root likewise. Returns ``keep``, leaf, subroot, root and ``proof``: for each
    level from the leaf to the root the digests left and right of the way.

    Ranks are written as digits; blocks of 243 ranks are nested by grouping the digits away, and
    blocks of blocks above them, so no row holds more than 243 leaves whatever a group's share. The
    finished nests are opened from the top, each block meeting the way above it in a group: no joins.

    Defined cases: a null group is a group of its own and comes first, as does a null order; equal
    orders are placed by leaf; repeated rows are leaves of their own; texts count whole; an empty
    table gives an empty one; columns that are not named do not matter.
    """
    nodes = rows.select(F.col(group).alias("grp"), F.col(order).alias("by"), F.col(leaf).alias("digest"),
                        F.struct(*keep).alias("item"))
    placed = ranked(nodes, ["grp"], ["by", "digest"], "place", "among")
    tree = _tiers(placed.select("grp", "place", _height(F.col("among")).alias("height"),
                                F.struct("digest", "item").alias("node")), ["grp"])
    subroots = tree[-1].select("grp", F.col("node.digest").alias("digest"))
    placed = ranked(subroots, [], ["grp"], "place", "among")
    crown = _tiers(placed.select("place", _height(F.col("among")).alias("height"), F.struct(
        "digest", F.struct("grp").alias("item")).alias("node")), [])
    # the item of the crown's lowest nodes is the group, that of all others a block number
    steps = "array<struct<left:string,right:string>>"
    tops = _descended(crown, [], crown[-1].select(
        F.array().cast(steps).alias("path"),
        F.struct(F.col("node.digest").alias("root")).alias("top")))
    tops = tops.select(F.col("node.item.grp").alias("grp"), "path", F.struct(
        F.col("node.digest").alias("subroot"), "top.root").alias("top"))
    found = _descended(tree, ["grp"], tops)
    return found.select("node.item.*", F.col("node.digest").alias("leaf"), "top.subroot", "top.root",
                        F.col("path").alias("proof"))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof give."""
    return F.aggregate(proof, leaf, lambda node, step: sha256_hex(F.concat(step["left"], node, step["right"])))


def proof_digest(proof: Column) -> Column:
    """The digest of all siblings of a proof, from the leaf to the root and left to right."""
    return sha256_hex(F.array_join(F.transform(proof, lambda s: F.concat(s["left"], s["right"])), ""))


def op11_merkle_dataset_manifest(spark, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "utf-8")) % 2 == 0
    forged = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    rows = docs.select("doc_id", "source", record_digest(*[F.col(c) for c in FIELDS]).alias("leaf"),
                       record_digest(*[forged if c == "text" else F.col(c) for c in FIELDS]).alias("shown"))
    out = proofs(rows, "source", "doc_id", "leaf", ["doc_id", "shown"])
    out = out.withColumn("folded_root", folded(F.col("shown"), F.col("proof")))
    return out.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"),
                      "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


_CRC = """
WITH RECURSIVE steps(v, c, k) AS (
    SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i)
    UNION ALL
    SELECT v, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY v) AS t FROM steps WHERE k = 8),"""


def _sql_crc(text: str) -> str:
    """CRC-32 of an expression's UTF-8 bytes, in a query that has crc_table beside it."""
    return f"""xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, length(hex(encode({text}))) // 2),
                   lambda i: ('0x' || substr(hex(encode({text})), (2 * i + 1)::INT, 2))::BIGINT),
                   lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"""


def _sql_record(text: str) -> str:
    values = [text if c == "text" else f"{c}::VARCHAR" for c in FIELDS]
    return "sha256(" + " || ".join(f"coalesce(octet_length(encode({v})) || ':' || {v}, '-')" for v in values) + ")"


# One table of nodes for both trees: the source trees (source), then the crown (no source, top).
SQL = _CRC + f"""
docs AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, doc_id, source, {_sql_record("text")} AS leaf,
           CASE WHEN {_sql_crc("doc_id::VARCHAR")} % 2 = 0
                THEN {_sql_record("replace(text, chr(10), '')")} ELSE {_sql_record("text")} END AS shown
    FROM documents, crc_table),
leaves AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY source) AS among FROM docs),
nodes AS (
    SELECT source, 0 AS lvl, place, among, leaf AS digest FROM leaves
    UNION ALL
    SELECT source, lvl + 1, place // 3, (any_value(among) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM nodes WHERE among > 1 GROUP BY source, lvl, place // 3),
subroots AS MATERIALIZED (
    SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place,
           count(*) OVER () AS among FROM nodes WHERE among = 1),
crown AS (
    SELECT 0 AS lvl, place, among, subroot AS digest FROM subroots
    UNION ALL
    SELECT lvl + 1, place // 3, (any_value(among) + 2) // 3, sha256(string_agg(digest, '' ORDER BY place))
    FROM crown WHERE among > 1 GROUP BY lvl, place // 3),
height AS (SELECT source, max(lvl) AS high FROM nodes GROUP BY source),
sides AS MATERIALIZED (
    SELECT l.row_no, n.lvl, n.place < l.place // (3 ** n.lvl)::BIGINT AS before, n.place, n.digest
    FROM leaves l JOIN nodes n ON l.source IS NOT DISTINCT FROM n.source AND n.among > 1
         AND n.place // 3 = l.place // (3 ** (n.lvl + 1))::BIGINT AND n.place <> l.place // (3 ** n.lvl)::BIGINT
    UNION ALL
    SELECT l.row_no, h.high + c.lvl, c.place < s.place // (3 ** c.lvl)::BIGINT, c.place, c.digest
    FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
         JOIN height h ON l.source IS NOT DISTINCT FROM h.source
         JOIN crown c ON c.among > 1 AND c.place // 3 = s.place // (3 ** (c.lvl + 1))::BIGINT
              AND c.place <> s.place // (3 ** c.lvl)::BIGINT),
ways AS MATERIALIZED (
    SELECT row_no, lvl, coalesce(string_agg(digest, '' ORDER BY place) FILTER (before), '') AS lhs,
           coalesce(string_agg(digest, '' ORDER BY place) FILTER (NOT before), '') AS rhs
    FROM sides GROUP BY row_no, lvl),
tall AS (
    SELECT l.row_no, h.high + (SELECT max(lvl) FROM crown) AS steps
    FROM leaves l JOIN height h ON l.source IS NOT DISTINCT FROM h.source),
folds AS (
    SELECT row_no, 0 AS lvl, shown AS node FROM leaves
    UNION ALL
    SELECT f.row_no, f.lvl + 1, sha256(coalesce(w.lhs, '') || f.node || coalesce(w.rhs, ''))
    FROM folds f JOIN tall t ON f.row_no = t.row_no AND f.lvl < t.steps
         LEFT JOIN ways w ON f.row_no = w.row_no AND f.lvl = w.lvl),
proved AS (
    SELECT row_no, string_agg(digest, '' ORDER BY lvl, place) AS siblings FROM sides GROUP BY row_no),
top AS (SELECT digest AS root FROM crown WHERE among = 1)
SELECT l.doc_id, l.leaf, s.subroot, root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
       f.node AS folded_root, f.node = root AS verified
FROM leaves l JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source
     JOIN tall t ON l.row_no = t.row_no JOIN folds f ON l.row_no = f.row_no AND f.lvl = t.steps
     LEFT JOIN proved p ON l.row_no = p.row_no, top
"""
