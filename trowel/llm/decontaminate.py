"""Benchmark decontamination: hashed word windows of test items, broadcast to the corpus scan."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trowel.llm.common import read, sha256_hex, stored

WINDOW_WORDS = 10
BROADCAST_BYTES = 48 * 1024 * 1024
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # all but digits, letters, non-ASCII
_NO_BREAK = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """The words of a text in their own case; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _BREAK), "")


def ascii_lower(word: Column) -> Column:
    return F.translate(word, CAPITALS, CAPITALS.lower())


def _hashes(word_list: Column) -> Column:
    # lower() also folds letters beyond ASCII: equal words stay equal, and what it makes equal
    # besides is sorted out when the hits are verified
    return F.transform(word_list, lambda w: F.xxhash64(F.lower(w)))


def test_windows(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                 window_words: int = WINDOW_WORDS) -> DataFrame:
    """Each distinct window (n_words, key, window, items): the hash of its words' hashes, its
    words in lower case joined by spaces, and the sorted ids of the items that hold it."""
    own = items.select(F.col(id_col).alias("item_id"),
                       F.transform(words(F.col(text_col)), ascii_lower).alias("words"))
    own = own.where(F.size("words") > 0).select(
        "item_id", "words", F.least(F.size("words"), F.lit(window_words)).alias("n_words"))
    cut = own.select("item_id", "words", "n_words", F.explode(
        F.sequence(F.lit(1), F.size("words") - F.col("n_words") + 1)).alias("at"))
    cut = cut.select("item_id", "n_words", F.slice("words", F.col("at"), F.col("n_words")).alias("window"))
    return cut.groupBy("n_words", "window").agg(
        F.sort_array(F.collect_set("item_id")).alias("items")).select(
        "n_words", F.xxhash64(_hashes(F.col("window"))).alias("key"),
        F.array_join("window", " ").alias("window"), "items")


def _merged(hits: Column) -> Column:
    """Sorted, disjoint spans {at, end} (end exclusive) of the hits {at, n_words}."""
    empty = F.array().cast("array<struct<at:int,end:int>>")

    def joined(spans, hit):
        end = hit["at"] + hit["n_words"]
        last = F.try_element_at(spans, F.lit(-1))
        return F.when(last["end"] >= hit["at"], F.concat(
            F.slice(spans, 1, F.size(spans) - 1),
            F.array(F.struct(last["at"].alias("at"), F.greatest(last["end"], end).alias("end"))))
        ).otherwise(F.concat(spans, F.array(F.struct(hit["at"].alias("at"), end.alias("end")))))

    return F.aggregate(F.array_sort(hits), empty, joined)


def _covered(hits: Column) -> Column:
    """How many words lie in at least one hit."""
    def step(seen, hit):
        end = hit["at"] + hit["n_words"]
        return F.struct(
            F.greatest(seen["upto"], end).alias("upto"),
            (seen["n"] + F.greatest(F.lit(0), end - F.greatest(seen["upto"], hit["at"]))).alias("n"))

    return F.aggregate(F.array_sort(hits), F.struct(F.lit(1).alias("upto"), F.lit(0).alias("n")),
                       step, lambda seen: seen["n"].cast("bigint"))


def scan(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text",
         window_words: int = WINDOW_WORDS, broadcast_bytes: int = BROADCAST_BYTES,
         keep: list[str] | None = None) -> DataFrame:
    """Every row with its hits: (doc_id, n_words, hits, items), and the ``keep`` columns as
    keep_0, keep_1, ….

    ``hits`` are {at, n_words}: where a window of a test item occurs, by word number from 1;
    ``items`` are the sorted ids of those items. The corpus is read once; each word position
    probes a broadcast table of the windows, and equal hashes are verified word by word. The
    table is measured: beyond ``broadcast_bytes`` it is cut by hash, and the probe repeated for
    each part. Rows of hits are regrouped by a row number made in the same scan; for several parts
    the numbered rows are stored first, so that all parts see the same numbers.

    Defined cases: null and empty texts have no words and no hits; an item without words has
    no window; repeated items count once; an item with a null id gives hits but no id; repeated
    rows keep their own results; an empty benchmark gives no hits, an empty corpus no rows.
    """
    windows = stored(test_windows(items, item_id_col, item_text_col, window_words), "windows")
    size = windows.agg(F.sum(F.octet_length("window") + F.size("items") * 16 + 128),
                       F.collect_set("n_words")).first()
    lengths = sorted(size[1], reverse=True) or [window_words]  # at most window_words of them
    parts = max(1, math.ceil((size[0] or 0) / broadcast_bytes))
    kept = [F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep or [])]
    kept_names = [f"keep_{i}" for i in range(len(kept))]
    rows = docs.select(F.monotonically_increasing_id().alias("row_no"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).alias("text"), *[c for c, n in zip(kept, keep or []) if n != text_col])
    if parts > 1:
        rows = stored(rows, "numbered")
    rows = rows.select("row_no", "doc_id", words(F.col("text")).alias("words"), *[
        F.col("text").alias(k) if n == text_col else F.col(k) for k, n in zip(kept_names, keep or [])])
    rows = rows.select("*", F.size("words").alias("n_all"), _hashes(F.col("words")).alias("hashes"))
    # Each row also sends one probe at 0, which meets the row 0 of the first part: so rows
    # without a hit come through the same scan.
    first = F.when(F.col("n_words") == lengths[0], 0).otherwise(1)
    places = F.when(F.col("n_all") >= F.col("n_words"),
                    F.sequence(first, F.col("n_all") - F.col("n_words") + 1)).when(
        first == 0, F.array(F.lit(0)))
    probes = rows.select("*", F.explode(F.array(*[F.lit(n) for n in lengths])).alias("n_words")).select(
        "*", F.explode(places).alias("at"))
    # From here to the join all stays in one generated loop: the word lists of a row are looked
    # at in place, not copied for each position. So no higher-order function belongs here.
    probes = probes.select("*", F.when(F.col("at") == 0, F.lit(0)).otherwise(F.xxhash64(
        F.slice("hashes", F.greatest(F.col("at"), F.lit(1)), F.col("n_words")))).alias("probe"))
    found = None
    for part in range(parts):
        table = windows.select("key", "window", "items")
        if parts > 1:
            table = table.where(F.pmod("key", F.lit(parts)) == part)
        if part == 0:
            one = windows.sparkSession.range(1).select(
                F.lit(0).cast("bigint").alias("key"), F.lit(None).cast("string").alias("window"),
                F.lit(None).cast(windows.schema["items"].dataType).alias("items"))
            table = table.unionByName(one)
        met = probes.join(F.broadcast(table), F.col("probe") == F.col("key")).where(
            ((F.col("at") == 0) & F.col("window").isNull()) | ((F.col("at") > 0) & (ascii_lower(F.array_join(F.slice(
                "words", F.greatest(F.col("at"), F.lit(1)), F.col("n_words")), " ")) == F.col("window"))))
        met = met.select("row_no", "doc_id", "n_all", "at", "n_words", "items", *[
            F.when(F.col("at") == 0, F.col(c)).alias(c) for c in kept_names])
        found = met if found is None else found.union(met)
    hit = F.when(F.col("at") > 0, F.struct("at", "n_words"))
    grouped = found.groupBy("row_no", "doc_id", "n_all").agg(
        F.collect_list(hit).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
        *[F.first(c, ignorenulls=True).alias(c) for c in kept_names])
    return grouped.select("doc_id", F.col("n_all").cast("bigint").alias("n_words"), "hits", "items",
                          *kept_names)


def remove_contaminated(docs: DataFrame, items: DataFrame, what: str = "documents",
                        id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The corpus without what it shares with the test items; columns and their order stay.

    ``what`` is "documents" (rows with a hit go) or "spans" (the hit words go, each with what
    separates it from the next word; text before the first word and all other words stay).

    Defined cases: null and empty texts have no words and stay as they are; long texts are
    scanned whole; repeated rows share their fate; without items, or with items of no word,
    everything stays; an empty table gives an empty one; further columns stay, whatever their names.
    """
    if what not in ("documents", "spans"):
        raise ValueError("what is 'documents' or 'spans'")
    names = docs.columns
    found = scan(docs, items, id_col, text_col, keep=names, **options)
    kept = {c: F.col(f"keep_{i}") for i, c in enumerate(names)}
    if what == "documents":
        return found.where(F.size("hits") == 0).select(*[v.alias(c) for c, v in kept.items()])
    spans = _merged(F.col("hits"))
    pieces = F.regexp_extract_all(kept[text_col], F.lit(f"{_NO_BREAK}(?:{_BREAK})?"), 0)
    left = F.filter(pieces, lambda piece, i: ~F.exists(
        F.col("spans"), lambda s: (s["at"] <= i + 1) & (i + 1 < s["end"])))
    head = F.regexp_extract(kept[text_col], f"^(?:{_BREAK})?", 0)
    clean = F.when(F.size("hits") == 0, kept[text_col]).otherwise(F.concat(head, F.array_join(left, "")))
    return found.withColumn("spans", spans).select(
        *[(clean if c == text_col else v).alias(c) for c, v in kept.items()])


def op6_benchmark_decontamination(spark, folder: str) -> DataFrame:
    found = scan(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    ids = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id", "n_words", _covered(F.col("hits")).alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        sha256_hex(F.array_join(ids, ",")).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


SQL_WINDOWS = r"""
    SELECT DISTINCT item_id, list_slice(w, i, i + least(len(w), 10) - 1) AS win, least(len(w), 10) AS n
    FROM (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
          WHERE text IS NOT NULL) b, unnest(range(1, greatest(len(w) - least(len(w), 10) + 2, 1))) AS r(i)
    WHERE len(w) > 0"""

SQL = rf"""
WITH windows AS MATERIALIZED ({SQL_WINDOWS}),
lengths AS (SELECT DISTINCT n FROM windows),
docs AS MATERIALIZED (
    SELECT row_number() OVER () AS row_no, doc_id, coalesce(regexp_extract_all(translate(text,
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
places AS (
    SELECT row_no, n, i, list_slice(w, i, i + n - 1) AS win
    FROM (SELECT row_no, w, n, unnest(range(1, greatest(len(w) - n + 2, 1))) AS i FROM docs, lengths)),
hits AS MATERIALIZED (
    SELECT p.row_no, p.i, p.n, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.win = x.win),
hit_words AS (
    SELECT row_no, count(DISTINCT word) AS n_hit
    FROM (SELECT row_no, unnest(range(i, i + n)) AS word FROM (SELECT DISTINCT row_no, i, n FROM hits))
    GROUP BY row_no),
hit_items AS (
    SELECT row_no, count(DISTINCT item_id) AS n_items,
           string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
    FROM hits GROUP BY row_no)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit,
       coalesce(t.n_items, 0)::BIGINT AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
       h.n_hit IS NOT NULL AS contaminated
FROM docs d LEFT JOIN hit_words h USING (row_no) LEFT JOIN hit_items t USING (row_no)
"""
