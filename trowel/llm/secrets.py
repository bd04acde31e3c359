"""Secret scan: candidates in every text, told apart by who else holds the same value."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trowel.llm.common import read, sha256_hex, stored

KINDS = ("assign", "access", "hex", "string")  # order of spans that start together
MAX_OWNERS = 3        # a value at more owners is a widely copied example …
MAX_REPOSITORIES = 6  # … and so is one in more repositories
MIN_ENTROPY = 2.5     # bits per character of a value that looks live

_ASSIGN = re.compile(  # keywords in either case, ASCII letters only
    "(" + "|".join("".join(f"[{c.upper()}{c}]" for c in w) for w in
                   ("password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")
_HEX = re.compile(r"[0-9a-f]{32,}")
_STRING = re.compile(r"[A-Za-z0-9+/_=-]{24,}")
_DUMMY = re.compile(r"example|sample|dummy|changeme|placeholder|your|x{4,}|(.)\1{5,}", re.I)


def _entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def candidates(text: str | None) -> list[tuple]:
    """(kind, start, end, value hash, looks live) by start, then kind; offsets in code points,
    end exclusive.

    The first three kinds are the base ones. ``string`` is a long run with small and capital
    letters and digits that meets no base span: a secret only if it looks live and the corpus
    shows it to belong to few owners.
    """
    text = text or ""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", m.start(), m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [("access", m.start(), m.end(), m[0]) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end(), m[0]) for m in _HEX.finditer(text)]
    taken = sorted((a, b) for _, a, b, _ in found)
    at = 0
    for m in _STRING.finditer(text):
        value = m[0]
        while at < len(taken) and taken[at][1] <= m.start():
            at += 1
        if any(a < m.end() and m.start() < b for a, b in taken[at:at + 1]):
            continue
        if re.search("[a-z]", value) and re.search("[A-Z]", value) and re.search("[0-9]", value):
            found.append(("string", m.start(), m.end(), value))
    found.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return [(kind, a, b, hashlib.sha256(value.encode("utf-8", "replace")).digest()[:16],
             _entropy(value) >= MIN_ENTROPY and not _DUMMY.search(value))
            for kind, a, b, value in found]


@F.pandas_udf(T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("end", T.IntegerType()), T.StructField("hash", T.BinaryType()),
    T.StructField("lively", T.BooleanType())])))
def _candidates(texts: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(("kind", "start", "end", "hash", "lively"), c)) for c in candidates(t)]
                      for t in texts])


def ownership(found: DataFrame) -> DataFrame:
    """Each value hash of (hash, owner, repository) rows with its distinct owners and
    repositories. Counted in three steps that all combine before they shuffle, so a value in a
    third of all rows is a few rows for each owner, and no list of owners is ever made."""
    held = found.groupBy("hash", "owner", "repository").agg(F.count(F.lit(1)).alias("n"))
    by_owner = held.groupBy("hash", "owner").agg(
        F.count(F.lit(1)).alias("repositories"), F.sum("n").alias("n"))
    return by_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories"),
        F.sum("n").alias("occurrences"))


def scan_secrets(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id",
                 text_col: str = "text", max_owners: int = MAX_OWNERS,
                 max_repositories: int = MAX_REPOSITORIES, keep: list[str] | None = None) -> DataFrame:
    """Every row with its secrets: (doc_id, secrets) and the ``keep`` columns as keep_0, …

    ``secrets`` are {start, rank, kind, end, owners, repositories, occurrences, live} by start
    and kind. Each distinct value is counted over the corpus by owners and repositories: at
    most ``max_owners`` and ``max_repositories`` and a live look make it ``live``; values in
    more hands are widely copied examples. Base kinds are listed either way, ``string`` ones
    only if live. Only candidates are shuffled, never texts, unless ``keep`` names them.

    Defined cases: a null text is an empty one; null owners and repositories are one of their
    own; repeated rows each have their result; an empty table gives an empty one; the two
    columns may be any expression, and other columns don't matter.
    """
    kept = [F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep or [])]
    rows = stored(docs.select(
        F.monotonically_increasing_id().alias("row_no"), F.col(id_col).alias("doc_id"),
        owner.cast("string").alias("owner"), repository.cast("string").alias("repository"),
        _candidates(F.col(text_col)).alias("found"), *kept), "candidates")
    found = rows.where(F.size("found") > 0).select("row_no", "owner", "repository", F.inline("found"))
    values = stored(ownership(found), "ownership")
    judged = found.join(values, "hash").withColumn(
        "live", F.col("lively") & (F.col("owners") <= max_owners)
        & (F.col("repositories") <= max_repositories))
    rank = F.array_position(F.array(*[F.lit(k) for k in KINDS]), F.col("kind"))
    secrets = judged.where((F.col("kind") != "string") | F.col("live")).groupBy("row_no").agg(
        F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end", "owners",
                                             "repositories", "occurrences", "live"))).alias("secrets"))
    none = F.array().cast(secrets.schema["secrets"].dataType)
    return rows.join(secrets, "row_no", "left").select(
        "doc_id", F.coalesce("secrets", none).alias("secrets"), *[f"keep_{i}" for i in range(len(kept))])


LIVE_MARK, COPIED_MARK = "[secret]", "[sample]"


def mask(text: str | None, secrets) -> str | None:
    """The text with each secret replaced by a mark; overlapping ones share one, a live one's
    mark if any is live."""
    if text is None or not len(secrets):
        return text
    out, at, runs = [], 0, []
    for s in secrets:
        if runs and s["start"] < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], s["end"])
            runs[-1][2] |= s["live"]
        else:
            runs.append([s["start"], s["end"], s["live"]])
    for start, end, live in runs:
        out += [text[at:start], LIVE_MARK if live else COPIED_MARK]
        at = end
    return "".join(out) + text[at:]


@F.pandas_udf(T.StringType())
def _masked(texts: pd.Series, secrets: pd.Series) -> pd.Series:
    return pd.Series([mask(t, s) for t, s in zip(texts, secrets)], dtype=object)


def mask_secrets(docs: DataFrame, owner: Column, repository: Column, id_col: str = "doc_id",
                 text_col: str = "text", length_col: str | None = None, **options) -> DataFrame:
    """The rows with all secrets masked: live credentials and widely copied examples get
    different marks, all other text and rows stay. ``length_col``, if given, is the text's
    length and is set anew where the text changed.

    Defined cases: null and empty texts stay as they are, so does their length; long texts are
    scanned whole; repeated rows all stay and are masked alike; spans that meet are masked once;
    an empty table gives an empty one; further columns stay, whatever their names.
    """
    names = docs.columns
    found = scan_secrets(docs, owner, repository, id_col, text_col, keep=names, **options)
    kept = {c: F.col(f"keep_{i}") for i, c in enumerate(names)}
    dirty = F.size("secrets") > 0
    found = found.withColumn("masked", _masked(F.when(dirty, kept[text_col]), F.col("secrets")))
    kept_type = {f.name: f.dataType for f in docs.schema.fields}
    changed = {text_col: F.when(dirty, F.col("masked")).otherwise(kept[text_col])}
    if length_col:
        changed[length_col] = F.when(dirty, F.length("masked").cast(kept_type[length_col])).otherwise(
            kept[length_col])
    return found.select(*[changed.get(c, v).alias(c) for c, v in kept.items()])


def owner_columns() -> dict[str, Column]:
    """In the documents a source is an owner, and its texts of one language a repository."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return {"owner": text("source"), "repository": F.concat_ws("/", text("source"), text("lang"))}


def op1_secret_scans(spark, folder: str) -> DataFrame:
    found = scan_secrets(read(spark, folder, "documents"), **owner_columns())
    count = lambda test: F.size(F.filter("secrets", test)).cast("bigint")
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"], s["end"])), ",")
    base = F.filter("secrets", lambda s: s["kind"] != "string")
    return found.select(
        "doc_id", *[F.size(F.filter(F.col("secrets.kind"), F.lit(k).eqNullSafe)).cast("bigint").alias(f"n_{k}")
                    for k in KINDS[:3]],
        sha256_hex(shown(base)).alias("base_sha256"), shown(F.col("secrets")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"), count(lambda s: ~s["live"]).alias("n_copied"))
