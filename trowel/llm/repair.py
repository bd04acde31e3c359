"""Conversation structure repair: the cheapest edits that make roles alternate, found by a
Viterbi search that runs over chunks of a conversation at the same time."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trowel.llm.common import ranked, read, sha256_hex, stored

CHUNK = 4096  # rows of a conversation in one chunk
LOT = 50_000  # rows of edits that a task hands on together
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANK_SPACE = r"\x20\x09-\x0D"

# What the roles so far allow next: nothing said, a system turn, a user turn, an assistant turn.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT_ROLE = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # by insert or new role
NAME = {USER: "user", ASSISTANT: "assistant"}
ENDED = (0, 2 * INSERT, INSERT, 0)  # what is left to pay in each state when no row is left

# One letter a row: its role's kind and its fault.
KINDS = "suao"
FAULTS = ("", "truncated", "blank", "duplicate")
LETTERS = "abcdefghijklmnop"


def row_letter(role: Column, fault: Column) -> Column:
    """The letter of a row, from its role's initial and its first fault (null: none)."""
    initial = F.substring(role, 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    weight = sum((F.when(fault == f, i).otherwise(0) for i, f in enumerate(FAULTS) if f), F.lit(0))
    return F.substring(F.lit(LETTERS), kind * len(FAULTS) + F.coalesce(weight, F.lit(0)) + 1, 1)


@cache
def _edits(letter: str, state: int) -> list[tuple[str, int, int]]:
    """The edits (initial, cost, state after) of a row, without inserts before it."""
    kind, fault = divmod(LETTERS.index(letter), len(FAULTS))
    out = [("D", DELETE, state)]
    if FAULTS[fault] not in ("blank", "duplicate"):
        more = TRUNCATED if FAULTS[fault] == "truncated" else 0
        role = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(KINDS[kind])
        if role == NEXT_ROLE[state] or (role == SYSTEM and state == NOTHING):
            out.append(("K", more, role))
        out.append(("R", REROLE + more, NEXT_ROLE[state]))
    return out


@cache
def _before(letter: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """The costs from before a row to the end, by state, from those after it."""
    own = [min(cost + after[to] for _, cost, to in _edits(letter, s)) for s in range(4)]
    for _ in range(2):  # a third insert would only undo the second
        own = [min(own[s], INSERT + own[NEXT_ROLE[s]]) for s in range(4)]
    return tuple(own)


@cache
def _step(letter: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """The same with the least cost taken out: costs that differ only by a constant lead to the
    same edits, and of such vectors there are few."""
    costs = _before(letter, after)
    return tuple(c - min(costs) for c in costs), min(costs)


@cache
def _choice(letter: str, after: tuple[int, ...], state: int) -> tuple[str, str, int]:
    """The least letters of the cheapest edits up to and with a row: (initials, a line for each,
    state after). A line is the role's initial, ``-`` for the row as it is, ``.`` for none; the
    last one is the row's."""
    done = lines = ""
    while True:
        best = _before(letter, after)[state]
        options = {e: (cost + after[to], to) for e, cost, to in _edits(letter, state)}
        options["I"] = (INSERT + _before(letter, after)[NEXT_ROLE[state]], NEXT_ROLE[state])
        edit = min(e for e, (cost, _) in options.items() if cost == best)
        state = options[edit][1]
        done += edit
        lines += {"D": ".", "K": "-"}.get(edit) or "ua"[state - USER]
        if edit != "I":
            return done, lines, state


def run_backward(letters: str, after: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """The reduced costs before a chunk, and what was taken out, from the reduced costs after it."""
    total = 0
    for letter in reversed(letters):
        after, least = _step(letter, after)
        total += least
    return after, total


def run_forward(letters: str, after: tuple[int, ...], state: int) -> tuple[list[tuple[str, str]], int]:
    """Each row's initials and lines along the least audit of a chunk, and the state after."""
    behind = []
    for letter in reversed(letters):
        behind.append(after)
        after, _ = _step(letter, after)
    out = []
    for letter, costs in zip(letters, reversed(behind)):
        done, lines, state = _choice(letter, costs, state)
        out.append((done, lines))
    return out, state


def _vector(text: str) -> tuple[int, ...]:
    return tuple(int(c) for c in text.split(","))


def _text(vector: tuple[int, ...]) -> str:
    return ",".join(map(str, vector))


def _backward(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        ran = [run_backward(x, _vector(v)) for x, v in zip(batch["letters"], batch["after"])]
        out = batch[["conv", "chunk", "after"]].copy()
        out["before"], out["cost"] = [_text(v) for v, _ in ran], [c for _, c in ran]
        yield out


def _wanted(frame: pd.DataFrame) -> pd.DataFrame:
    """For each chunk of a conversation the costs after it, from what its runs so far have given,
    and whether it has yet to run from these. Behind such a chunk its latest costs are assumed: by
    rank convergence they mostly differ from the true ones by a constant only."""
    runs: dict[int, dict[str, str]] = {}
    for chunk, after, before in sorted(zip(frame["chunk"], frame["after"], frame["before"])):
        runs.setdefault(chunk, {})[after] = before
    out, after = [], _text(ENDED)
    for chunk in sorted(runs, reverse=True):
        out.append((chunk, after, after not in runs[chunk]))
        after = runs[chunk].get(after, max(runs[chunk].values()))
    wanted = pd.DataFrame(out, columns=["chunk", "after", "missing"])
    wanted.insert(0, "conv", frame["conv"].iloc[0])
    return wanted


def _exits(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The state after a chunk for each of the four before it."""
    for batch in batches:
        out = batch[["conv", "chunk"]].copy()
        out["exits"] = ["".join(str(run_forward(x, _vector(v), s)[1]) for s in range(4))
                        for x, v in zip(batch["letters"], batch["after"])]
        yield out


def _entries(frame: pd.DataFrame) -> pd.DataFrame:
    state, entry = NOTHING, []
    frame = frame.sort_values("chunk")
    for exits in frame["exits"]:
        entry.append(state)
        state = int(exits[state])
    return frame[["conv", "chunk"]].assign(entry=entry)


def _traced(size: int):
    def trace(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: list[tuple] = []
            for row in batch.itertuples(index=False):
                steps, state = run_forward(row.letters, _vector(row.after), row.entry)
                if row.last and state in (SYSTEM, USER):
                    steps.append({SYSTEM: ("II", "ua"), USER: ("I", "a")}[state])
                out.extend((row.conv, row.chunk * size + i, *step) for i, step in enumerate(steps))
                if len(out) >= LOT:
                    yield pd.DataFrame(out, columns=["conv", "place", "done", "lines"])
                    out = []
            yield pd.DataFrame(out, columns=["conv", "place", "done", "lines"])
    return trace


def conv_key(conv: Column) -> Column:
    """A text for each conversation id, null included."""
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit("-"))


def find_faults(rows: DataFrame, conv_col: str = "conv_id") -> tuple[DataFrame, DataFrame]:
    """The texts (row, text) of a conversation table and rows (row, conv, place, among, turn, role,
    fault) without them: the place from 0 by turn (nulls first, ties by role and the text's
    digest), and the first fault that a row has: blank, duplicate of an earlier one, truncated, or null."""
    texts = stored(rows.select(
        F.monotonically_increasing_id().alias("row"), conv_key(F.col(conv_col)).alias("conv"), "turn",
        F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")), "texts")
    ends = F.when(~F.col("text").rlike(f"[^{BLANK_SPACE}]"), "blank").when(
        ~F.col("text").rlike(rf"[.!?][{BLANK_SPACE}]*\z"), "truncated")
    own = texts.select("row", "conv", "turn", "role", sha256_hex(F.col("text")).alias("digest"), ends.alias("ends"))
    placed = stored(ranked(own, ["conv"], ["turn", "role", "digest"], "place", "among"), "placed")
    first = placed.groupBy("conv", "role", "digest").agg(F.min("place").alias("place")).select(
        "conv", "place", F.lit(True).alias("first"))
    fault = F.when(F.col("ends") == "blank", "blank").when(
        F.col("first").isNull(), "duplicate").otherwise(F.col("ends"))
    return texts.select("row", "text"), stored(placed.join(first, ["conv", "place"], "left").withColumn(
        "fault", fault).drop("first", "digest", "ends"), "faults")


def cheapest_edits(faults: DataFrame, size: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """The edits of each row (conv, place, done, lines) and the cost of each conversation.

    A conversation is cut into chunks of ``size`` rows, a letter each. Every chunk is run backward
    from the costs at a conversation's end, as a guess. Fix-up passes then run those chunks again
    whose true costs after them, as the next chunk gives them, are not among those it was run from;
    costs that differ by a constant are the same, and soon all are. The stitched costs decide the
    edits: for each state before a chunk the state after it, then the states that really occur,
    then each row's edits. Whatever a conversation's share of the rows, a task holds a chunk, and
    one place sees a line for each chunk.

    Defined cases: see ``repair``.
    """
    letter = F.struct("place", row_letter(F.col("role"), F.col("fault")).alias("letter"))
    chunks = stored(faults.groupBy("conv", F.expr(f"place div {size}").alias("chunk")).agg(
        F.array_join(F.sort_array(F.collect_list(letter))["letter"], "").alias("letters"),
        F.max("among").alias("among")).select(
        "conv", "chunk", "letters", ((F.col("chunk") + 1) * size >= F.col("among")).alias("last"),
        (F.col("among") > size).alias("cut")), "chunks")
    ran = "conv string, chunk bigint, after string, before string, cost bigint"
    known = stored(chunks.withColumn("after", F.lit(_text(ENDED))).mapInPandas(_backward, ran), "runs")
    single = chunks.where(~F.col("cut")).select(
        "*", F.lit(_text(ENDED)).alias("after"), F.lit(NOTHING).alias("entry"))
    pieces = chunks.where("cut")
    if pieces.isEmpty():
        whole = single
    else:
        own = known.join(pieces.select("conv", "chunk"), ["conv", "chunk"], "left_semi")
        while True:
            stitched = stored(own.groupBy("conv").applyInPandas(
                _wanted, "conv string, chunk bigint, after string, missing boolean"), "stitched")
            again = stitched.where("missing").drop("missing")
            if again.isEmpty():
                break
            more = stored(pieces.join(again, ["conv", "chunk"]).mapInPandas(_backward, ran), "runs")
            known, own = known.union(more), own.union(more)
        true = pieces.join(stitched.drop("missing"), ["conv", "chunk"])
        entries = true.mapInPandas(_exits, "conv string, chunk bigint, exits string").groupBy(
            "conv").applyInPandas(_entries, "conv string, chunk bigint, entry int")
        whole = single.unionByName(true.join(entries, ["conv", "chunk"]))
    whole = stored(whole, "whole")
    edits = stored(whole.drop("cut").mapInPandas(
        _traced(size), "conv string, place bigint, done string, lines string"), "edits")
    before = F.split("before", ",")[NOTHING].cast("bigint")
    costs = whole.select("conv", "chunk", "after").join(known, ["conv", "chunk", "after"]).groupBy(
        "conv").agg(F.sum(F.col("cost") + F.when(F.col("chunk") == 0, before).otherwise(0)).alias("cost"))
    return edits, costs


def repaired_rows(texts: DataFrame, faults: DataFrame, edits: DataFrame) -> DataFrame:
    """The edits with the lines that they leave, as rows (conv, place, done, said): said is the
    array of these lines, each ``role:text``."""
    own = faults.select("row", "conv", "place", "role")
    text = F.coalesce("text", F.lit(""))
    # turns put in at the end have no row: a number of their own spreads them over tasks
    none = -1 - F.pmod(F.xxhash64("conv"), F.lit(1 << 40))
    both = edits.join(own, ["conv", "place"], "left").withColumn("row", F.coalesce("row", none)).join(
        texts, "row", "left").withColumn("kept", F.regexp_replace("done", "D", ""))

    def line(kind: Column, at: Column) -> Column:
        inserted = F.substring("kept", at + 1, F.lit(1)) == "I"
        role = F.when(kind == "-", F.col("role")).when(kind == "u", "user").otherwise("assistant")
        return F.concat(role, F.lit(":"), F.when(inserted, "").otherwise(text))
    signs = F.filter(F.split("lines", ""), lambda x: (x != "") & (x != "."))
    return both.select("conv", "place", "done", F.transform(signs, line).alias("said"))


def _digested(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One row per conversation from its pieces in order; no more than a batch is held."""
    conv, audit, digest, empty = None, [], None, True
    for batch in batches:
        out = []
        for key, done, piece in zip(batch["conv"], batch["done"], batch["piece"]):
            if key != conv:
                if conv is not None:
                    out.append((conv, "".join(audit), digest.hexdigest()))
                conv, audit, digest, empty = key, [], hashlib.sha256(), True
            audit.append(done)
            if piece:
                digest.update((piece[1:] if empty else piece).encode())
                empty = False
        if out:
            yield pd.DataFrame(out, columns=["conv", "audit", "repaired_sha256"])
    if conv is not None:
        yield pd.DataFrame([(conv, "".join(audit), digest.hexdigest())], columns=["conv", "audit", "repaired_sha256"])


def audits(repaired: DataFrame) -> DataFrame:
    """conv, audit, repaired_sha256: the digest of all lines, joined by line breaks. The rows pass
    in order, in pieces of 4,096 characters, so that neither a long conversation nor a long text is held."""
    text = F.array_join(F.transform("said", lambda x: F.concat(F.lit("\n"), x)), "")
    cut = F.regexp_extract_all(text, F.lit("(?s).{1,4096}"), F.lit(0))
    pieces = repaired.select("conv", "place", "done", F.posexplode_outer(cut).alias("at", "piece")).withColumn(
        "done", F.when(F.coalesce("at", F.lit(0)) == 0, F.col("done")).otherwise(""))
    return pieces.repartition("conv").sortWithinPartitions("conv", "place", "at").select(
        "conv", "done", "piece").mapInPandas(_digested, "conv string, audit string, repaired_sha256 string")


def fault_counts(faults: DataFrame) -> DataFrame:
    """conv, gaps, blank, duplicate, truncated, illegal of each conversation. A pair of neighbours
    is illegal unless it is system user, user assistant or assistant user, by initials."""
    turns = faults.where(F.col("turn").isNotNull()).groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
    counts = faults.groupBy("conv").agg(*[
        F.count(F.when(F.col("fault") == f, 1)).alias(f) for f in FAULTS if f])
    initial = F.substring("role", 1, 1)
    sides = faults.select("conv", "place", F.explode(F.array(
        F.struct(F.col("place").alias("pair"), initial.alias("left"), F.lit(None).cast("string").alias("right")),
        F.struct((F.col("place") - 1).alias("pair"), F.lit(None).cast("string").alias("left"), initial.alias("right")),
    )).alias("side")).select("conv", "side.*")
    pairs = sides.groupBy("conv", "pair").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    illegal = pairs.where(F.col("left").isNotNull() & F.col("right").isNotNull()).groupBy("conv").agg(
        F.count(F.when(~F.concat("left", "right").isin("su", "ua", "au"), 1)).alias("illegal"))
    return counts.join(turns, "conv", "left").join(illegal, "conv", "left").select(
        "conv", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                  for c in ("gaps", "blank", "duplicate", "truncated", "illegal")])


def repair(rows: DataFrame, conv_col: str = "conv_id", size: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """What is wrong with each conversation and the cheapest way to mend it.

    Returns the repaired rows (conv, place, done, said) and, for each conversation that has rows,
    conv (the key of ``conv_key``), gaps, blank, duplicate, truncated, illegal, cost, audit and
    repaired_sha256. A row is kept for nothing, gets the role user or assistant for 3, is deleted
    for 4, which blank rows and duplicates must be; an empty user or assistant turn is put in for
    3; a truncated row that stays costs 3 more. The roles then read: a system turn or none, then
    pairs of user and assistant; or there is none. Of equally cheap edits the least audit is taken.

    Defined cases: a null conversation is one of its own; a null turn comes first; rows of one turn
    are placed by role and text; a null role or text counts as one space; an empty role has no
    initial and is like any unknown one; texts count whole; an empty table gives none; further
    columns do not matter, whatever their names.
    """
    texts, faults = find_faults(rows, conv_col)
    edits, costs = cheapest_edits(faults, size)
    repaired = repaired_rows(texts, faults, edits)
    report = fault_counts(faults).join(costs, "conv").join(audits(repaired), "conv")
    return repaired, report


def damaged(rows: DataFrame) -> DataFrame:
    """The conversations with a fault here and there, chosen by a checksum of id and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    chance = F.crc32(F.encode(key, "utf-8")) % 20
    text = F.coalesce("text", space)
    return rows.select("conv_id", "turn", "role", "text", chance.alias("chance")).where("chance <> 0").select(
        "conv_id", "turn",
        F.when(F.col("chance") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("chance") == 1, "").when(F.col("chance") == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(
            text).alias("text"),
        F.explode(F.when(F.col("chance") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def op13_conversation_structure_repair(spark, folder: str) -> DataFrame:
    rows = read(spark, folder, "conversations")
    _, report = repair(damaged(rows))
    every = rows.groupBy("conv_id").agg(F.lit(1)).select("conv_id", conv_key(F.col("conv_id")).alias("conv"))
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return every.join(report, "conv", "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", sha256_hex(F.lit(""))).alias("repaired_sha256"))


def _sql_inserts(table: str) -> str:
    """The rows of a table, and those with one and two inserted turns."""
    one = (f"SELECT conv, n, nth, CASE state WHEN 2 THEN 3 ELSE 2 END AS state, cost + {INSERT} AS cost, "
           "audit || 'I' AS audit, said || [CASE state WHEN 2 THEN 'assistant:' ELSE 'user:' END] AS said FROM ")
    return f"SELECT * FROM {table} UNION ALL {one}{table} UNION ALL {one}({one}{table})"


# The same search forward: for each state the cheapest way there, and of these the least audit.
SQL = r"""
WITH RECURSIVE steps(v, c, k) AS (
    SELECT i::BIGINT, i::BIGINT, 0 FROM range(256) r(i)
    UNION ALL
    SELECT v, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY v) AS t FROM steps WHERE k = 8),
keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS key
    FROM conversations),
chances AS (
    SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(range(0, length(key) // 2),
                   lambda i: ('0x' || substr(key, (2 * i + 1)::INT, 2))::BIGINT),
                   lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) % 20 AS chance
    FROM keyed, crc_table),
damaged AS (
    SELECT conv_id, turn, CASE WHEN chance = 4 THEN 'user' ELSE role END AS role,
           CASE chance WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM chances, range(2) r(copy) WHERE chance <> 0 AND (copy = 0 OR chance = 3)),
placed AS (
    SELECT *, coalesce('=' || conv_id, '-') AS conv,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS place,
           count(*) OVER (PARTITION BY conv_id) AS n FROM damaged),
seen AS (
    SELECT *, row_number() OVER (PARTITION BY conv, role, text ORDER BY place) > 1 AS again,
           substr(role, 1, 1) AS initial, lead(substr(role, 1, 1)) OVER (PARTITION BY conv ORDER BY place) AS following
    FROM placed),
faults AS MATERIALIZED (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again THEN 'duplicate'
                   WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
    FROM seen),
counts AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (initial || following NOT IN ('su', 'ua', 'au')) AS illegal
    FROM faults GROUP BY conv),
ways AS (
    SELECT DISTINCT conv, n, 0::BIGINT AS nth, 0 AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS said FROM faults
    UNION ALL
    SELECT conv, n, nth, state, (least_way).cost, (least_way).audit, (least_way).said FROM (
        SELECT conv, n, nth, state, min({cost: cost, audit: audit, said: said}) AS least_way FROM (
            SELECT w.conv, w.n, w.nth + 1 AS nth, e.state, w.cost + e.cost AS cost, w.audit || e.edit AS audit, w.said || e.said AS said
            FROM (""" + _sql_inserts("ways") + rf""") w JOIN faults f ON w.conv = f.conv AND f.place = w.nth + 1,
            LATERAL (
                SELECT 'D' AS edit, w.state AS state, {DELETE} AS cost, []::VARCHAR[] AS said
                UNION ALL
                SELECT 'K', CASE f.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END,
                       CASE f.fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END, [f.role || ':' || f.text]
                WHERE f.fault NOT IN ('blank', 'duplicate')
                  AND ((f.initial = 's' AND w.state = 0) OR (f.initial = 'u' AND w.state <> 2)
                       OR (f.initial = 'a' AND w.state = 2))
                UNION ALL
                SELECT 'R', CASE w.state WHEN 2 THEN 3 ELSE 2 END,
                       {REROLE} + CASE f.fault WHEN 'truncated' THEN {TRUNCATED} ELSE 0 END,
                       [CASE w.state WHEN 2 THEN 'assistant:' ELSE 'user:' END || f.text]
                WHERE f.fault NOT IN ('blank', 'duplicate')) e)
        GROUP BY conv, n, nth, state)),
ends AS (SELECT * FROM ways WHERE nth = n),
best AS (
    SELECT conv, min({{cost: cost, audit: audit, said: said}}) AS way
    FROM (""" + _sql_inserts("ends") + """) WHERE state IN (0, 3) GROUP BY conv),
every AS (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '-') AS conv FROM conversations)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
       coalesce(way.audit, '') AS audit,
       sha256(coalesce(array_to_string(way.said, chr(10)), '')) AS repaired_sha256
FROM every LEFT JOIN counts USING (conv) LEFT JOIN best USING (conv)
"""
