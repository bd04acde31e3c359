import hashlib
import heapq
import itertools
import random
import re

import pytest

from trowel.llm import repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, place int, fault int, among int"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        last = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not last else "duplicate" if (role, text) in seen else
                   "truncated" if last[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """Least cost and audit by Dijkstra's search over (rows done, roles so far), audits as ties."""
    state = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    fault, done = faults(rows), set()
    heap = [(0, "", 0, "", ())]
    while True:
        cost, audit, i, at, said = heapq.heappop(heap)
        if (i, at) in done:
            continue
        done.add((i, at))
        if i == len(rows) and at in ("", "a"):
            return cost, audit, "\n".join(said)
        for new in "ua":
            if new in state[at]:
                name = {"u": "user", "a": "assistant"}[new]
                heapq.heappush(heap, (cost + 3, audit + "I", i, new, (*said, f"{name}:")))
                if i < len(rows) and fault[i] not in ("blank", "duplicate"):
                    more = 3 * (fault[i] == "truncated")
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, new, (*said, f"{name}:{rows[i][1]}")))
        if i < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, at, said))
            role, text = rows[i]
            if fault[i] not in ("blank", "duplicate") and role[:1] in state[at]:
                heapq.heappush(heap, (cost + 3 * (fault[i] == "truncated"), audit + "K", i + 1, role[:1], (*said, f"{role}:{text}")))


def report(spark, convs, size):
    rows = [(c, t, role, text, "x", 1, 2, 3) for c, own in convs.items() for t, (role, text) in enumerate(own)]
    repaired, out = repair.repair(spark.createDataFrame(rows, SCHEMA), size=size)
    return repaired, {int(r.conv[1:]): r for r in out.collect()}


def check(convs, got):
    assert set(got) == {c for c, own in convs.items() if own}
    for c, own in convs.items():
        if not own:
            continue
        cost, audit, text = cheapest(own)
        assert (got[c].cost, got[c].audit) == (cost, audit), own
        assert got[c].repaired_sha256 == hashlib.sha256(text.encode()).hexdigest()
        found = faults(own)
        assert [got[c][f] for f in ("blank", "duplicate", "truncated")] == [found.count(f) for f in ("blank", "duplicate", "truncated")]
        pairs = ["".join(x[0][:1] for x in p) for p in zip(own, own[1:])]
        assert got[c].illegal == sum(p not in ("su", "ua", "au") for p in pairs) and got[c].gaps == 0


def made(seed, n, longest):
    rand = random.Random(seed)
    return {c: [(rand.choice(["user", "user", "assistant", "assistant", "system", "tool", ""]),
                 rand.choice(["", " \n", "a.", f"b{i}.", f"c{i}! ", f"d{i}", f"e{i}?", "é."]))
                for i in range(rand.randrange(longest))] for c in range(n)}


RUNS = {c: [(role, f"{i}{end}") for i in range(n)] for c, (role, end, n) in enumerate(itertools.product(
    ("user", "assistant", "system", "tool"), (".", ""), (1, 2, 5, 13, 16)))}


@pytest.mark.parametrize("size", [1, 3, 4096])
def test_against_a_shortest_path_search(spark, size):
    convs = made(size, 60, 18)
    check(convs, report(spark, convs, size)[1])


@pytest.mark.parametrize("size", [1, 4])
def test_runs_of_one_role_whose_costs_do_not_converge(spark, size):
    convs = {**RUNS, 100: [("user", "")] * 17, 101: [("user", "same.")] * 17, 102: [("user", "")] * 9 + RUNS[0] * 2}
    check(convs, report(spark, convs, size)[1])


def test_few_passes_over_many_chunks(spark, monkeypatch):
    passes = []
    kept = repair.stored
    monkeypatch.setattr(repair, "stored", lambda df, label: passes.append(label) or kept(df, label))
    rand = random.Random(1)
    convs = {0: [(rand.choice(["user", "assistant", "tool"]), f"{i}.") for i in range(900)],
             1: [("user", f"{i}.") for i in range(601)]}
    check(convs, report(spark, convs, 3)[1])
    assert passes.count("stitched") <= 8


def test_every_automaton_step_against_all_edits():
    """Chunks of one letter: the reduced costs are those of a plain search from each state."""
    for letters in itertools.product(repair.LETTERS, repeat=2):
        vector, cost = repair.run_backward("".join(letters), repair.ENDED)
        for state in range(4):
            steps, after = repair.run_forward("".join(letters), repair.ENDED, state)
            audit = "".join(d for d, _ in steps)
            price = {"D": 4, "K": 0, "R": 3, "I": 3}
            rows = [e for d, _ in steps for e in d if e != "I"]
            more = sum(3 for x, e in zip(letters, rows) if e != "D" and repair.LETTERS.index(x) % 4 == 1)
            assert sum(price[e] for e in audit) + more + repair.ENDED[after] == vector[state] + cost


def test_repaired_rows_read_as_asked(spark):
    convs = made(7, 30, 12)
    repaired, got = report(spark, convs, 3)
    said = {}
    for r in sorted(repaired.collect(), key=lambda r: r.place):
        said.setdefault(int(r.conv[1:]), []).extend(r.said)
    for c, own in said.items():
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in own))
        assert hashlib.sha256("\n".join(own).encode()).hexdigest() == got[c].repaired_sha256


def test_nulls_ties_long_texts(spark):
    long = "long text " * 30_000 + "."
    rows = [(None, None, None, None), (None, 3, "user", "a."), (None, 3, "user", "a."), (None, 7, "assistant", long),
            (5, None, "user", "b."), (5, None, "assistant", "c.")]
    df = spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows], SCHEMA)
    _, out = repair.repair(df)
    got = {r.conv: r for r in out.collect()}
    assert (got["-"].gaps, got["-"].blank, got["-"].duplicate, got["-"].audit) == (3, 1, 1, "DKDK")
    assert got["-"].repaired_sha256 == hashlib.sha256(f"user:a.\nassistant:{long}".encode()).hexdigest()
    assert (got["=5"].gaps, got["=5"].illegal, got["=5"].cost, got["=5"].audit) == (0, 0, 6, "IKKI")


def test_empty_tables(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair(empty)[1].count() == 0
    # every row of conversation 0 is dropped by the damage, as a row that is not there
    import zlib
    turn = next(t for t in range(999) if zlib.crc32(f"0:{t}".encode()) % 20 == 0)
    spark.createDataFrame([(0, turn, "user", "a.")], "conv_id bigint, turn bigint, role string, text string").write.parquet(
        f"{tmp_path}/conversations.parquet")
    [r] = repair.op13_conversation_structure_repair(spark, str(tmp_path)).collect()
    assert tuple(r) == (0, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
