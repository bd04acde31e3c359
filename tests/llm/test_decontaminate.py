import random
import re

import pytest

from trowel.llm import decontaminate
from trowel.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(decontaminate.CAPITALS, decontaminate.CAPITALS.lower())


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(size, len(w))
        for i in range(len(w) - n + 1) if w else ():
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i:i + n]))
                if own is not None:
                    hit.update(range(i, i + n))
                    found |= own
        out.append((doc, len(w), len(hit), sorted(i for i in found if i is not None)))
    return out


def tables(spark):
    rng = random.Random(1)
    vocabulary = ["Alpha", "beta", "ÉTÉ", "été", "x1", "2", "ΑΣ", "ας", "İ", "don", "t"] + [f"v{i}" for i in range(40)]
    say = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "'"]) for _ in range(n))
    items = [(i, say(rng.choice([1, 3, 9, 10, 11, 25]))) for i in range(12)]
    items += [(20, None), (21, ""), (22, "!!!"), items[3], (30, items[5][1]), (None, say(12))]
    docs = [(i, say(rng.choice([0, 1, 5, 40, 300]))) for i in range(40)]
    docs += [(100 + i, f"{say(8)} {t.upper() if i % 2 else t} {say(8)}") for i, (_, t) in enumerate(items) if t]
    docs += [(200, None), (201, ""), (202, "...")] + [docs[45]] * 3 + [(None, items[5][1])]
    docs += [(300, " ".join(t for _, t in items if t) * 30)]
    return docs, items


def frames(spark, docs, items):
    return (spark.createDataFrame([(d, t, 1, "a") for d, t in docs], "doc_id bigint, text string, at int, items string"),
            spark.createDataFrame([(i, t, 5) for i, t in items], "item_id bigint, text string, words int"))


@pytest.mark.parametrize("limit", [decontaminate.BROADCAST_BYTES, 2000])
def test_scan_against_brute_force(spark, limit):
    docs, items = tables(spark)
    d, i = frames(spark, docs, items)
    covered = decontaminate._covered(decontaminate.F.col("hits"))
    got = decontaminate.scan(d, i, broadcast_bytes=limit).select("doc_id", "n_words", covered.alias("n"), "items")
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(docs, items), key=key)


def test_removing_documents_keeps_the_clean(spark):
    docs, items = tables(spark)
    d, i = frames(spark, docs, items)
    kept = decontaminate.remove_contaminated(d, i)
    assert kept.schema == d.schema
    clean = [x[0] for x in brute(docs, items) if not x[2]]
    assert sorted(r.doc_id for r in kept.collect()) == sorted(clean)


def test_removing_spans(spark):
    d, i = frames(spark, [(1, "  Keep this. One two, THREE four! and that"), (2, "nothing here"), (3, None)],
                  [(1, "one two three four")])
    got = {r.doc_id: r.text for r in decontaminate.remove_contaminated(d, i, "spans").collect()}
    assert got == {1: "  Keep this. and that", 2: "nothing here", 3: None}


def test_empty_tables(spark):
    docs, items = tables(spark)
    d, i = frames(spark, docs, items)
    assert decontaminate.scan(d.limit(0), i).count() == 0
    none = decontaminate.remove_contaminated(d, i.limit(0))
    assert none.count() == d.count()


def test_no_python_in_the_plan(spark):
    df = QUERIES["op6_benchmark_decontamination"](spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|ArrowEval|CartesianProduct|NestedLoop", plan)
    assert "BroadcastHashJoin" in plan


def test_parts_agree_when_scans_differ(spark):
    def mix(frames):
        for frame in frames:
            yield frame.sample(frac=1, random_state=random.SystemRandom().randrange(2**31))

    docs, items = tables(spark)
    d, i = frames(spark, docs, items)
    mixed = d.coalesce(1).mapInPandas(mix, d.schema)  # each scan gives the rows in another order
    covered = decontaminate._covered(decontaminate.F.col("hits"))
    got = decontaminate.scan(mixed, i, broadcast_bytes=2000).select("doc_id", "n_words", covered.alias("n"), "items")
    key = lambda r: (r[0] is None, r)
    assert sorted((tuple(r) for r in got.collect()), key=key) == sorted(brute(docs, items), key=key)
    kept = decontaminate.remove_contaminated(mixed, i, broadcast_bytes=2000)
    assert kept.schema == d.schema
    assert sorted(r.doc_id for r in kept.collect()) == sorted(x[0] for x in brute(docs, items) if not x[2])
