import hashlib

import pytest
from pyspark.sql import functions as F

from trowel.llm import merkle

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, grp int, digest int, rank int"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r):
    return h("".join("-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in merkle.FIELDS))


def tree(nodes):
    """Levels from the leaves up to one node."""
    levels = [list(nodes)]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([h("".join(low[i:i + 3])) for i in range(0, len(low), 3)])
    return levels


def way(levels, place):
    out = []
    for low in levels[:-1]:
        run = low[place // 3 * 3:place // 3 * 3 + 3]
        out.append(("".join(run[:place % 3]), "".join(run[place % 3 + 1:])))
        place //= 3
    return out


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s])]) for s in names}
    crown = tree([trees[s][-1][0] for s in names])
    out = []
    for i, s in enumerate(names):
        for place, (known, doc_id, own) in enumerate(sorted(groups[s])):
            out.append((s, doc_id if known else None, own, trees[s][-1][0], crown[-1][0],
                        tuple(way(trees[s], place) + way(crown, i))))
    return sorted(out, key=str)


def build(spark, rows):
    docs = spark.createDataFrame([(*r.values(), 1, 2, 3) for r in rows], DOCS)
    docs = docs.withColumn("leaf", merkle.record_digest(*[F.col(c) for c in merkle.FIELDS]))
    return merkle.proofs(docs, "source", "doc_id", "leaf", ["doc_id", "source"])


def row(doc_id, source, text="x", lang="en"):
    return {"doc_id": doc_id, "source": source, "lang": lang, "n_chars": None if text is None else len(text), "text": text}


CASES = {
    "one": [row(5, "a")],
    "nulls": [row(1, None), row(None, None), row(None, ""), row(2, "", None, None), row(3, "é", "ß\n"), row(4, "z", "")],
    "ties": [row(1, "a", "b")] * 4 + [row(1, "a", "c")] * 3 + [row(2, "b")],
    "long": [row(1, "a", "word\n" * 200_000), row(2, "a", "")],
    "more than a block": [row(i, "hot") for i in range(800)] + [row(i, f"s{i}") for i in range(300)],
    "heights": [row(i, f"s{n}") for n in (1, 2, 3, 4, 9, 10, 27, 28, 243, 244) for i in range(n)],
}


@pytest.mark.parametrize("case", CASES)
def test_every_proof_against_trees_in_python(spark, case):
    got = build(spark, CASES[case]).collect()
    told = sorted(((r.source, r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.proof))
                   for r in got), key=str)
    assert told == expected(CASES[case])


def test_small_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    rows = CASES["heights"][:47] + CASES["nulls"]
    got = build(spark, rows)
    told = sorted(((r.source, r.doc_id, r.leaf, r.subroot, r.root, tuple((s.left, s.right) for s in r.proof))
                   for r in got.collect()), key=str)
    assert told == expected(rows)
    assert got.where(merkle.folded(F.col("leaf"), F.col("proof")) != F.col("root")).count() == 0


def test_a_changed_text_does_not_verify(spark, tmp_path):
    rows = [row(i, "s", f"line\n{i}") for i in range(12)] + [row(12, None, None, None), row(None, "s", "a\n"), row(13, "t", "a")]
    spark.createDataFrame([tuple(r.values()) for r in rows], DOCS.split(", grp")[0]).write.parquet(
        f"{tmp_path}/documents.parquet")
    import zlib
    for r in merkle.op11_merkle_dataset_manifest(spark, str(tmp_path)).collect():
        source = next(x for x in rows if x["doc_id"] == r.doc_id)
        changed = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 2 == 0 and "\n" in (source["text"] or "")
        assert r.verified == (not changed) and r.leaf == leaf(source)


def test_empty_table(spark):
    assert build(spark, []).count() == 0
