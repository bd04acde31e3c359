import random

import numpy as np
import pytest
import xxhash

from trowel.llm import golay, simhash
from trowel.llm.common import components


def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    n = max(1, len(words) - k + 1) if words else 0
    shingles = [b" ".join(words[i:i + k]) for i in range(n)]
    sums = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            sums[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * sums[b] > len(shingles))


def brute_components(prints, ids, bits=3):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                root[find(i)] = find(j)
    least = {}
    for i in range(len(prints)):
        known = [x for x in (least.get(find(i)), ids[i]) if x is not None]
        least[find(i)] = min(known) if known else None
    return [least[find(i)] for i in range(len(prints))]


def test_golay_is_perfect():
    words = np.arange(1 << golay.BITS)
    assert set(np.bincount(golay.index(words)).tolist()) == {1 << golay.PARITY_BITS}


def test_words_one_bit_apart_share_an_index():
    words = np.random.default_rng(1).integers(0, 1 << golay.BITS, 5000)
    near = golay.nearby_indices(words)
    assert all((near == golay.index(words ^ flip)[:, None]).any(1).all()
               for flip in [0, *(1 << b for b in range(golay.BITS))])


def test_any_three_bits_apart_share_a_bucket():
    rng = random.Random(2)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randint(0, 3)):
            b ^= 1 << bit
        a, b = (np.array([x], np.uint64).view(np.int64) for x in (a, b))
        own = [golay.index(s) for s in simhash._segments(a)]
        near = [golay.nearby_indices(s) for s in simhash._segments(b)]
        assert any((near[i] == own[i][:, None]).any() and (near[j] == own[j][:, None]).any()
                   for i, j in simhash.PAIRS)


@pytest.mark.parametrize("text", [None, "", "  \t\n", "One", "one two", "A b C d É é\x0bf", "x " * 70_000,
                                  "nbsp stays Ä ä"])
def test_fingerprint_by_definition(text):
    assert simhash.simhash(text) & (1 << 64) - 1 == brute_print(text)


def test_components_of_long_paths(spark):
    rng = random.Random(3)
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    pairs = path + star + [(5000, 5000), (7, 250)]
    rng.shuffle(pairs)
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(301)}, **{1000 + i: 1000 for i in range(200)}}


def documents(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(300)]
    base = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 400))) for _ in range(40)]
    texts = [None, "", " ", "one", "One", "one two"] + base
    for t in base[:25]:
        words = t.split()
        for _ in range(3):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
            texts.append(" ".join(words))
    rows = [(1000 - i, t, i, "x") for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (None, texts[9], 0, "y"), (None, "alone and without an id", 0, "y")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, fp int, bucket string"), rows


@pytest.mark.parametrize("dense", [512, 1])
def test_near_duplicates_against_all_pairs(spark, dense):
    docs, rows = documents(spark)
    prints = [brute_print(r[1]) for r in rows]
    want = brute_components(prints, [r[0] for r in rows])
    got = simhash.near_duplicates(docs, dense_bucket=dense).collect()
    shown = sorted((r.doc_id or -1, r.fp & (1 << 64) - 1, r.component_id or -1) for r in got)
    assert shown == sorted((r[0] or -1, p, c or -1) for r, p, c in zip(rows, prints, want))
    assert len({c for c in want}) < len(rows) - 10


def test_dense_buckets_keep_all_components(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 300:
        p = centre
        for bit in rng.sample(range(64), rng.randint(1, 4)):
            p ^= 1 << bit
        prints.add(p)
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    roots = [{r.node: r.root for r in components(simhash.links(frame, dense_bucket=d)).collect()} for d in (10 ** 6, 3)]
    assert roots[0] == roots[1]
    assert simhash.links(frame, dense_bucket=3).count() > 0


def test_one_of_each_group_stays(spark):
    docs, rows = documents(spark)
    want = brute_components([brute_print(r[1]) for r in rows], [r[0] for r in rows])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns and kept.schema == docs.schema
    ids = sorted(r.doc_id or -1 for r in kept.collect())
    assert ids == sorted(c or -1 for c in set(want))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).columns == ["doc_id", "text"]
    assert simhash.drop_near_duplicates(empty).count() == 0
