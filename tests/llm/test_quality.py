import zlib

import numpy as np

from trowel.llm import quality, textstats
from trowel.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def held(doc_id, folds=5):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % folds


def test_word_hashes_do_not_depend_on_the_batch(monkeypatch):
    texts = [None, "", "  ", "One two, ONE", "é é É two", "a" * 3000, "x y " * 4000, "!!!", "one"]
    monkeypatch.setattr(textstats, "GROUP_BYTES", 5000)
    together = textstats.word_counts(texts, 16)
    for i, t in enumerate(texts):
        doc, word, count = textstats.word_counts([t], 16)
        mine = together[0] == i
        assert word.tolist() == together[1][mine].tolist() and count.tolist() == together[2][mine].tolist()
    assert textstats.word_counts(["one"], 16)[1] in textstats.word_counts(["ONE two"], 16)[1]
    assert textstats.word_counts(["x y " * 4000], 16)[2].tolist() == [4000, 4000]


def test_linear_time_score_equals_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    m = quality.Machine(np.zeros((0, 1)), 0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    doc, feature = np.array([0, 0, 0, 2, 2]), np.array([3, 7, 11, 7, 49])
    value = rng.normal(size=5)
    got = m.score(doc, feature, value, 3)
    for d in range(3):
        f, x = feature[doc == d], value[doc == d]
        raw = 0.3 + (m.weights[f] * x).sum() + sum(
            m.factors[f[i]] @ m.factors[f[j]] * x[i] * x[j] for i in range(len(f)) for j in range(i))
        assert abs(got[d] - 1 / (1 + np.exp(-raw))) < 1e-12


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op3_quality_classifier"](spark, FOLDER).collect()}
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (held(i) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for i, r in got.items())
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    test = [(labels[i], r.predicted) for i, r in got.items() if r.held_out and i in labels]
    assert len(test) > 30 and np.mean([a == b for a, b in test]) > 0.9
    assert np.mean([p for a, p in test if a == 1]) > 0.95


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, None, 9.0), (2, "", 0, 9.0), (3, "w " * 50_000, 100_000, 9.0), (4, "fine text here", 14, 9.0),
         (4, "fine text here", 14, 9.0), (None, "no id", 5, 9.0)], "doc_id bigint, text string, n_chars bigint, score double")
    labels = spark.createDataFrame([(1, 0), (3, 0), (4, 1), (4, None), (None, 1), (99, 1)], "doc_id bigint, quality int")
    out = quality.score_quality(docs, labels).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    assert len({r.score for r in out if r.doc_id == 4}) == 1
    assert quality.score_quality(docs.limit(0), labels).count() == 0
    assert {r.score for r in quality.score_quality(docs, labels.limit(0)).collect()} != set()


def test_counts_do_not_depend_on_the_pieces():
    from trowel.llm.textstats import GROUP_BYTES, word_counts
    texts = ["a bb a", None, "", "é" * 50 + " x", "one-two.three " * 9, "w" * 70, " "]
    want = [x.tolist() for x in word_counts(texts, 12, 10 ** 6)]
    for size in (1, 2, 5, 16, 64):
        assert [x.tolist() for x in word_counts(texts, 12, size)] == want
    word = "w" * (3 * GROUP_BYTES)
    assert word_counts([word], 12)[2].tolist() == [1]
    long = f"{word} {'some more words ' * 100_000}{word}"
    assert [x.tolist() for x in word_counts([long], 12)] == [x.tolist() for x in word_counts([long], 12, 1 << 27)]
