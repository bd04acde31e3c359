import numpy as np
from pyspark.sql import functions as F

from trowel.llm import vectors
from trowel.llm.queries import QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, vector string"


def brute(ids, x, queries, k):
    norm, out = np.linalg.norm(x, axis=1), {}
    for q in queries:
        c = np.round(x @ x[q] / (norm * norm[q]), 12)
        order = [int(i) for i in np.lexsort((ids, -c)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), c[i]) for i in order]
    return out


def test_pruning_keeps_near_and_diverse_neighbours():
    points = np.array([[0, 0], [1, 0], [1.1, 0], [0, 1], [-3, 0]], float)
    units = np.column_stack([points, np.ones(5)])
    units = (units / np.linalg.norm(units, axis=1, keepdims=True)).astype(np.float32)
    kept = vectors.robust_prune(units, np.array([0]), np.array([[1, 2, 3, 4, 1, 0, -1]]), 3, 1.2)
    assert set(kept[0].tolist()) >= {1, 3} and 2 not in kept[0]


def test_recall_in_a_shard():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(20, 32))
    x = centres[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 32)) * 0.7
    units = vectors._units(x)
    graph, entries = vectors.build_graph(units)
    assert graph.shape[1] == vectors.DEGREE and (graph != np.arange(1500)[:, None]).all()
    found, _ = vectors.beam_search(units, graph, entries, units[::10], vectors.SEARCH_BEAM)
    best = np.argsort(-(units[::10] @ units.T), axis=1, kind="stable")[:, :6]
    assert np.mean([len(set(a[:6]) & set(b)) / 6 for a, b in zip(found, best)]) > 0.95


def test_recall_of_long_vectors():
    rng = np.random.default_rng(3)
    for length in (64, 384):
        units, asked = (vectors._units(rng.normal(size=(n, length))) for n in (1500, 100))
        graph, entries = vectors.build_graph(units)
        found, _ = vectors.beam_search(units, graph, entries, asked, vectors.search_beam(length))
        best = np.argsort(-(asked @ units.T), axis=1)[:, :5]
        assert np.mean([len(set(a[:5]) & set(b)) / 5 for a, b in zip(found, best)]) >= 0.9


def test_query_recall_and_scores(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = brute(ids, x, np.flatnonzero(ids % 50 == 0), 5)
    got = {}
    for r in QUERIES["op4_approximate_nearest_neighbours"](spark, folder).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert got.keys() == want.keys() and all(sorted(g) == [1, 2, 3, 4, 5] for g in got.values())
    hits = [len({v for v, _ in g.values()} & {v for v, _ in want[q]}) for q, g in got.items()]
    assert sum(hits) >= 0.9 * 5 * len(got)
    where = {int(i): n for n, i in enumerate(ids)}
    for q, g in got.items():
        for v, s in g.values():
            a, b = x[where[q]], x[where[v]]
            assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_many_shards_blocks_copies_and_odd_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 8)).astype(np.float32)
    x[100:200] = x[0]                                     # a third of all rows share a vector
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1001, []), (1002, [0.0] * 8), (1003, [1.0, None] + [0.0] * 6), (1004, [float("nan")] * 8),
           (1005, [float("inf")] + [0.0] * 7), (None, [1.0] * 8), (1010, [1.0, 2.0]), (1020, [2.0, 1.0])]
    df = spark.createDataFrame([(i, v, 1, 0.5, "x") for i, v in rows + odd + rows[:3]], SCHEMA)
    out = {}
    found = vectors.nearest(df, F.col("vec_id") % 20 == 0, 5, shard_vectors=60)
    for r in found.collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    want = brute(np.arange(300), x.astype(float), range(0, 300, 20), 5)
    assert set(out) == {*want, 1020} and out[1020][0][1] == 1010
    for q in want:
        assert [v for _, v, _ in sorted(out[q])] == [v for v, _ in want[q]]
    assert vectors.nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_queries_in_blocks(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(120, 6)))], "vec_id bigint, embedding array<double>")
    classes = vectors._classes(df.select("vec_id", F.col("embedding").alias("vector")), 6)
    index = vectors.build_index(classes.select("class_no", "vector"), shard_vectors=50)
    asked = classes.select(F.col("class_no").alias("query_no"), "vector")
    one = vectors.search(index, asked, 3).groupBy("query_no").agg(F.max("score")).count()
    assert vectors.search(index, asked, 3, query_block=25).groupBy("query_no").agg(F.max("score")).count() == one == 120
    rows = sorted(map(tuple, vectors.search(index, asked, 3).collect()))
    assert sorted(map(tuple, vectors.search(index, asked, 3, query_block=25).collect())) == rows
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # shards and queries cut anywhere
    try:
        assert sorted(map(tuple, vectors.search(index, asked, 3).collect())) == rows
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_scores_of_very_large_and_small_components(spark):
    rows = [(1, [1e200, 1e200]), (2, [1e-200, 2e-200]), (3, [3e307, 0.0]), (4, [5e-324, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in vectors.nearest(df, F.lit(True)).collect()}
    assert len(got) == 12 and got[3, 4] == 1.0 and abs(got[1, 2] - 3 / 10 ** 0.5) < 1e-12 and abs(got[1, 3] - 0.5 ** 0.5) < 1e-12
