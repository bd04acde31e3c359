"""Approximate nearest neighbours: a robust-pruned directed graph for each shard."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from trowel.llm.common import read, stored

SHARD_VECTORS = 4096   # vectors of one graph, about
QUERY_BLOCK = 4096     # queries for which a shard is copied, at least
DEGREE = 24            # edges out of a node
BEAM = 48              # nodes kept while searching to build
SEARCH_BEAM = 64       # and while answering, and one more for every two components
RELAX = 1.2            # how much longer a detour may be before an edge is kept
BATCH = 512            # nodes inserted together
WIDTH = 4              # beam nodes followed in one step


def _nearness(units: np.ndarray, nodes: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Squared distance of each row's nodes to its query; -1 is no node, infinitely far."""
    d = 2 - 2 * np.einsum("bkd,bd->bk", units[nodes], queries)
    return np.where(nodes < 0, np.inf, np.maximum(d, 0))


def beam_search(units: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Greedy search of all queries at once: the ``beam`` nearest nodes met and their squared
    distances, nearest first. Each step follows the nearest nodes not yet followed."""
    rows, b = np.arange(len(queries))[:, None], len(queries)
    met = np.zeros((b, len(units)), bool)
    start = np.unique(entries)
    met[:, start] = True
    ids = np.broadcast_to(start, (b, len(start))).copy()
    far = _nearness(units, ids, queries)
    done = np.zeros(ids.shape, bool)
    while True:
        order = np.argsort(far, axis=1, kind="stable")[:, :beam]
        ids, far, done = ids[rows, order], far[rows, order], done[rows, order]
        open_ = ~done & (ids >= 0)
        live = open_.any(1)
        if not live.any():
            return ids, far
        rank = np.where(open_, np.cumsum(open_, axis=1), beam + 1)
        follow = rank <= WIDTH
        step = np.full((b, WIDTH), -1, np.int64)
        r, c = np.nonzero(follow)
        step[r, rank[r, c] - 1] = ids[r, c]
        done |= follow
        new = np.where(step[:, :, None] < 0, -1, graph[step]).reshape(b, -1)
        new = np.where((new >= 0) & met[rows, new], -1, new)
        new.sort(axis=1)
        new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
        r, c = np.nonzero(new >= 0)
        met[r, new[r, c]] = True
        new = new[:, (new >= 0).any(0)]
        ids = np.concatenate([ids, new], 1)
        far = np.concatenate([far, _nearness(units, new, queries)], 1)
        done = np.concatenate([done, np.zeros(new.shape, bool)], 1)


def robust_prune(units: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int,
                 relax: float) -> np.ndarray:
    """For each node up to ``degree`` of its candidates, nearest first: a candidate goes once a
    chosen one is ``relax`` times nearer to it than the node is. -1 fills the rest."""
    rows = np.arange(len(nodes))[:, None]
    candidates = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
    candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
    far = _nearness(units, candidates, units[nodes])
    order = np.argsort(far, axis=1, kind="stable")
    candidates, far = candidates[rows, order], far[rows, order]
    points, alive = units[candidates], candidates >= 0
    out = np.full((len(nodes), degree), -1, np.int64)
    for k in range(degree):
        some = alive.any(1)
        if not some.any():
            break
        pick = alive.argmax(1)
        out[some, k] = candidates[some, pick[some]]
        between = 2 - 2 * np.einsum("bkd,bd->bk", points, points[rows[:, 0], pick])
        alive &= relax * relax * np.maximum(between, 0) > far
        alive[rows[:, 0], pick] = False
    return out


def build_graph(units: np.ndarray, degree: int = DEGREE, beam: int = BEAM, relax: float = RELAX,
                seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(neighbours of each node, entry nodes). Nodes join in batches, first without and then
    with relaxed pruning; what a search on the graph so far meets is proposed as neighbours,
    and each edge proposes its reverse. The vectors must be distinct."""
    n, rng = len(units), np.random.default_rng(seed)
    graph = rng.integers(0, n, (n, degree))
    graph[:, degree // 2:] = -1
    graph[graph == np.arange(n)[:, None]] = -1
    middle = int(np.argmax(units @ units.mean(0)))
    entries = np.unique(np.r_[middle, rng.choice(n, min(n, 16), replace=False)])
    for stretch in (1.0, relax):
        order = rng.permutation(n)
        for start in range(0, n, BATCH):
            nodes = order[start:start + BATCH]
            near, _ = beam_search(units, graph, entries, units[nodes], beam)
            graph[nodes] = robust_prune(units, nodes, np.concatenate([near, graph[nodes]], 1), degree, stretch)
            source = np.repeat(nodes, degree)
            target = graph[nodes].ravel()
            source, target = source[target >= 0], target[target >= 0]
            by = np.argsort(target, kind="stable")
            source, target = source[by], target[by]
            to, first, count = np.unique(target, return_index=True, return_counts=True)
            place = np.arange(len(target)) - np.repeat(first, count)
            for lot in range(0, int(count.max(initial=0)), degree):  # in lots, so that none is left out
                here = (place >= lot) & (place < lot + degree)
                rows = np.searchsorted(to, target[here])
                back = np.full((len(to), degree), -1, np.int64)
                back[rows, place[here] - lot] = source[here]
                some = (back >= 0).any(1)
                known = to[some]
                graph[known] = robust_prune(units, known, np.concatenate([graph[known], back[some]], 1), degree, stretch)
    lost = np.setdiff1d(np.arange(n), graph[graph >= 0])  # nodes that no edge leads to
    return graph, np.union1d(entries, lost)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack([np.asarray(v, np.float64) for v in column])


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """The vectors by powers of two, so that squares neither vanish nor overflow: cosines stay
    what they are, to the last bit."""
    _, power = np.frexp(np.abs(vectors).max(1, keepdims=True))
    return np.ldexp(vectors, -power)


def _units(vectors: np.ndarray) -> np.ndarray:
    vectors = _scaled(vectors)
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def valid(vector: Column) -> Column:
    """True for vectors that take part: not null or empty, all components finite, not all zero."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: x != 0), F.lit(False))


def _classes(rows: DataFrame, members: int) -> DataFrame:
    """Each distinct vector with its smallest ids: (class_no, vector, ids).

    Equal vectors are equally near to any query, and of equal ones the smaller ids come first;
    so no answer needs more than ``members`` ids of one vector, and a vector that very many
    rows share is one node of the graph. The limit is applied before the shuffle.
    """
    own = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("place", F.row_number().over(own)).where(F.col("place") <= members)
    return stored(few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(
        F.monotonically_increasing_id().alias("class_no"), "vector", "ids"), "classes")


def build_index(classes: DataFrame, shard_vectors: int = SHARD_VECTORS, seed: int = 0) -> DataFrame:
    """A graph for each shard: (shard, class_no, vector, neighbours, entry), stored.

    Shards are cut by a hash of the vector, and by its length, to about ``shard_vectors`` each;
    a shard is built in one task and holds no more, whatever the number of vectors.
    """
    sizes = classes.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    shards = sizes.select("length", F.ceil(F.col("n") / shard_vectors).alias("shards"))
    placed = classes.withColumn("length", F.size("vector")).join(F.broadcast(shards), "length").select(
        "class_no", "vector", F.struct("length", F.pmod(F.xxhash64("vector"), "shards").alias("part")).alias("place"))
    placed = placed.select("class_no", "vector", F.concat_ws(":", "place.length", "place.part").alias("shard"))

    def built(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("class_no")
        graph, entries = build_graph(_units(_matrix(frame["vector"])), seed=seed)
        return pd.DataFrame({
            "shard": frame["shard"].to_numpy(), "class_no": frame["class_no"].to_numpy(),
            "vector": frame["vector"].to_numpy(), "node": np.arange(len(frame)),
            "neighbours": list(graph), "entry": np.isin(np.arange(len(frame)), entries)})

    kind = T.StructType([
        T.StructField("shard", T.StringType()), T.StructField("class_no", T.LongType()),
        T.StructField("vector", classes.schema["vector"].dataType), T.StructField("node", T.IntegerType()),
        T.StructField("neighbours", T.ArrayType(T.LongType())), T.StructField("entry", T.BooleanType())])
    return stored(placed.groupBy("shard").applyInPandas(built, kind), "graph")


def search_beam(length: int) -> int:
    """Nodes kept while answering: more for longer vectors, whose distances differ less."""
    return SEARCH_BEAM + length // 2


def _answered(k: int, beam: int | None):
    """Answers a stream of shards, each with its nodes ahead of its queries; what is held is the
    nodes of one shard and a batch of queries."""
    def answer(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held, ready = None, [], None
        for batch in batches:
            for key, rows in batch.groupby(["shard", "block"], sort=False):
                if key != shard:
                    shard, held, ready = key, [], None
                nodes, asked = rows[~rows["asks"]], rows[rows["asks"]]
                if len(nodes):
                    held.append(nodes)
                if asked.empty or not held:
                    continue
                if ready is None:
                    own = pd.concat(held)
                    vectors = _matrix(own["vector"])
                    ready = (own["no"].to_numpy(), vectors, _units(vectors), np.stack(own["neighbours"].to_numpy()),
                             np.flatnonzero(own["entry"].to_numpy(bool)))
                numbers, vectors, units, graph, entries = ready
                for start in range(0, len(asked), BATCH):
                    some = asked.iloc[start:start + BATCH]
                    wanted = _matrix(some["vector"])
                    near, _ = beam_search(units, graph, entries, _units(wanted), beam or search_beam(units.shape[1]))
                    r, c = np.nonzero(near >= 0)
                    a, b = _scaled(vectors[near[r, c]]), _scaled(wanted[r])
                    score = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
                    found = pd.DataFrame({"query_no": some["no"].to_numpy()[r], "class_no": numbers[near[r, c]],
                                          "score": score})
                    found = found.sort_values(["query_no", "score"], ascending=[True, False], kind="stable")
                    last = found.groupby("query_no")["score"].transform(lambda s: s.iloc[min(k, len(s)) - 1])
                    yield found[found["score"] >= last]  # with ties of the k-th
    return answer


def search(index: DataFrame, queries: DataFrame, k: int, beam: int | None = None,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """The ``k`` nearest classes that each shard finds for each query (query_no, vector):
    (query_no, class_no, score), score being the cosine in double precision.

    Every query visits every shard of its length. A task reads a shard's nodes once and streams
    the queries past them. Only while there are fewer shards than tasks, a shard is copied for
    further blocks of queries, of no fewer than ``query_block``; the index as a whole is never
    copied more often than it takes to fill the tasks twice.
    """
    part = F.split("shard", ":")
    lengths = stored(index.groupBy(part[0].cast("int").alias("length")).agg(
        (F.max(part[1].cast("bigint")) + 1).alias("shards")), "lengths")
    shards = lengths.agg(F.sum("shards")).first()[0] or 1
    spark = index.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    blocks = max(1, min(math.ceil(queries.count() / query_block), math.ceil(2 * tasks / shards)))
    copies = index.select("shard", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"),
                          F.lit(False).alias("asks"), F.col("class_no").alias("no"), "node", "vector", "neighbours",
                          "entry")
    sent = queries.withColumn("length", F.size("vector")).join(lengths, "length").withColumn(
        "part", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).select(
        F.concat_ws(":", "length", "part").alias("shard"),
        F.pmod(F.xxhash64("query_no"), F.lit(blocks)).cast("int").alias("block"), F.lit(True).alias("asks"),
        F.col("query_no").alias("no"), "vector")
    rows = copies.unionByName(sent, allowMissingColumns=True).repartition("shard", "block")
    return rows.sortWithinPartitions("shard", "block", "asks", "node").mapInPandas(
        _answered(k, beam), "query_no bigint, class_no bigint, score double")


def nearest(rows: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding", **options) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows found for each query row.

    All rows are indexed: distinct vectors as nodes of sharded graphs, with the ids that share
    them. Scores are cosines of the original vectors in double precision; ties go to the
    smaller id. Defined cases: vectors that are null, empty, zero or hold a null or a number
    that is not finite take no part, nor do rows without an id; repeated rows of one id and
    vector count once; vectors of different length are never compared; with ``k`` or fewer
    other rows all that are found are given; an empty table gives an empty one.
    """
    some = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"),
                       is_query.alias("asks")).where(F.col("vec_id").isNotNull() & valid(F.col("vector")))
    classes = _classes(some.select("vec_id", "vector").distinct(), k + 1)
    index = build_index(classes.select("class_no", "vector"), **options)
    queries = stored(some.where("asks").select("vec_id", "vector").distinct().select(
        F.monotonically_increasing_id().alias("query_no"), "vec_id", "vector"), "queries")
    found = search(index, queries.select("query_no", "vector"), k + 1)
    known = found.join(classes.select("class_no", "ids"), "class_no").join(
        queries.select("query_no", F.col("vec_id").alias("query_id")), "query_no")
    each = known.select("query_no", "query_id", "score", F.explode("ids").alias("vec_id")).where(
        F.col("vec_id") != F.col("query_id"))
    order = Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")


def op4_approximate_nearest_neighbours(spark, folder: str) -> DataFrame:
    rows = read(spark, folder, "embeddings")
    return nearest(rows, F.col("vec_id") % 50 == 0)
