"""Quality classifier: a factorisation machine over hashed words, structure and metadata."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trowel.llm import textstats
from trowel.llm.common import fold, read

WORD_BITS = 16
BINS = 12
FACTORS = 8
SAMPLE_ROWS = 8_000   # labelled rows that the model is fitted on, at most
EPOCHS = 8
STEPS = 500             # steps of gradient descent at least: small samples are seen more often
THRESHOLD = 0.3


@dataclass
class Machine:
    """w0, w and v over word buckets, followed by the bins of each figure."""

    edges: np.ndarray    # figures x inner bin edges
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, doc: np.ndarray, feature: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
        """The probability of label 1 for texts 0 … n-1 of sorted (doc, feature, value) entries.

        The sum over all pairs of features of <v_i, v_j> x_i x_j is half the difference of the
        squared sum and the sum of squares, factor by factor: linear in the entries.
        """
        out = np.full(n, self.bias)
        if len(doc):
            first = np.flatnonzero(np.diff(doc, prepend=-1))
            vx = self.factors[feature] * value[:, None]
            total, squares = np.add.reduceat(vx, first), np.add.reduceat(vx * vx, first)
            out[doc[first]] += np.add.reduceat(self.weights[feature] * value, first) + 0.5 * (
                total * total - squares).sum(1)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _figures(texts: list, metadata: np.ndarray | None) -> np.ndarray:
    found = textstats.structure(texts)
    return found if metadata is None else np.column_stack([found, metadata])


def _entries(texts: list, figures: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (doc, feature, value): words by damped frequency, and one bin of each figure."""
    doc, word, count = textstats.word_counts(texts, WORD_BITS)
    value = np.log1p(count)
    norm = np.sqrt(np.bincount(doc, value * value, minlength=len(texts)))
    value = value / np.maximum(norm[doc], 1e-9)
    n, k = figures.shape
    bins = np.empty((n, k), int)
    for j in range(k):
        bins[:, j] = np.searchsorted(edges[j], figures[:, j], side="right")
    binned = (1 << WORD_BITS) + np.arange(k) * BINS + bins
    doc = np.concatenate([doc, np.repeat(np.arange(n), k)])
    feature = np.concatenate([word, binned.ravel()])
    value = np.concatenate([value, np.full(n * k, 1 / np.sqrt(max(k, 1)))])
    order = np.argsort(doc, kind="stable")
    return doc[order], feature[order], value[order]


def train(texts: list, labels: np.ndarray, metadata: np.ndarray | None = None, seed: int = 7,
          epochs: int = EPOCHS, rate: float = 0.1, decay: float = 1e-5) -> Machine:
    """Fit on a bounded sample by AdaGrad in small batches, logistic loss."""
    figures = _figures(texts, metadata)
    share = np.linspace(0, 1, BINS + 1)[1:-1]
    edges = np.quantile(figures, share, axis=0).T if len(texts) else np.zeros((figures.shape[1], BINS - 1))
    doc, feature, value = _entries(texts, figures, edges)
    size, rng = (1 << WORD_BITS) + figures.shape[1] * BINS, np.random.default_rng(seed)
    prior = float(np.clip(labels.mean() if len(labels) else 0.5, 0.01, 0.99))
    m = Machine(edges, np.log(prior / (1 - prior)), np.zeros(size), rng.normal(0, 0.05, (size, FACTORS)))
    seen_w, seen_v, seen_b = np.full(size, 1e-3), np.full((size, FACTORS), 1e-3), 1e-3
    begin = np.searchsorted(doc, np.arange(len(texts) + 1))
    batches = max(1, len(texts) // 128)
    for _ in range(max(epochs, -(-STEPS // batches)) if len(texts) else 0):
        for batch in np.array_split(rng.permutation(len(texts)), batches):
            batch = batch[begin[batch + 1] > begin[batch]]
            if not len(batch):
                continue
            lengths = begin[batch + 1] - begin[batch]
            first = np.cumsum(lengths) - lengths
            at = np.arange(lengths.sum()) - np.repeat(first - begin[batch], lengths)
            f, x = feature[at], value[at]
            vx = m.factors[f] * x[:, None]
            total = np.add.reduceat(vx, first)
            raw = m.bias + np.add.reduceat(m.weights[f] * x, first) + 0.5 * (
                (total * total).sum(1) - np.add.reduceat((vx * vx).sum(1), first))
            miss = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[batch]) / len(batch)
            each = np.repeat(miss, lengths) * x
            used, where = np.unique(f, return_inverse=True)
            by = np.argsort(where, kind="stable")
            runs = np.searchsorted(where[by], np.arange(len(used)))
            grad_v = np.add.reduceat((each[:, None] * (np.repeat(total, lengths, axis=0) - vx))[by], runs)
            grad_w = np.add.reduceat(each[by], runs) + decay * m.weights[used]
            grad_v += decay * m.factors[used]
            seen_w[used] += grad_w ** 2
            seen_v[used] += grad_v ** 2
            seen_b += miss.sum() ** 2
            m.weights[used] -= rate * grad_w / np.sqrt(seen_w[used])
            m.factors[used] -= rate * 0.5 * grad_v / np.sqrt(seen_v[used])
            m.bias -= rate * miss.sum() / np.sqrt(seen_b)
    return m


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, rows: int,
                    columns: list[str], id_col: str = "doc_id") -> DataFrame:
    """At most ``rows`` labelled documents outside fold 0, those with the smallest id hashes:
    (sample_label, columns…). Ids with differing labels count as 1 if any of them does; of rows
    that repeat an id, one is taken.

    The sample is chosen from the labels, which are narrow; its ids, at most ``rows``, are
    broadcast, so that the texts of other rows are not shuffled.
    """
    chosen = labels.select(F.col(id_col).alias("sample_id"), F.col(label).cast("double").alias("sample_label")).where(
        F.col("sample_id").isNotNull() & F.col("sample_label").isNotNull() & (fold("sample_id", folds) != 0)
    ).groupBy("sample_id").agg(F.max("sample_label").alias("sample_label")).orderBy(
        F.xxhash64("sample_id"), "sample_id").limit(rows)
    found = docs.select(F.col(id_col).alias("own_id"), F.struct(*columns).alias("row")).join(
        F.broadcast(chosen), F.col("own_id") == F.col("sample_id"))
    one = Window.partitionBy("sample_id").orderBy(F.xxhash64("row"))
    return found.withColumn("place", F.row_number().over(one)).where("place = 1").select(
        "sample_label", *[F.col("row")[c].alias(c) for c in columns])


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  length_col: str | None = "n_chars", label_col: str = "quality", folds: int = 5,
                  sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Every row as (doc_id, held_out, score): the chance that its quality label is 1.

    The machine is fitted on at most ``sample_rows`` labelled rows outside fold 0 and scores
    every whole text in one scan. ``length_col`` is the metadata it may look at besides.

    Defined cases: a null text is an empty one and is scored by its figures alone; a null
    length counts as -1; without any labelled row all scores are 0.5; repeated rows have the
    same score; a null id counts as the empty text for the fold; other columns don't matter.
    """
    columns = [text_col] + ([length_col] if length_col else [])
    sample = labelled_sample(docs, labels, label_col, folds, sample_rows, columns, id_col).toPandas()
    length = lambda s: np.log1p(s.fillna(-1).to_numpy(float) + 1)
    metadata = length(sample[length_col])[:, None] if length_col else None
    machine = train(list(sample[text_col]), sample["sample_label"].to_numpy(float), metadata)
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # the size of its tables, whatever the data

    @F.pandas_udf("double")
    def score(frames: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        m = shared.value
        for texts, lengths in frames:
            out = np.empty(len(texts))
            for start in range(0, len(texts), 500):
                held = list(texts[start:start + 500])
                more = length(lengths[start:start + 500])[:, None] if length_col else None
                found = _entries(held, _figures(held, more), m.edges)
                out[start:start + 500] = m.score(*found, len(held))
            yield pd.Series(out)

    meta = F.col(length_col).cast("double") if length_col else F.lit(None).cast("double")
    return docs.select(F.col(id_col).alias("doc_id"), (fold(id_col, folds) == 0).alias("held_out"),
                       score(F.col(text_col), meta).alias("score"))


def op3_quality_classifier(spark, folder: str) -> DataFrame:
    found = score_quality(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
