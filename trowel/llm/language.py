"""Language ID as mixture inference: each document's language shares by EM over its n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trowel.llm.common import fold, read

BUCKET_BITS = 13       # hashed n-grams of two and three bytes, for each length
LENGTHS = (2, 3)
ROUNDS = 25            # EM steps for one set of languages; most converge sooner
ORDER_ROUNDS = 6       # EM steps that order the languages
PENALTY = 0.5          # log-likelihood that another language must gain, by log of the n-grams
UNKNOWN = "und"
_PIECE = 1 << 20
_MULTIPLY = np.uint32(2654435761)
_B = np.arange(256)
_LETTER = ((_B >= 97) & (_B <= 122)) | ((_B >= 65) & (_B <= 90)) | (_B >= 128)
_FOLD = np.where((_B >= 65) & (_B <= 90), _B + 32, np.where(_LETTER, _B, 32)).astype(np.uint8)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def ngram_counts(text: str | None, piece: int = _PIECE) -> np.ndarray:
    """Counts of the hashed byte n-grams of the lower-case text, all that is no letter taken as
    one blank. Long texts are worked on in pieces; the last bytes of one go before the next, so
    that the counts are those of the whole."""
    raw = b" %b " % (text or "").lower().encode("utf-8", "replace")
    size, most = 1 << BUCKET_BITS, max(LENGTHS)
    out = np.zeros(size * len(LENGTHS), np.int64)
    tail = np.empty(0, np.uint8)
    for start in range(0, len(raw), piece):
        data = np.concatenate([tail, _FOLD[np.frombuffer(raw[start:start + piece], np.uint8)]])
        blank = data == 32
        data = data[~(blank & np.concatenate([[False], blank[:-1]]))]
        wide = data.astype(np.uint32)
        for k, n in enumerate(LENGTHS):
            first = max(0, len(tail) - n + 1)  # what ends in the tail has been counted
            if len(data) - first < n:
                continue
            gram = wide[first:len(data) - n + 1].copy()
            for j in range(1, n):
                gram = (gram << np.uint32(8)) | wide[first + j:len(data) - n + 1 + j]
            bucket = (gram * _MULTIPLY) >> np.uint32(32 - BUCKET_BITS)
            out[k * size:(k + 1) * size] += np.bincount(bucket, minlength=size)
        tail = data[1 - most:]
    return out


@dataclass
class Languages:
    names: list[str]
    chances: np.ndarray   # buckets x languages: P(n-gram | language)

    def __post_init__(self):
        self.logs = np.log(self.chances)


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Languages:
    """n-gram chances of each language from all the rows with a language, counted by Spark: a
    table of languages x buckets comes to the driver, however many rows there are."""
    size = len(LENGTHS) << BUCKET_BITS

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for frame in frames:
            for lang, text in zip(frame.lang, frame.text):
                sums.setdefault(lang, np.zeros(size, np.int64))
                sums[lang] += ngram_counts(text)
        for lang, n in sums.items():
            seen = np.flatnonzero(n)
            if len(seen):
                yield pd.DataFrame({"lang": lang, "bucket": seen, "n": n[seen]})

    rows = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    sums = rows.mapInPandas(counted, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(
        F.sum("n").alias("n")).toPandas()
    names = sorted(sums["lang"].unique())
    counts = np.zeros((size, len(names)))
    if names:
        counts[sums["bucket"].to_numpy(), np.searchsorted(names, sums["lang"].to_numpy().astype(str))] = sums["n"]
    counts += 0.5
    by_length = counts.reshape(len(LENGTHS), 1 << BUCKET_BITS, len(names))
    return Languages(names, (by_length / by_length.sum(1, keepdims=True)).reshape(counts.shape))


def _mixture(counts: np.ndarray, chances: np.ndarray, rounds: int) -> np.ndarray:
    """Shares of the languages by expectation maximisation from equal ones."""
    shares, flat = np.full(chances.shape[1], 1 / chances.shape[1]), counts / counts.sum()
    for _ in range(rounds):
        new = shares * ((flat / (chances @ shares)) @ chances)
        moved = np.abs(new - shares).max()
        shares = new
        if moved < 1e-3:
            break
    return shares


def shares_of(counts: np.ndarray, model: Languages, penalty: float = PENALTY) -> np.ndarray:
    """The language shares of one document, zero outside the chosen set.

    A few EM steps over all languages order them by share. Sets are then grown along that
    order, and one more language is taken only while it raises the log-likelihood by more than
    ``penalty`` times the logarithm of the number of n-grams.
    """
    seen = np.flatnonzero(counts)
    n = counts[seen].astype(float)
    k = len(model.names)
    out = np.zeros(k)
    alone = n @ model.logs[seen]
    best = int(np.argmax(alone))
    out[best] = 1.0
    if k == 1:
        return out
    table = model.chances[seen]
    cost = penalty * np.log(n.sum() + 1)
    order = np.argsort(-_mixture(n, table, ORDER_ROUNDS), kind="stable")
    order = [best, *[int(i) for i in order if i != best]]
    likelihood = alone[best]
    for size in range(2, k + 1):
        chosen = order[:size]
        some = table[:, chosen]
        own = _mixture(n, some, ROUNDS)
        new = n @ np.log(some @ own)
        if new - likelihood <= cost:
            break
        likelihood, out = new, np.zeros(k)
        out[chosen] = own
    return out


def identify(docs: DataFrame, model: Languages, id_col: str = "doc_id", text_col: str = "text",
             penalty: float = PENALTY) -> DataFrame:
    """Every row with its languages: (doc_id, lang_pred, score, shares), in one scan.

    ``shares`` maps the chosen languages to their shares of the text; ``lang_pred`` has the
    largest (ties: the first by name) and ``score`` is that share. Defined cases: null texts
    and texts without a letter are "und" with score 0 and no shares, and so is all if the model
    knows no language; repeated rows and null ids are rows like others.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets, whatever the rows
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                         T.StructField("shares", T.MapType(T.StringType(), T.DoubleType()))])

    @F.pandas_udf(kind)
    def found(texts: pd.Series) -> pd.DataFrame:
        m, rows = shared.value, []
        for text in texts:
            if not m.names or not has_letter(text):
                rows.append((UNKNOWN, 0.0, {}))
                continue
            s = shares_of(ngram_counts(text), m, penalty)
            top = int(np.argmax(s))
            rows.append((m.names[top], float(min(s[top], 1.0)),
                         {m.names[i]: float(s[i]) for i in np.flatnonzero(s > 0)}))
        return pd.DataFrame(rows, columns=["lang_pred", "score", "shares"])

    return docs.select(F.col(id_col).alias("doc_id"), found(F.col(text_col)).alias("found")).select(
        "doc_id", "found.*")


def op10_language_id(spark, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = learn(docs.where(fold("doc_id", 4) != 2))
    found = identify(docs, model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")
