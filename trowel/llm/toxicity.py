"""Toxicity by weak supervision: voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trowel.llm.common import fold, read, stored
from trowel.llm.quality import labelled_sample

SAMPLE_ROWS = 12_000   # labelled rows that voters are found and the model is fitted on, at most
LEXICON = 300          # lexicon and prefix voters, at most
CANDIDATES = 3_000     # traits among which they are chosen, at most
LEAST_TEXTS = 3        # unrelated texts of label 1 a voter must have been seen in
ANNOTATORS = (0.01, 0.97)  # how often the annotators call a clean and a toxic text toxic
PREFIXES = (4, 5, 6, 7)  # letters of a stem
SHARE = 100            # one word in so many is a good share
THRESHOLD = 0.5

_WORD = re.compile(r"[^\W\d_]+")
# Fixed voters, by pattern: shouting, runs of one mark, censored words, second person before a
# capitalised run, threats of a mark count.
PATTERNS = {
    "pattern:shout": re.compile(r"(?:\b[A-Z]{3,}\b\W+){4}"),
    "pattern:marks": re.compile(r"[!?]{3,}"),
    "pattern:censored": re.compile(r"\b\w[*#@$]{2,}\w*"),
    "pattern:stretched": re.compile(r"([a-z])\1{3,}"),
}


def _stems(counts: Counter, known: set[str] | None = None) -> dict[str, list[int]]:
    """Of the prefixes (or the known ones): in how many different words, and in how many words."""
    out: dict[str, list[int]] = {}
    for word, n in counts.items():
        for k in PREFIXES:
            if len(word) > k:
                stem = word[:k]
                if known is None or stem in known:
                    held = out.get(stem)
                    if held is None:
                        out[stem] = [1, n]
                    else:
                        held[0] += 1
                        held[1] += n
    return out


def traits(text: str | None, known: set[str] | None = None, patterns: bool = True) -> set[str]:
    """What voters can look at: lower-case words; word stems that occur (~), in several
    different words (~2), and in a good share of all words (~%); patterns met. ``known``
    limits the words and stems to those."""
    counts = Counter(_WORD.findall((text or "").lower()))
    out = set(counts) if known is None else known & counts.keys()
    total = sum(counts.values())
    for stem, (different, n) in _stems(counts, known).items():
        out.add(f"{stem}~")
        if different > 1:
            out.add(f"{stem}~2")
        if n * SHARE >= total:
            out.add(f"{stem}~%")
    if patterns and text:
        out.update(name for name, p in PATTERNS.items() if p.search(text))
    return out


@F.pandas_udf(T.LongType())
def _sketch(texts: pd.Series) -> pd.Series:
    """The least hash of a text's long words: the same for most near copies, and seldom for
    other texts. Short texts count whole."""
    out = []
    for text in texts:
        long = {w for w in _WORD.findall((text or "").lower()) if len(w) >= 8}
        held = long if len(long) >= 5 else {text or ""}
        out.append(min(xxhash.xxh64_intdigest(w, 7) >> 1 for w in held))
    return pd.Series(out, dtype="int64")


def find_voters(sample: DataFrame, size: int = LEXICON, least: int = LEAST_TEXTS) -> list[str]:
    """At most ``size`` traits of (label, text) rows that speak most clearly for label 1.

    Counted by Spark; the best ``CANDIDATES`` come to the driver and are taken in turn, clearest
    first. A trait that a taken one implies or that is implied by it in most of its texts
    adds nothing, and is passed over."""

    def counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            both: dict[str, list[int]] = {}
            for label, text in zip(frame.label, frame.text):
                for t in traits(text, patterns=False):
                    both.setdefault(t, [0, 0])[label > 0.5] += 1
            if both:
                yield pd.DataFrame({"trait": list(both), "clean": [c for c, _ in both.values()],
                                    "toxic": [t for _, t in both.values()]})

    sums = sample.mapInPandas(counted, "trait string, clean bigint, toxic bigint").groupBy("trait").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    totals = sample.agg(F.sum("label"), F.count(F.lit(1))).first()
    n_toxic, n_all = totals[0] or 0.0, totals[1]
    odds = F.log(((F.col("toxic") + 0.5) / F.lit(n_toxic + 1)) / ((F.col("clean") + 0.5) / F.lit(n_all - n_toxic + 1)))
    # rarer than this among the toxic is chance: a hundredth of them, or a few
    rare = F.greatest(F.lit(float(least)), F.lit(n_toxic / 100))
    found = sums.where(F.col("toxic") >= rare).withColumn("odds", odds).where(F.col("odds") > 2).orderBy(
        (F.col("odds") * F.sqrt("toxic")).desc(), "trait").limit(CANDIDATES).toPandas()
    taken: dict[str, tuple[int, float]] = {}
    for trait, toxic, odd in zip(found["trait"], found["toxic"], found["odds"]):
        stem = trait.split("~")[0]
        wider = [f"{stem[:n]}~" for n in PREFIXES if n < len(stem)] + ([f"{stem}~"] if stem != trait else [])
        implied = any(w in taken and odd < taken[w][1] + 1 for w in wider)
        implies = trait.endswith("~") and any(
            t.startswith(stem) and n >= 0.8 * toxic for t, (n, _) in taken.items())
        if not implied and not implies:
            taken[trait] = toxic, odd
        if len(taken) == size:
            break
    return list(taken)


@dataclass
class LabelModel:
    """P(voter speaks | class) for both classes, and how much of each voter's say is its own."""

    prior: float
    rates: np.ndarray     # voters x 2
    own: np.ndarray       # 1 for a voter alone, less for voters that repeat others

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        silent = np.log1p(-self.rates)
        says = (np.log(self.rates) - silent) * self.own[:, None]
        both = votes @ says + (silent * self.own[:, None]).sum(0) + np.log([1 - self.prior, self.prior])
        return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -50, 50)))


def fit_label_model(votes: np.ndarray, texts: np.ndarray, prior: float, start: np.ndarray,
                    known: dict[int, tuple[float, float]] | None = None, rounds: int = 25) -> LabelModel:
    """Expectation maximisation over distinct rows of 0/1 votes, each cast by so many ``texts``,
    from first guesses ``start``.

    Each round estimates how often every voter speaks in either class (its accuracy). From what
    the classes leave unexplained come the correlations of all pairs of voters, estimated anew
    every fifth round: a voter's say is divided by the voters it goes along with, itself
    included. ``known`` voters have rates that are given, and speak for themselves; without one
    the classes could come to mean something else, long and short texts for example.
    """
    known, q = known or {}, start
    model = LabelModel(prior, np.full((votes.shape[1], 2), 0.5), np.ones(votes.shape[1]))
    for turn in range(rounds):
        sides = np.stack([1 - q, q], 1)
        weighted = sides * texts[:, None]
        n = weighted.sum(0)
        # weak priors: voters are quiet in clean texts
        model.rates = np.clip((votes.T @ weighted + [0.02, 0.5]) / (n + [2, 1]), 1e-5, 1 - 1e-5)
        for voter, rates in known.items():
            model.rates[voter] = rates
        if turn % 5 == 0:
            left = votes - sides @ model.rates.T
            spread = left.T @ (left * texts[:, None]) / max(texts.sum(), 1)
            deviation = np.sqrt(np.maximum(np.diag(spread), 1e-12))
            together = np.clip(spread / np.outer(deviation, deviation), 0, 1)
            model.own = 1 / np.where(together > 0.2, together, 0).sum(1).clip(1)
            model.own[list(known)] = 1.0
        model.prior = float(np.clip((n[1] + prior * 10) / (n.sum() + 10), 1e-3, 1 - 1e-3))
        new = model.posterior(votes)
        if turn > 5 and np.abs(new - q).max() < 1e-4:
            break
        q = new
    return model


def fit_linear(votes: np.ndarray, texts: np.ndarray, target: np.ndarray, rounds: int = 300,
               ridge: float = 1e-3):
    """Logistic regression on posterior labels by accelerated gradient steps: (bias, weights)."""
    share = texts / texts.sum()
    x = np.column_stack([np.ones(len(votes)), votes])
    w = np.zeros(x.shape[1])
    ahead, t = w.copy(), 1.0
    rate = 1 / (max(float(share @ np.square(x).sum(1)), 1) + ridge)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ ahead, -30, 30)))
        grad = x.T @ ((p - target) * share) + ridge * np.r_[0, ahead[1:]]
        new = ahead - rate * grad
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return float(w[0]), w[1:]


@dataclass
class ToxicityModel:
    bias: float
    weights: dict[str, float]   # by trait; "any" and "many" stand for the number of traits

    def __post_init__(self):
        self.known = {t.split("~")[0] for t in self.weights if ":" not in t}

    def score(self, text: str | None) -> float:
        found = [t for t in traits(text, self.known) if t in self.weights]
        lexical = sum(t not in PATTERNS for t in found)
        raw = self.bias + sum(self.weights[t] for t in found)
        raw += self.weights.get("any", 0.0) * (lexical > 0) + self.weights.get("many", 0.0) * (lexical > 1)
        return float(1 / (1 + np.exp(-np.clip(raw, -30, 30))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic", folds: int = 5, sample_rows: int = SAMPLE_ROWS,
        lexicon: int = LEXICON) -> ToxicityModel:
    """Voters, label model and classifier from at most ``sample_rows`` labelled rows.

    Lexicon and prefix voters are mined from the labels outside fold 0, of near copies from one;
    with the fixed patterns and the annotators, a voter that is wrong now and then, they vote on
    the sample. The label model weighs them against each other, and the classifier learns its
    posterior from the votes of all but the annotators. Without labels every score is low.
    """
    chosen = labelled_sample(docs, labels, label_col, folds, sample_rows, [text_col], id_col)
    rows = stored(chosen.select(F.col("sample_label").alias("label"), F.col(text_col).alias("text")), "labelled")
    # near copies would make the words that they share look telling
    rows = stored(rows.withColumn("sketch", _sketch("text")).groupBy("sketch", "label").agg(
        F.min_by("text", F.xxhash64("text")).alias("text")), "unrelated")
    if rows.isEmpty():
        return ToxicityModel(-5.0, {})
    voters = find_voters(rows, lexicon) + list(PATTERNS)
    known = {t: i for i, t in enumerate(voters)}
    looked = {t.split("~")[0] for t in voters}

    @F.pandas_udf(T.ArrayType(T.IntegerType()))
    def cast_votes(texts: pd.Series) -> pd.Series:
        return pd.Series([[known[x] for x in traits(t, looked) if x in known] for t in texts], dtype=object)

    cast = rows.select("label", cast_votes("text").alias("votes")).toPandas()
    all_votes = np.zeros((len(cast), len(voters) + 1), np.uint8)
    for i, own in enumerate(cast["votes"]):
        all_votes[i, np.asarray(own, int)] = 1
    all_votes[:, -1] = cast["label"] > 0.5   # the annotators
    rows, texts = np.unique(all_votes, axis=0, return_counts=True)
    rows, texts = rows.astype(float), texts.astype(float)
    votes, said = rows[:, :-1], rows[:, -1]
    lexical = votes[:, :len(voters) - len(PATTERNS)].sum(1)
    counts = np.column_stack([lexical > 0, lexical > 1]).astype(float)
    prior = float(np.clip(said @ texts / texts.sum(), 0.005, 0.995))
    start = np.clip(0.8 * said + 0.2 * (lexical > 1), 0.02, 0.98)
    model = fit_label_model(rows, texts, prior, start, {rows.shape[1] - 1: ANNOTATORS})
    bias, weights = fit_linear(np.column_stack([votes, counts]), texts, model.posterior(rows))
    return ToxicityModel(bias, {**{t: float(w) for t, w in zip(voters, weights)},
                                "any": float(weights[-2]), "many": float(weights[-1])})


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text"):
    """A column with the toxicity score of each whole text, 0 to 1; null texts are empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most LEXICON traits

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([m.score(t) for t in texts], dtype=float)

    return score(F.col(text_col))


def classify_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **options) -> DataFrame:
    """Every row as (doc_id, held_out, score), in one scan after the fit.

    Defined cases: null and empty texts score by the bias alone; repeated rows score alike; a
    null id counts as the empty text for the fold; labels that are null are left out; an empty
    table gives an empty one; other columns don't matter.
    """
    model = fit(docs, labels, id_col, text_col, **options)
    return docs.select(F.col(id_col).alias("doc_id"),
                       (fold(id_col, options.get("folds", 5)) == 0).alias("held_out"),
                       score_toxicity(docs, model, text_col).alias("score"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = THRESHOLD, **options) -> DataFrame:
    """The rows that score below ``threshold``; columns and their order stay.

    Defined cases: a null text is scored as an empty one; a score equal to the threshold goes;
    long texts are scored whole; repeated rows share their fate; an empty table gives an empty
    one; further columns stay, whatever their names.
    """
    model = fit(docs, labels, id_col, text_col, **options)
    return docs.where(score_toxicity(docs, model, text_col) < threshold)


def op7_toxicity(spark, folder: str) -> DataFrame:
    found = classify_toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
