import numpy as np

from tests.llm.test_quality import held
from trowel.llm import toxicity
from trowel.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_label_model_finds_good_voters_without_labels():
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.2
    good = [np.where(truth, rng.random(4000) < 0.7, rng.random(4000) < 0.02) for _ in range(4)]
    noise = rng.random(4000) < 0.3
    votes = np.column_stack([*good, noise, good[0], good[0]]).astype(float)
    model = toxicity.fit_label_model(votes, np.ones(4000), 0.2, np.clip(votes[:, :4].mean(1), 0.05, 0.95))
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.96
    assert model.rates[1, 1] > 0.6 and model.rates[1, 0] < 0.05
    assert abs(np.log(model.rates[4, 1] / model.rates[4, 0])) < 0.4      # the noise says little
    assert model.own[0] < 0.45 and model.own[1] > 0.8                    # three copies count once


def test_linear_classifier_follows_its_target():
    rng = np.random.default_rng(2)
    x = (rng.random((500, 5)) < 0.4).astype(float)
    target = 1 / (1 + np.exp(-(x @ [4, -3, 0, 0, 2] - 1)))
    bias, w = toxicity.fit_linear(x, np.ones(500), target, rounds=2000, ridge=1e-6)
    assert np.allclose([bias, *w], [-1, 4, -3, 0, 0, 2], atol=0.3)


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op7_toxicity"](spark, FOLDER).collect()}
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(r.held_out == (held(i) == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    test = [(labels[i], r.predicted) for i, r in got.items() if r.held_out and i in labels]
    assert np.mean([a == b for a, b in test]) > 0.95
    assert np.mean([p for a, p in test if a == 0]) < 0.02


def test_odd_rows(spark):
    bad = [(i, f"you idiot number{i} and loser of words", 1) for i in range(30)]
    good = [(100 + i, f"a calm text number{i} of words", 0) for i in range(30)]
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t, _ in bad + good + bad[:2]] + [
        (900, None, 1.0, "x"), (901, "", 1.0, "x"), (902, "calm " * 60_000 + "idiot loser", 1.0, "x"), (None, "idiot loser", 1.0, "x")],
        "doc_id bigint, text string, score double, label string")
    labels = spark.createDataFrame([(i, y) for i, _, y in bad + good] + [(1, None), (None, 1)], "doc_id bigint, toxic int")
    out = toxicity.classify_toxicity(docs, labels).collect()
    assert len(out) == docs.count()
    of = {r.doc_id: r.score for r in out}
    assert of[3] > 0.5 > of[103] and of[900] < 0.5 and of[901] < 0.5 and of[902] > 0.5 and of[None] > 0.5
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [*range(100, 130), 900, 901]
    assert toxicity.classify_toxicity(docs.limit(0), labels).count() == 0
    assert max(r.score for r in toxicity.classify_toxicity(docs, labels.limit(0)).collect()) < 0.5
