import numpy as np

from tests.llm.test_quality import held
from trowel.llm import language
from trowel.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
SAY = {"en": "the quick brown fox was there with all of them and thought that this is the way ",
       "de": "der schnelle braune fuchs war dort und dachte dass dies nicht der weg sein kann ",
       "xx": "zzyx qwop kjhg vbnm zzyx plok wqzx "}


def model(spark):
    docs = spark.createDataFrame([(k, v * 5) for k, v in SAY.items()] + [(None, "lost"), ("en", None)], "lang string, text string")
    return language.learn(docs)


def test_shares_of_a_mixture(spark):
    m = model(spark)
    assert m.names == ["de", "en", "xx"] and np.allclose(m.chances.sum(0), len(language.LENGTHS))
    s = language.shares_of(language.ngram_counts(SAY["en"] * 3 + SAY["de"] * 3), m)
    assert abs(s[0] - 0.5) < 0.1 and abs(s[1] - 0.5) < 0.1 and s[2] == 0
    alone = language.shares_of(language.ngram_counts(SAY["xx"]), m)
    assert alone.tolist() == [0, 0, 1]


def test_counts_in_pieces():
    whole = language.ngram_counts("ab " * 1000)
    assert whole.sum() == sum(3000 + 2 - n for n in language.LENGTHS)
    assert language.ngram_counts(None).sum() == language.ngram_counts("...").sum()
    for text in ("ab cd  ..  é日e " * 9, "é" * 40, "日" * 40, "a", "", "  a  b  ", "word" * 30):
        for piece in (1, 2, 3, 5, 64):
            assert (language.ngram_counts(text, piece) == language.ngram_counts(text, 10 ** 6)).all(), (text, piece)
    long = "日本 word é" * 250_000
    assert len(long.encode()) > 3 * language._PIECE
    assert (language.ngram_counts(long) == language.ngram_counts(long, 1 << 26)).all()


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "en", 1.0), (2, "", "en", 1.0), (3, "123 !?", "de", 1.0), (4, SAY["de"], None, 1.0), (4, SAY["de"], None, 1.0),
         (None, SAY["en"] * 20_000, "q", 1.0), (6, "é", "de", 1.0)], "doc_id bigint, text string, lang string, score double")
    out = language.identify(docs, model(spark)).collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in out}
    assert len(out) == 7 and got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4] == ("de", 1.0) and got[None][0] == "en" and got[6][0] in SAY
    assert language.identify(docs.limit(0), model(spark)).count() == 0
    nothing = language.learn(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    got = QUERIES["op10_language_id"](spark, FOLDER).collect()
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    assert len(got) == len(docs) and all(r.held_out == (held(r.doc_id, 4) == 2) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in got if r.held_out]) > 0.97
