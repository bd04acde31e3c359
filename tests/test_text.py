import pytest
from pyspark.sql import functions as F

from trowel.functions import patterns as P
from trowel.functions import text as X


def clean(spark, text, fn=X.clean_text):
    return spark.createDataFrame([(text,)], "t string").select(
        fn(F.col("t")).alias("o")).first().o


@pytest.mark.parametrize("text, want", [
    (r"{\rtf1\fs17 Gr\'e5 \'c4rende\par}", "Grå Ärende"),
    (r"\fs178 x", "8 x"),  # the first digit ends the mark
    (r"\fs17 a\b0 z", "a0 z"),  # the shorter mark goes first, its digit stays
    (r"\fs17 a\pard b\par c", "a b c"),
    ("\\fs17 line one\nline two  \n", "line one\nline two"),
    (r"\fs17", ""),
    ("no mark at all", None),
    (None, None),
    (r"\fs17 one d two d three", "onetwo d three"),  # only the first goes
    (r"\fs17 a0\ b", "a b"),
])
def test_clean_text(spark, text, want):
    assert clean(spark, text) == want


@pytest.mark.parametrize("text, want", [
    (r"{\fs17 Gr\'f6n \par yta\cf0", "Grön  yta".replace("  ", "")),
    (r"\fs16 other size", None),
    ("\\fs17 text\n  }", "text"),
    (r"\fs17 a\åb c", "a c"),  # letters beyond ASCII belong to a word
])
def test_clean_text_csv(spark, text, want):
    assert clean(spark, text, X.clean_text_csv) == want


def test_every_mark_is_deleted_in_order(spark):
    for mark in X.MARKS:
        text = "x" + mark + "y"
        left = text
        for m in X.MARKS:
            left = left.replace(m, "")
        assert clean(spark, r"\fs19" + text) == left.rstrip()


def test_clean_text_span(spark):
    rows = [(200000, "xx\\fs17 abc{\n{tail"), (5, "xx\\fs17 abc\\cf0 tail"), (5, "nothing")]
    got = spark.createDataFrame(rows, "id int, t string").select(
        X.clean_text_span(F.col("t"), F.col("id")).alias("o")).collect()
    assert [r.o for r in got] == ["abc", "abc", None]


@pytest.mark.parametrize("value, count, status", [
    ("Stolphål", True, True), ("STOLPHÅL?", True, True), ("dubbelstolphål", True, True),
    ("fyllning stolphål", False, False), ("fyllning i stolphål", False, False),
    ("grop", False, False), ("stolphålfyllning", True, True),
    ("stolphålsfyllning", False, True),
    *[(f"fyllning{' ' * n}stolphål", False, False) for n in (1, 40, 41, 500)],
    ("fyllningstolphål", True, True), ("Fyllning |iI stolphål, stolphål", True, True),
])
def test_feature_patterns(spark, value, count, status):
    got = spark.createDataFrame([(value,)], "v string").select(
        P.marked(F.col("v")).rlike(P.POSTHOLE_COUNT), P.marked(F.col("v")).rlike(P.POSTHOLE_STATUS)).first()
    assert tuple(got) == (count, status)
