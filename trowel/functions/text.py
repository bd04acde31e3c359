"""Cleaning of rich-text notes, as one expression per variant."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accent escapes and their letters.
ACCENTS = [
    (r"\'e4", "ä"), (r"\'f6", "ö"), (r"\'e5", "å"),
    (r"\'c5", "Å"), (r"\'c4", "Ä"), (r"\'d6", "Ö"),
]

# Marks deleted from converted notes, in this order.
MARKS = [
    "}", " }", r"\cf0", r"\pard", r"\par", r"\fs17", r"\f0", r"\f2", r"\plain", "0\\",
    r"\cf2", r"\bf1", r"\fs2tab", r"\cf1", r"\fs16", r"\fs22", r"\nowidctlpar", r"\sb109",
    r"\tx616", r"\tx2255", r"\tqr", r"\tx4185", r"\tx6462", r"\fs2tab", r"\f1", r"\cf3",
    r"\fs16", r"\b", r"\b0", r"\fs20 ", r"\sb137", r"\sb139", r"\sb124", r"\tx227tqr",
    r"\tab", r" \tx617", r"\tx1589", r"\sb94", r"\tx6477", r" \super", r"\nosupersub",
    r"\endash", r"\ul", r"\fs18",
]

# Patterns of which the first match is deleted, in this order.
MARKUP_PATTERNS = [
    r"/\w+\\\w+", r"\n[ ]*\}", r"\\\w{2}\d+", r"\\\w+",
    r"\\\w{2}\d+", r"[\n ]{2,}", r"[\n]{2,}", r" /\w\\\w",
]


def delete_all(text: Column, marks: list[str]) -> Column:
    return reduce(lambda s, m: F.replace(s, F.lit(m), F.lit("")), marks, text)


def delete_first(text: Column, pattern: str) -> Column:
    """Delete the first match only; `.` spans lines and \\w knows all letters."""
    return F.regexp_replace(text, rf"(?sU)\A(.*?)(?:{pattern})", "$1")


def accents(text: Column, escapes=ACCENTS) -> Column:
    return reduce(lambda s, e: F.replace(s, F.lit(e[0]), F.lit(e[1])), escapes, text)


def after(text: Column, pattern: str) -> Column:
    """What follows the first match, NULL without a match."""
    whole = rf"(?s){pattern}(.*)"
    return F.when(text.rlike(whole), F.regexp_extract(text, whole, 1))


def clean_text(text: Column) -> Column:
    """The note behind its first font-size mark, without markup."""
    body = delete_all(accents(after(text, r"\\fs1\d")), MARKS)
    body = F.regexp_replace(body, r"(?U)\s+\z", "")
    body = F.regexp_replace(body, r"\A ", "")
    return delete_first(body, r"\s+d ")


def clean_text_csv(text: Column) -> Column:
    """The variant of the per-feature export."""
    body = delete_all(accents(after(text, r"\\fs17 ")), [r"\par"])
    return reduce(delete_first, MARKUP_PATTERNS, body)


def clean_text_span(text: Column, attribute_id: Column, start: str = r"\w{2}\d{2} \w",
                    late: str = r"\{\n\{", early: str = r"\\cf0",
                    late_from: int = 100000) -> Column:
    """Cut between a start mark and an end mark that depends on the id, then clean."""

    def place(pattern):
        found = F.regexp_extract(text, rf"(?U)({pattern})", 1)
        return F.when(found != "", F.position(found, text))

    begin = place(start) + 5
    end = F.when(attribute_id > late_from, place(late)).otherwise(place(early))
    body = accents(text, ACCENTS[:3])
    body = F.substring(body, begin, end - begin)
    body = delete_all(body, [r"\par"])
    return reduce(delete_first, MARKUP_PATTERNS, body)
