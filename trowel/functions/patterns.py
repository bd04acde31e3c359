"""Patterns that find one feature type in free-form values, misspellings included.

``(?iu)`` ignores case for all letters.  A value does not count after ``fyllning`` and a run of
blanks, bars and i's of any length.  Java's look-behind needs a bound, so `marked` first puts
a mark behind each such run, and the patterns look back for the mark alone.  The mark is NUL,
which no text of the source databases can hold.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

MARK = "\x00"


def marked(value: Column) -> Column:
    """The value with a mark behind each filling and its run; what the patterns are made for."""
    return F.regexp_replace(value, r"(?iu)(fyllning[ |i]+)", f"$1{MARK}")



# Fixed values.
POSTHOLE_COUNT = (
    r"(?iu)(?<!\x00)(vägg|dubbel)?[st]+.?.?s?[to]+.?.?t?[ol]+.?.?o?[lp]+"
    r".?.?l?[ph]+.?.?p?[hå]+.?.?h?[ål]+.?.?å?l+l?\??(?!s?fyllning+)"
)
POSTHOLE_STATUS = (
    r"(?iu)(?<!\x00)(vägg|dubbel)?[st]+.?.?s?[to]+.?.?t?[ol]+.?.?o?[lp]+"
    r".?.?l?[ph]+.?.?p?[hå]+.?.?h?[ål]+.?.?å?l+.?.?l?\??(?!s?fyll+)"
)
POSTHOLE_PROTOTYPES = {
    "plain": r"(?iu)Stolph+p?ål\??(?!s?fyll+)",
    "compound": r"(?iu)(?<!\x00)(vägg|dubbel)?stolph+p?ål\??(?!s?fyll+)",
    "loose": r"(?iu)[st]+.?s?[to]+.?t?[ol]+.?o?[lp]+.?l?[ph]+.?p?[hå]+.?h?[ål]+.?å?l+.?l?",
}
POSTHOLE_LABEL = "0. all postholes"
STATUS_USED = "1. value used to define posthole features"
STATUS_UNUSED = "0. value not used"
POSTHOLE_WORD = "STOLPHÅL"
