"""Keep the digits of JSON numbers.

Spark's JSON reader turns a number with a point or an exponent into a double before it gives it
back as text. Texts that hold one are shielded: their numbers become strings between two marks,
which ``freed`` makes numbers again. Marks that the text itself holds (as characters or as
``\\u`` escapes) are written differently meanwhile, so whatever a text holds comes back as it was.
Other texts are left alone: whole numbers of any length pass the reader exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MARK, _ESC = "\ue000", "\ue001"  # private-use characters
_OWN = ((_ESC, "e001", _ESC + "1"), (_MARK, "e000", _ESC + "0"))  # character, its escape, how it is written meanwhile
# after a colon, comma or bracket: digits with a point or exponent (also inside strings, which does no harm)
_AT_RISK = r"[:,\[]\s*-?[0-9]+[.eE]"
# a string, or a number outside of strings
_STRING_OR_NUMBER = r'("[^"\\]*+(?:\\.[^"\\]*+)*+")|(-?[0-9]+(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?)'


def at_risk(text: Column) -> Column:
    """Whether ``text`` must be shielded."""
    return F.coalesce(text.rlike(_AT_RISK), F.lit(False))


def shielded(text: Column) -> Column:
    for char, _, meanwhile in _OWN:
        text = F.replace(text, F.lit(char), F.lit(meanwhile))
    for _, escape, meanwhile in _OWN:
        text = F.regexp_replace(text, rf"(?<!\\)((?:\\\\)*)\\u(?i:{escape})", f"$1{meanwhile}")
    marked = F.regexp_replace(text, _STRING_OR_NUMBER, f"$1{_MARK}$2{_MARK}")
    return F.regexp_replace(F.replace(marked, F.lit(_MARK * 2), F.lit("")), f"{_MARK}([^{_MARK}]+){_MARK}", f'"{_MARK}$1{_MARK}"')


def freed(text: Column) -> Column:
    """A value read from shielded text, or a part of such text, with its numbers as they were sent."""
    text = F.replace(F.regexp_replace(text, f'"{_MARK}([^{_MARK}]*){_MARK}"', "$1"), F.lit(_MARK), F.lit(""))
    for char, _, meanwhile in reversed(_OWN):
        text = F.replace(text, F.lit(meanwhile), F.lit(char))
    return text
