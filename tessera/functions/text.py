"""String column expressions.

Regex classes are ASCII (Java's default), so accented letters act as
separators, as in the reference's Python 2 regexes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Python's str.strip() whitespace set for ASCII text.
WHITESPACE = " \t\n\r\x0b\x0c"

# Stop words removed before TF-IDF (a common English list).
STOP_WORDS = (
    "a about above after again against all am an and any are as at be because been before being "
    "below between both but by can did do does doing don down during each few for from further had "
    "has have having he her here hers herself him himself his how i if in into is it its itself just "
    "me more most my myself no nor not now of off on once only or other our ours ourselves out over "
    "own s same she should so some such t than that the their theirs them themselves then there these "
    "they this those through to too under until up very was we were what when where which while who "
    "whom why will with you your yours yourself yourselves"
).split()


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def remove_punctuation(c: str | Column) -> Column:
    """Keep ASCII letters, digits and whitespace; strip; lower."""
    kept = F.regexp_replace(_c(c), r"[^A-Za-z\s\d]", "")
    return F.lower(F.btrim(kept, F.lit(WHITESPACE)))


def simple_tokens(c: str | Column) -> Column:
    """Split on runs of non-word characters, lower-cased, no empty tokens."""
    spaced = F.lower(F.regexp_replace(_c(c), r"\W+", " "))
    return F.filter(F.split(spaced, r"\W+"), lambda t: t != "")


def tokens_without(c: str | Column, stop_words: list[str] | None = None) -> Column:
    """X7 minus stop words; order and repeats kept.

    ``isin`` over literals becomes a hash-set lookup (InSet) per token.
    """
    return drop_stop_words(simple_tokens(c), stop_words)


def drop_stop_words(tokens: str | Column, stop_words: list[str] | None = None) -> Column:
    """F10 on an existing token array (order and repeats kept)."""
    stops = STOP_WORDS if stop_words is None else stop_words
    return F.filter(_c(tokens), lambda t: ~t.isin(stops))


def plural(c: str | Column) -> Column:
    """Word + 's'."""
    return F.concat(_c(c), F.lit("s"))


def strip_newlines(c: str | Column) -> Column:
    """X18."""
    return F.replace(_c(c), F.lit("\n"), F.lit(""))


def words_of_line(c: str | Column) -> Column:
    """A line split on single spaces (empty strings kept, as str.split(' '))."""
    return F.split(_c(c), " ")
