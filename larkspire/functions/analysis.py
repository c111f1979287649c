"""Text analysis as column expressions, with the same for query strings in Python.

A text becomes its lower-case words, each between two spaces of its own: `  a  b  `. So ` a ` occurs once for every word a,
also where words repeat, and ` a  b ` wherever b follows a.
"""

from __future__ import annotations

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

BREAKS = r"[^\p{L}\p{N}]+"
_breaks = regex.compile(BREAKS)
#: Words of more bytes than this are no words of a text: no query finds them, and they don't count in its length.
LONGEST = 40


def words_of(text: str) -> list[str]:
    """The words of a query string; one that is too long stays, to be told apart from a query without words."""
    return [w for w in _breaks.split(text.lower()) if w]


def too_long(words: list[str]) -> bool:
    return any(len(w.encode()) > LONGEST for w in words)


def padded(text: Column) -> Column:
    return F.concat(F.lit("  "), F.regexp_replace(F.lower(text), BREAKS, "  "), F.lit("  "))


def phrase_pattern(words: list[str]) -> str:
    return " " + "  ".join(words) + " "


def occurrences(pad: Column, pattern: str) -> Column:
    """How often the pattern of one word, or of a phrase, occurs in a padded text."""
    return ((F.length(pad) - F.length(F.replace(pad, F.lit(pattern), F.lit("")))) / F.lit(len(pattern))).cast("int")


def word_count(text: Column) -> Column:
    """The number of words; 0 for a null."""
    words = F.filter(F.split(F.lower(text), BREAKS), lambda w: (w != "") & (F.octet_length(w) <= LONGEST))
    return F.coalesce(F.size(words), F.lit(0))
