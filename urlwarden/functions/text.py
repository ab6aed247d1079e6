"""Small column helpers for counting characters and words.

Lengths are compared in bytes wherever the counted thing is ASCII: Spark knows
the byte length of a string without scanning it.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urlwarden.functions.vocab import OTHER_DIGITS, code_point_class

ANY_DIGIT = rf"[\p{{Nd}}{code_point_class(OTHER_DIGITS)}]+"
ANY_LETTER = r"\p{L}+"
ANY_UPPERCASE = r"\p{IsUppercase}+"


def occurrences(text: Column, needle: str) -> Column:
    """Non-overlapping occurrences of an ASCII ``needle``, left to right."""
    if not needle.isascii():
        raise ValueError("byte counting needs an ASCII needle")
    gone = F.octet_length(text) - F.octet_length(F.replace(text, F.lit(needle), F.lit("")))
    return gone if len(needle) == 1 else (gone / F.lit(len(needle))).cast("int")


def removed_bytes(text: Column, pattern: str) -> Column:
    """Number of ASCII characters of ``text`` covered by ``pattern``."""
    return F.octet_length(text) - F.octet_length(F.regexp_replace(text, pattern, ""))


def removed_chars(text: Column, pattern: str) -> Column:
    """Number of characters of ``text`` covered by ``pattern``."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.length(text)


def flag(condition: Column) -> Column:
    return condition.cast("int")


def contains_any(text: Column, words: Iterable[str]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))


def words_present(text: Column, words: Iterable[str]) -> Column:
    """How many of ``words`` occur in ``text`` (each counted once)."""
    return reduce(lambda a, b: a + b, (flag(F.contains(text, F.lit(w))) for w in words))


def sealed(df: DataFrame, kept: Iterable[Column], computed: dict[str, Column]) -> DataFrame:
    """Select ``kept`` and ``computed``, the latter through a one-row generator.

    A filter or join on a computed column would otherwise be moved below all
    stages of its computation, with the stages written out in full inside the
    condition, which grows exponentially with their number. Conditions do not
    move past a generator's output.
    """
    row = F.struct(*(column.alias(name) for name, column in computed.items()))
    return df.select(*kept, F.inline_outer(F.array(row)))
