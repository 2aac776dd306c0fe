"""Small text expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Unicode counts as white space; all of them are in the basic plane.
WHITE_SPACE = "".join(c for c in map(chr, range(0x10000)) if c.isspace())


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def any_of(tests: Iterable[Column]) -> Column:
    """True when one of the tests holds; no test at all is false."""
    return reduce(or_, list(tests) or [F.lit(False)])


def contains_any(text: Column, words: Iterable[str]) -> Column:
    """Whether the text holds one of the words, in any letter case.

    Each word is a plain substring search inside generated code, which is several
    times cheaper on long texts than one regular expression with alternatives.
    """
    lowered = F.lower(text)
    return any_of(F.contains(lowered, F.lit(word)) for word in sorted({w.lower() for w in words}))


def shortened(text: Column, limit: int, kept: int) -> Column:
    """Text over ``limit`` characters, cut to ``kept`` and marked with dots."""
    return F.when(
        F.length(text) > limit, F.concat(F.substring(text, 1, kept), F.lit("..."))
    ).otherwise(text)
