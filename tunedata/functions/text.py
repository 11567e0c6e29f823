"""Text primitives with Python's whitespace rules, kept inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunedata.constants import WHITESPACE, WHITESPACE_CLASS


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def or_empty(col: Column | str) -> Column:
    """A missing text counts as the empty text."""
    return F.coalesce(as_column(col), F.lit(""))


def strip(col: Column | str) -> Column:
    """Remove whitespace at both ends; ``trim`` without a set would remove blanks only."""
    return F.trim(as_column(col), F.lit(WHITESPACE))


def is_blank(col: Column | str) -> Column:
    """True for whitespace only. Trims one side: that stops at the first other character."""
    return F.ltrim(or_empty(col), F.lit(WHITESPACE)) == ""


def has_tokens(col: Column | str, least: int, most: int) -> Column:
    """True if the text holds ``least`` to ``most`` whitespace-separated tokens, both inclusive.

    One pass that stops after token ``most``; nothing is cut out, so a block of many megabytes
    does not turn into an array of strings. Possessive quantifiers never go back.
    """
    space, other = WHITESPACE_CLASS, WHITESPACE_CLASS.replace("[", "[^", 1)
    text = or_empty(col)
    if most < 1:
        return is_blank(text) & F.lit(least <= 0 <= most)
    further = f"{{{max(least, 1) - 1},{most - 1}}}+"
    counted = rf"\A{space}*+{other}++(?:{space}++{other}++){further}{space}*+\z"
    found = text.rlike(counted) if least <= most else F.lit(False)
    return is_blank(text) | found if least <= 0 else found
