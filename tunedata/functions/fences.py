"""Fenced blocks: detection, extraction and HTML validity."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunedata.constants import FENCE, WHITESPACE_CLASS
from tunedata.functions.text import as_column, or_empty

# Stops at the first "<letter" for good (atomic group), so a text of unclosed tags costs one pass.
_OPENING_TAG = r"(?s)\A(?>[^<]*+.*?<[a-zA-Z])[^>]*>"


def _fence_pattern(language: str) -> str:
    return rf"(?s){FENCE}(?iu:{language}){WHITESPACE_CLASS}([^`]*+.*?)```"


def has_fence(col: Column | str, language: str) -> Column:
    """True if the text holds a closed fence of this language, in any letter case.

    The plain search for a fence mark comes first: it is several times cheaper and settles most
    texts that have none.
    """
    text = or_empty(col)
    return F.contains(text, F.lit(FENCE)) & text.rlike(_fence_pattern(language))


def fence_blocks(col: Column | str, language: str) -> Column:
    """Bodies of all closed fences of this language, in text order."""
    return F.regexp_extract_all(or_empty(col), F.lit(_fence_pattern(language)), 1)


def has_python_block(col: Column | str) -> Column:
    return has_fence(col, "python")


def has_html_block(col: Column | str) -> Column:
    return has_fence(col, "html")


def python_blocks(col: Column | str) -> Column:
    return fence_blocks(col, "python")


def html_blocks(col: Column | str) -> Column:
    return fence_blocks(col, "html")


def has_opening_tag(col: Column | str) -> Column:
    """True if the text holds something like ``<p>`` or ``<a href=...>``."""
    return as_column(col).rlike(_OPENING_TAG)


def is_valid_html(col: Column | str) -> Column:
    """At least one html fence, and an opening tag in every one of them."""
    # The minimum of booleans is their conjunction, and null for no block. Unlike a test of the
    # size next to ``forall`` it names the blocks once, so they are extracted once.
    return F.coalesce(F.array_min(F.transform(html_blocks(col), has_opening_tag)), F.lit(False))
