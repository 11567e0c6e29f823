"""``<python>`` and ``<info>`` blocks: detection, extraction and length.

Model output can degenerate into thousands of opening tags that are never closed. A plain lazy
pattern scans to the end of the text from each of them; the patterns here take one or two passes
whatever the text. Three habits keep a pass cheap in Java: ``.`` with the ``s`` flag instead of
``[\\s\\S]``; letter case ignored in the tag's name only, so that ``<`` is compared as it is; and
``[^<]*+`` to run over plain text in one go.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunedata.constants import MAX_INFO_TOKENS, MIN_INFO_TOKENS
from tunedata.functions.text import has_tokens, or_empty


def _up_to(mark: str) -> str:
    """All text before ``mark``, a tag without its ``<``; never given back."""
    return f"(?:[^<]++|<(?!{mark}))*+"


def has_tag_pair(col: Column | str, tag: str) -> Column:
    """True if an opening tag is followed by its closing tag.

    If any opening tag is, the first one is; so the pattern goes to the first one and stays. The
    search for ``</`` settles most texts without tags at a fraction of the cost.
    """
    text = or_empty(col)
    opening, closing = f"(?iu:{tag})>", f"/(?iu:{tag})>"
    pair = rf"\A{_up_to(opening)}<{opening}{_up_to(closing)}<{closing}"
    return F.contains(text, F.lit("</")) & text.rlike(pair)


def tag_blocks(col: Column | str, tag: str) -> Column:
    """Bodies of all tag pairs, in text order.

    Text after the last closing tag cannot hold a pair and is set aside first.
    """
    text = or_empty(col)
    up_to_last_closing = F.regexp_extract(text, rf"(?s)\A.*</(?iu:{tag})>", 0)
    closed = F.when(F.contains(text, F.lit("</")), up_to_last_closing).otherwise("")
    pair = rf"(?s)<(?iu:{tag})>([^<]*+.*?)</(?iu:{tag})>"
    return F.regexp_extract_all(closed, F.lit(pair), 1)


def has_code_block(col: Column | str) -> Column:
    return has_tag_pair(col, "python")


def has_info_block(col: Column | str) -> Column:
    return has_tag_pair(col, "info")


def code_blocks(col: Column | str) -> Column:
    return tag_blocks(col, "python")


def info_blocks(col: Column | str) -> Column:
    return tag_blocks(col, "info")


def blocks_length_ok(
    blocks: Column, min_tokens: int = MIN_INFO_TOKENS, max_tokens: int = MAX_INFO_TOKENS
) -> Column:
    """Token count of all blocks together lies in the inclusive range; no block means false."""
    return (F.size(blocks) > 0) & has_tokens(F.array_join(blocks, " "), min_tokens, max_tokens)


def info_length_ok(
    col: Column | str, min_tokens: int = MIN_INFO_TOKENS, max_tokens: int = MAX_INFO_TOKENS
) -> Column:
    return blocks_length_ok(info_blocks(col), min_tokens, max_tokens)
