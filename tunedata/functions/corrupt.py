"""Rejected variants: rule-based damage to a well-formed response."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunedata.constants import (
    FENCE,
    HTML_FENCE,
    PYTHON_FENCE,
    SEED,
    WRONG_HTML_FENCE,
    WRONG_PYTHON_FENCE,
)
from tunedata.functions.sampling import pick
from tunedata.functions.text import as_column, strip


def _replace(col: Column, old: str, new: str = "") -> Column:
    return F.replace(col, F.lit(old), F.lit(new))


def strip_fences(col: Column | str) -> Column:
    """Plain text: no fence marks left."""
    plain = strip(col)
    for mark in (PYTHON_FENCE, HTML_FENCE, FENCE):
        plain = _replace(plain, mark)
    return plain


def python_fence_to_js(col: Column | str) -> Column:
    return _replace(as_column(col), PYTHON_FENCE, WRONG_PYTHON_FENCE)


def html_fence_to_xml(col: Column | str) -> Column:
    return _replace(as_column(col), HTML_FENCE, WRONG_HTML_FENCE)


def drop_first_closing_fence(col: Column | str) -> Column:
    """Remove the first fence mark that ends a line, unless python/html follows on the next one."""
    return F.regexp_replace(as_column(col), rf"(?s)\A(.*?){FENCE}\n(?!python|html)", "$1\n")


VARIANTS: tuple[Callable[[Column | str], Column], ...] = (
    strip_fences,
    python_fence_to_js,
    html_fence_to_xml,
    drop_first_closing_fence,
)


def variant_number(
    response: Column | str,
    number: Column,
    variants: Sequence[Callable[[Column | str], Column]] = VARIANTS,
) -> Column:
    """The variant with this number. Only the chosen branch of the CASE is evaluated."""
    chosen = F.when(number == 0, variants[0](response))
    for position, variant in enumerate(variants[1:], start=1):
        chosen = chosen.when(number == position, variant(response))
    return chosen


def rejected_variant(
    response: Column | str,
    key: Column | str,
    seed: int = SEED,
    variants: Sequence[Callable[[Column | str], Column]] = VARIANTS,
) -> Column:
    """One variant per row, chosen by key."""
    return variant_number(response, pick(key, len(variants), seed), variants)
