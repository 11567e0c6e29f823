"""Format reward of a response.

Two totals exist and differ on purpose: ``reward`` weighs the checks 2/2/1 (range 0..5) and
``reward_total`` counts them (0..3).

Two readings of "compliant" exist as well. ``literal`` asks for a weighted reward of exactly 3,
which only info plus good length *without* code reaches; ``all_checks`` asks for all three checks.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunedata.constants import (
    CODE_WEIGHT,
    INFO_WEIGHT,
    LENGTH_WEIGHT,
    LITERAL_COMPLIANT_REWARD,
    MAX_INFO_TOKENS,
    MIN_INFO_TOKENS,
    REWARD_TEXT,
)
from tunedata.functions.tags import blocks_length_ok, has_code_block, info_blocks

COMPLIANCE_MODES = ("literal", "all_checks")


def weighted(code: Column, info: Column, length: Column) -> Column:
    score = (
        code.cast("int") * CODE_WEIGHT
        + info.cast("int") * INFO_WEIGHT
        + length.cast("int") * LENGTH_WEIGHT
    )
    return score.cast("double")


def counted(code: Column, info: Column, length: Column) -> Column:
    return (code.cast("int") + info.cast("int") + length.cast("int")).cast("double")


def compliant(code: Column, info: Column, length: Column, mode: str = "literal") -> Column:
    if mode not in COMPLIANCE_MODES:
        raise ValueError(f"mode must be one of {COMPLIANCE_MODES}, not {mode!r}")
    if mode == "literal":
        return weighted(code, info, length) == LITERAL_COMPLIANT_REWARD
    return code & info & length


def _checks(
    response: Column | str, min_tokens: int = MIN_INFO_TOKENS, max_tokens: int = MAX_INFO_TOKENS
) -> tuple[Column, Column, Column]:
    blocks = info_blocks(response)
    return (
        has_code_block(response),
        F.size(blocks) > 0,
        blocks_length_ok(blocks, min_tokens, max_tokens),
    )


def compute_reward(response: Column | str) -> Column:
    return weighted(*_checks(response))


def explain_reward(response: Column | str) -> Column:
    """``struct(has_code, has_info, info_len, total)`` with the unweighted total."""
    code, info, length = _checks(response)
    return F.struct(
        code.alias("has_code"),
        info.alias("has_info"),
        length.alias("info_len"),
        counted(code, info, length).alias("total"),
    )


def breakdown_text(breakdown: Column | str) -> Column:
    """The struct of :func:`explain_reward` as text; null where the struct is null."""
    parts = F.col(breakdown) if isinstance(breakdown, str) else breakdown

    def shown(name: str) -> Column:
        if name == "total":
            return F.call_function("format_number", parts[name], F.lit("0.0"))
        return F.when(parts[name], "True").otherwise("False")

    names = iter(("has_code", "has_info", "info_len", "total"))
    pieces = [F.lit(piece) for piece in REWARD_TEXT.split("{}")]
    whole = [pieces[0], *(x for piece in pieces[1:] for x in (shown(next(names)), piece))]
    return F.when(parts.isNotNull(), F.concat(*whole))


def is_compliant(response: Column | str, mode: str = "literal") -> Column:
    return compliant(*_checks(response), mode)


def with_breakdown(
    rows: DataFrame, response: str = "response", mode: str = "literal"
) -> DataFrame:
    """Add ``has_code, has_info, info_len, reward_total, reward, compliant``.

    The info blocks are extracted once, in a projection of their own; Catalyst does not merge it
    with the next one because that would repeat the regular expression.
    """
    checks = F.col("has_code"), F.col("has_info"), F.col("info_len")
    return (
        rows.withColumns({"_info": info_blocks(response), "has_code": has_code_block(response)})
        .withColumns({"has_info": F.size("_info") > 0, "info_len": blocks_length_ok(F.col("_info"))})
        .drop("_info")
        .withColumns(
            {
                "reward_total": counted(*checks),
                "reward": weighted(*checks),
                "compliant": compliant(*checks, mode),
            }
        )
    )


def with_reward(rows: DataFrame, response: str = "response", into: str = "reward") -> DataFrame:
    """Add the weighted reward; every other column passes through."""
    info = F.col("_info")
    reward = weighted(has_code_block(response), F.size(info) > 0, blocks_length_ok(info))
    return rows.withColumn("_info", info_blocks(response)).withColumn(into, reward).drop("_info")


class Checks(NamedTuple):
    """What registered rewards see of a response: columns that are computed once for all of them."""

    response: Column
    code: Column
    info: Column
    length: Column
    info_blocks: Column


RewardFunction = Callable[[Checks], Column]

_REWARDS: dict[str, RewardFunction] = {}


def reward_function(name: str) -> Callable[[RewardFunction], RewardFunction]:
    """Register a reward under ``name``: a function from :class:`Checks` to a numeric column."""

    def register(function: RewardFunction) -> RewardFunction:
        if _REWARDS.setdefault(name, function) is not function:
            raise ValueError(f"there is a reward {name!r} already")
        return function

    return register


def reward_names() -> list[str]:
    return sorted(_REWARDS)


@reward_function("format")
def _format(checks: Checks) -> Column:
    return weighted(checks.code, checks.info, checks.length)


@reward_function("checks")
def _count(checks: Checks) -> Column:
    return counted(checks.code, checks.info, checks.length)


@reward_function("compliant")
def _compliant(checks: Checks) -> Column:
    return compliant(checks.code, checks.info, checks.length).cast("double")


@reward_function("all_checks")
def _all_checks(checks: Checks) -> Column:
    return compliant(checks.code, checks.info, checks.length, "all_checks").cast("double")


def with_rewards(
    rows: DataFrame,
    rewards: Mapping[str, float | RewardFunction | tuple[float, RewardFunction]],
    response: str = "response",
    into: str = "reward",
) -> DataFrame:
    """Add one column ``<into>_<name>`` per reward, and ``into``, their weighted sum.

    ``rewards`` maps the name of a registered reward to its weight; a function of one's own stands for
    weight 1, or with its weight in a pair. A reward that is null for a row adds nothing to its sum.
    However many rewards there are, each marker is searched for once per response.
    """
    chosen: dict[str, tuple[float, RewardFunction]] = {}
    for name, given in rewards.items():
        if callable(given):
            chosen[name] = 1.0, given
        elif isinstance(given, tuple):
            chosen[name] = float(given[0]), given[1]
        elif name in _REWARDS:
            chosen[name] = float(given), _REWARDS[name]
        else:
            raise ValueError(f"no reward {name!r}; there are {', '.join(reward_names())}")
    if not chosen:
        raise ValueError("with_rewards needs a reward")
    marked = rows.withColumns({"_info": info_blocks(response), "_code": has_code_block(response)})
    # The lengths in a projection of their own: Spark does not merge it with one that uses them often.
    checked = marked.withColumns({"_some": F.size("_info") > 0, "_length": blocks_length_ok(F.col("_info"))})
    checks = Checks(F.col(response), F.col("_code"), F.col("_some"), F.col("_length"), F.col("_info"))
    scored = checked.withColumns(
        {f"{into}_{name}": function(checks).cast("double") for name, (_, function) in chosen.items()}
    )
    parts = [F.coalesce(F.col(f"{into}_{name}") * F.lit(weight), F.lit(0.0)) for name, (weight, _) in chosen.items()]
    return scored.withColumn(into, reduce(Column.__add__, parts)).drop("_info", "_code", "_some", "_length")
