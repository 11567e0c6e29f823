"""Prompt tables, generation requests and group-relative scores of logged rollouts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunedata.constants import (
    EVAL_SAMPLES,
    GENERATIONS,
    ROLLOUT_PROMPTS,
    ROLLOUT_USER_PROMPT,
    TAG_SYSTEM_PROMPT,
)
from tunedata.functions.chat import bare_prompt, chat_prompt
from tunedata.functions.reward import RewardFunction, with_reward, with_rewards
from tunedata.functions.text import or_empty
from tunedata.operators.limits import first_n
from tunedata.operators.lookup import SPREAD


def rollout_prompt() -> Column:
    """The constant prompt rollouts start from."""
    return chat_prompt(F.lit(ROLLOUT_USER_PROMPT), TAG_SYSTEM_PROMPT)


def prompt_table(spark: SparkSession, rows: int = ROLLOUT_PROMPTS) -> DataFrame:
    """The constant prompt, ``rows`` times."""
    return spark.range(rows).select(rollout_prompt().alias("prompt"))


def rollout_requests(prompts: DataFrame, generations: int = GENERATIONS) -> DataFrame:
    """Every prompt ``generations`` times, numbered by ``gen``; row-local."""
    if generations < 1:
        raise ValueError("generations must be at least 1")
    return prompts.select("*", F.explode(F.sequence(F.lit(0), F.lit(generations - 1))).alias("gen"))


def prompt_or_text(rows: DataFrame) -> Column:
    """The ``prompt`` column if the table has one, else ``text``, else empty texts."""
    for name in ("prompt", "text"):
        if name in rows.columns:
            return or_empty(name)
    return F.lit("")


def evaluation_requests(
    rows: DataFrame,
    order: str | Sequence[str],
    n: int = EVAL_SAMPLES,
    system_prompt: str = TAG_SYSTEM_PROMPT,
) -> DataFrame:
    """First ``n`` rows as ``order, prompt, request``: the bare prompt and its templated form.

    An order column named prompt or request gives way to the result of that name. Order by an id or
    a hash where there is one: the keys of the chosen rows pass through one task.
    """
    order = [order] if isinstance(order, str) else list(order)
    names = [f"_by{i}" for i in range(len(order))]
    keyed = rows.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(order, names, strict=True)],
        prompt_or_text(rows).alias("_raw"),
    )
    prompt = bare_prompt("_raw")
    kept = [F.col(k).alias(c) for c, k in zip(order, names, strict=True) if c not in ("prompt", "request")]
    return first_n(keyed, n, names).select(
        *kept, prompt.alias("prompt"), chat_prompt(prompt, system_prompt).alias("request")
    )


def score_rollouts(
    rollouts: DataFrame,
    ids: Sequence[str],
    response: str = "response",
    rewards: Mapping[str, float | RewardFunction | tuple[float, RewardFunction]] | None = None,
) -> DataFrame:
    """``ids`` and ``reward`` of each rollout, without the texts.

    With ``rewards``, as :func:`with_rewards` takes them, also the column of each of these.
    """
    narrow = rollouts.select(*ids, F.col(response).alias("_text"))
    if rewards is None:
        return with_reward(narrow, "_text").drop("_text")
    return with_rewards(narrow, rewards, "_text").drop("_text")


def group_relative(
    rollouts: DataFrame,
    group: str,
    member: Sequence[str],
    reward: str = "reward",
    eps: float = 1e-4,
    spread: int = SPREAD,
) -> DataFrame:
    """Add ``advantage = (reward - mean) / (stddev + eps)`` within each group.

    Sample standard deviation; a group of one or of equal rewards scores 0. ``member`` identifies
    a rollout within its group. One prompt may hold any share of the rollouts: rows are dealt out by
    (group, salt), the salt being a hash of ``member``; each (group, salt) is reduced to its moments
    where it lies, a group's moments - ``spread`` rows at most - are merged, and go back to its
    (group, salt) pairs. The dealt rows serve both sides, so the input is read and scored once.
    """
    # Hash and salt are computed above the exchange as well as in it: both uses then read the same
    # columns and Spark runs the exchange once. Keys without nulls spare another one for the join.
    name, salt = F.xxhash64(group), F.pmod(F.xxhash64(*member), F.lit(spread))
    dealt = rollouts.repartition(name, salt).withColumns({"_name": name, "_salt": salt})
    moments = dealt.groupBy("_name", group, "_salt").agg(
        F.count(reward).alias("n"),
        F.avg(reward).alias("mean"),
        (F.var_pop(reward) * F.count(reward)).alias("square"),
        F.min(reward).alias("least"),
        F.max(reward).alias("most"),
    )
    parts, zero = F.col("_parts"), F.lit(0.0)
    merged = (
        moments.groupBy(group)
        .agg(F.collect_list(F.struct("_salt", "n", "mean", "square", "least", "most")).alias("_parts"))
        .withColumn("_n", F.aggregate(parts, F.lit(0).cast("long"), lambda s, p: s + p["n"]))
        .withColumn(
            "_mean",
            F.aggregate(parts, zero, lambda s, p: s + F.coalesce(p["mean"] * p["n"], zero)) / F.nullif("_n", F.lit(0)),
        )
        .withColumn(
            "_square",
            F.aggregate(
                parts,
                zero,
                lambda s, p: s + F.coalesce(p["square"] + p["n"] * (p["mean"] - F.col("_mean")) ** 2, zero),
            ),
        )
        .select(
            F.col(group).alias("_group"),
            F.xxhash64(group).alias("_hash"),
            "_mean",
            F.sqrt(F.col("_square") / F.nullif(F.col("_n") - 1, F.lit(0))).alias("_deviation"),
            (F.array_min(parts["least"]) == F.array_max(parts["most"])).alias("_equal"),
            F.explode(parts["_salt"]).alias("_slot"),
        )
    )
    score = (F.col(reward) - F.col("_mean")) / (F.coalesce("_deviation", zero) + F.lit(eps))
    # A mean of equal numbers may miss them by a rounding error.
    score = F.when(F.col("_equal") & F.col(reward).isNotNull(), zero).otherwise(score)
    same = F.when(F.col(group).isNull(), F.col("_group").isNull()).otherwise(F.col(group) == F.col("_group"))
    placed = (F.col("_name") == F.col("_hash")) & (F.col("_salt") == F.col("_slot")) & same
    return (
        dealt.join(merged.hint("shuffle_hash"), placed, "left")
        .withColumn("advantage", score)
        .drop("_group", "_name", "_hash", "_salt", "_slot", "_mean", "_deviation", "_equal")
    )
