"""Chat template, prompt recovery and message lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunedata.constants import (
    ASSISTANT_START,
    FENCE_SYSTEM_PROMPT,
    INFERENCE_SYSTEM_PROMPT,
    SYSTEM_START,
    TURN_END,
    USER_START,
)
from tunedata.functions.text import as_column, strip


def chat_prompt(prompt: Column | str, system_prompt: str = FENCE_SYSTEM_PROMPT) -> Column:
    """System turn, user turn and an open assistant turn."""
    head = f"{SYSTEM_START}{system_prompt}{TURN_END}\n{USER_START}"
    return F.concat(F.lit(head), as_column(prompt), F.lit(f"{TURN_END}\n{ASSISTANT_START}"))


def sft_text(chat: Column | str, response: Column | str) -> Column:
    return F.concat(as_column(chat), as_column(response), F.lit(TURN_END))


def bare_prompt(col: Column | str) -> Column:
    """Last user turn of a templated text, stripped; other text is returned as it is."""
    text = as_column(col)
    last_user_turn = F.substring_index(F.substring_index(text, USER_START, -1), TURN_END, 1)
    return F.when(F.contains(text, F.lit(USER_START)), strip(last_user_turn)).otherwise(text)


def messages(prompt: Column | str, system_prompt: str = INFERENCE_SYSTEM_PROMPT) -> Column:
    """``[{role, content}, ...]`` with a system and a user message."""

    def message(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return F.array(message("system", F.lit(system_prompt)), message("user", as_column(prompt)))
