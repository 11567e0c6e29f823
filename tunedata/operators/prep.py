"""Preparation: raw records or turn tables to training rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tunedata.constants import (
    FENCE_SYSTEM_PROMPT,
    PAIR_RATIO,
    PREP_REPORT,
    PROMPT_ROLE,
    RESPONSE_ROLE,
    SEED,
)
from tunedata.functions.chat import chat_prompt, sft_text
from tunedata.functions.corrupt import VARIANTS, variant_number
from tunedata.functions.sampling import in_sample, pick
from tunedata.functions.text import or_empty, strip
from tunedata.sources.jsonl import PLACE
from tunedata.sources.sinks import SKIPPED

Gate = Callable[[Column], Column]

SKIP_REASONS = ("malformed", "empty", "noncompliant")


def accept_all(response: Column) -> Column:
    """The default gate: every response passes."""
    return F.lit(True)


def pair_from_messages(
    records: DataFrame, prompt_role: str = PROMPT_ROLE, response_role: str = RESPONSE_ROLE
) -> DataFrame:
    """Stripped ``prompt`` and ``response`` of each record; ``conversation`` is used up.

    A conversation counts only if the record's own prompt is empty *before* stripping. Then the
    first prompt-role message is the prompt and the last response-role message the response; a
    missing response-role message leaves the record's own response.
    """
    own_prompt, own_response = or_empty("prompt"), or_empty("response")
    if "conversation" not in records.columns:
        return _settle(records, {"prompt": strip(own_prompt), "response": strip(own_response)})

    def texts_of(role: str) -> Column:
        said = F.filter("conversation", lambda message: message["role"] == role)
        return F.transform(said, lambda message: or_empty(message["content"]))

    def chosen(message: Column, own: Column) -> Column:
        return strip(F.when(own_prompt == "", F.coalesce(message, own)).otherwise(own))

    pair = {
        "prompt": chosen(F.get(texts_of(prompt_role), F.lit(0)), own_prompt),
        "response": chosen(F.try_element_at(texts_of(response_role), F.lit(-1)), own_response),
    }
    return _settle(records, pair).drop("conversation")


def _settle(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Set columns so that a later filter on them reads the values.

    Spark moves a filter below a projection and repeats the projection's expressions there; it
    does not move one below a generator, here one that yields exactly one row.
    """
    others = [F.col(f"`{c}`") for c in rows.columns if c not in columns]
    values = F.struct(*[column.alias(name) for name, column in columns.items()])
    return rows.select(*others, F.inline(F.array(values)))


def pair_from_turns(
    turns: DataFrame,
    prompt_role: str = "user",
    response_role: str = "assistant",
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """The same from a table with one row per turn: ``conversation, prompt, response``.

    Minimum and maximum of ``(turn, text)`` are partial aggregates: each task sends at most one
    row per conversation, so a conversation with a third of all turns costs its reducer one row
    per task. A conversation without a matching turn gets an empty text.
    """
    said = F.when(F.col(turn).isNotNull(), F.struct(turn, text))
    return turns.groupBy(conversation).agg(
        strip(or_empty(F.min(F.when(F.col(role) == prompt_role, said))[text])).alias("prompt"),
        strip(or_empty(F.max(F.when(F.col(role) == response_role, said))[text])).alias("response"),
    )


def with_status(pairs: DataFrame, gate: Gate = accept_all) -> DataFrame:
    """Add ``status``: kept, malformed, empty or noncompliant. Nothing is dropped.

    ``gate`` maps the response column to a boolean column, such as ``has_python_block``.
    """
    malformed = F.col("malformed") if "malformed" in pairs.columns else F.lit(False)
    empty = (or_empty("prompt") == "") | (or_empty("response") == "")
    return pairs.withColumn(
        "status",
        F.when(malformed, "malformed")
        .when(empty, "empty")
        .when(~F.coalesce(gate(F.col("response")), F.lit(False)), "noncompliant")
        .otherwise("kept"),
    ).drop("malformed")


def row_key(rows: DataFrame) -> Column:
    """A key for hash sampling: the id; where a record has none, the place of its line if the scan
    tells it, so that equal records are drawn apart; else the content itself."""
    if set(PLACE) <= set(rows.columns):
        own = F.concat_ws("\x00", *PLACE)
    else:
        own = F.sha2(F.concat_ws("\x00", or_empty("prompt"), or_empty("response")), 256)
    if "id" in rows.columns:
        return F.coalesce(F.col("id").cast("string"), own)
    return own


def training_rows(
    statused: DataFrame,
    key: Column | None = None,
    system_prompt: str = FENCE_SYSTEM_PROMPT,
    ratio: float = PAIR_RATIO,
    seed: int = SEED,
    variants: Sequence[Callable[[Column | str], Column]] = VARIANTS,
    quarantine: bool = False,
) -> DataFrame:
    """``text, prompt, chosen, rejected`` of the kept rows.

    ``rejected`` is null for rows outside the preference sample. With ``quarantine``, all other rows
    follow with a struct ``skipped`` - status, file, block, line and, of a malformed line, its text
    ``raw`` - which is null in the kept ones.
    """
    key = row_key(statused) if key is None else key
    chat, kept = F.col("_chat"), F.col("status") == "kept"
    skipped = []
    if quarantine:
        source = {"status": "status", "raw": "raw", **dict(zip(("file", "block", "line"), PLACE))}
        values = [
            (F.col(source[name]) if source[name] in statused.columns else F.lit(None)).alias(name) for name in SKIPPED
        ]
        skipped = [F.when(~kept, F.struct(*values)).alias("skipped")]
    rows = statused if quarantine else statused.filter(kept)
    return (
        rows.select("prompt", "response", key.cast("string").alias("_key"), *skipped)
        .select(
            *(["skipped"] if quarantine else []),
            "response",
            chat_prompt("prompt", system_prompt).alias("_chat"),
            in_sample("_key", ratio, seed).alias("_sampled"),
            pick("_key", len(variants), seed).alias("_number"),
        )
        .select(
            sft_text(chat, "response").alias("text"),
            chat.alias("prompt"),
            F.col("response").alias("chosen"),
            F.when(
                F.col("_sampled"), variant_number("response", F.col("_number"), variants)
            ).alias("rejected"),
            *(["skipped"] if quarantine else []),
        )
    )


def sft_rows(training: DataFrame) -> DataFrame:
    return training.select("text", "prompt", "chosen")


def preference_rows(training: DataFrame) -> DataFrame:
    return training.filter(F.col("rejected").isNotNull()).select("prompt", "chosen", "rejected")


def text_only(rows: DataFrame) -> DataFrame:
    """Narrow to ``text`` where there is such a column."""
    return rows.select("text") if "text" in rows.columns else rows


def _prep_counters(key: Column, ratio: float, seed: int) -> list[Column]:
    kept = F.col("status") == "kept"
    return [
        F.count_if(kept).alias("sft"),
        F.count_if(kept & in_sample(key, ratio, seed)).alias("dpo"),
        F.count_if(~kept).alias("skipped"),
        *[F.count_if(F.col("status") == reason).alias(reason) for reason in SKIP_REASONS],
    ]


def prep_report(
    statused: DataFrame, key: Column | None = None, ratio: float = PAIR_RATIO, seed: int = SEED
) -> DataFrame:
    """One row ``sft, dpo, skipped`` plus the count per skip reason."""
    key = row_key(statused) if key is None else key
    return statused.agg(*_prep_counters(key, ratio, seed))


def observe_prep(
    statused: DataFrame,
    observation: Observation,
    key: Column | None = None,
    ratio: float = PAIR_RATIO,
    seed: int = SEED,
) -> DataFrame:
    """The same counters as a by-product of whatever job runs over the result."""
    key = row_key(statused) if key is None else key
    return statused.observe(observation, *_prep_counters(key, ratio, seed))


def prep_report_text(report: DataFrame) -> DataFrame:
    lines = [F.concat(F.lit(label), F.col(name).cast("string")) for label, name in PREP_REPORT]
    return report.select(F.concat_ws("\n", F.lit("Dataset stats:"), *lines).alias("report"))
