"""Data preparation: JSON lines in, SFT rows and preference pairs out."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from tunedata.constants import FENCE_SYSTEM_PROMPT, PAIR_RATIO, SEED
from tunedata.functions.corrupt import VARIANTS
from tunedata.operators.prep import (
    Gate,
    accept_all,
    observe_prep,
    pair_from_messages,
    training_rows,
    with_status,
)
from tunedata.sources.jsonl import read_jsonl_tolerant, read_quarantine, read_training_set
from tunedata.sources.sinks import write_training_sets


def write_prepared(
    statused: DataFrame,
    output: str,
    key: Column | None = None,
    ratio: float = PAIR_RATIO,
    seed: int = SEED,
    system_prompt: str = FENCE_SYSTEM_PROMPT,
    variants: Sequence[Callable[[Column | str], Column]] = VARIANTS,
    fmt: str = "json",
    quarantine: bool = False,
) -> dict[str, int]:
    """Write both training sets and return the counters ``sft, dpo, skipped, ...``.

    One job and no shuffle: the counters are observed while the rows pass by. With ``quarantine``
    the same job writes the rows that are left out, with their status and place.
    """
    counters = Observation("prep")
    observed = observe_prep(statused, counters, key, ratio, seed)
    training = training_rows(observed, key, system_prompt, ratio, seed, variants, quarantine)
    write_training_sets(training, output, fmt)
    return counters.get


def prepare_datasets(
    spark: SparkSession,
    input_path: str | list[str],
    output_dir: str = "data",
    dpo_rejection_ratio: float = PAIR_RATIO,
    seed: int = SEED,
    gate: Gate = accept_all,
    system_prompt: str = FENCE_SYSTEM_PROMPT,
    variants: Sequence[Callable[[Column | str], Column]] = VARIANTS,
    key: Column | None = None,
    quarantine: bool = False,
) -> dict[str, DataFrame | dict[str, int]]:
    """Prepare a JSON-lines file or folder; returns ``sft``, ``dpo`` and the counters ``stats``.

    The sample hashes ``key``, by default the id or, without one, the place of the line: copies of a
    record are drawn apart, and a run over the same files and splits draws the same rows again. With
    ``quarantine`` the rows left out are written as well and returned under that name.
    """
    records = read_jsonl_tolerant(spark, input_path, places=True, raw="raw" if quarantine else None)
    statused = with_status(pair_from_messages(records), gate)
    stats = write_prepared(
        statused, output_dir, key, dpo_rejection_ratio, seed, system_prompt, variants, quarantine=quarantine
    )
    sets: dict[str, DataFrame | dict[str, int]] = {
        "sft": read_training_set(spark, output_dir, "sft"),
        "dpo": read_training_set(spark, output_dir, "dpo"),
        "stats": stats,
    }
    return sets | ({"quarantine": read_quarantine(spark, output_dir)} if quarantine else {})
