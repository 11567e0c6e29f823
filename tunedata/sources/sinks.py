"""Sinks. Each writes a folder of part files, one per task."""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tunedata.sources.files import read_small_file, remove, write_small_file

MANIFEST = "_manifest.json"
SKIPPED = ("status", "file", "block", "line", "raw")


def write_rows(rows: DataFrame, path: str, fmt: str = "json") -> None:
    """Write as JSON lines, or as Parquet where another Spark stage reads the result."""
    rows.write.mode("overwrite").format(fmt).save(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write an evaluation record as JSON. Missing parent folders are created."""
    metrics.write.mode("overwrite").json(path)


def read_manifest(spark: SparkSession, folder: str) -> dict[str, Any] | None:
    """The manifest of training sets below ``folder``, if there is one."""
    text = read_small_file(spark, f"{folder.rstrip('/')}/{MANIFEST}")
    return None if text is None else json.loads(text)


def write_training_sets(training: DataFrame, path: str, fmt: str = "json") -> dict[str, Any]:
    """Write ``kind=sft`` and ``kind=dpo`` below ``path`` in one pass over the input, then a manifest.

    Two separate writes would decode and template the input twice. Each row fans out into its
    SFT row and, if it was sampled, its preference row; there is no shuffle. Rows with a ``skipped``
    struct (``status, file, block, line, raw``) become rows of ``kind=quarantine`` instead.

    The manifest holds path and row count of every set and is written last; it is removed before
    anything else is, so that no reader takes a half-written output for a whole one.
    """
    spark = training.sparkSession
    remove(spark, f"{path.rstrip('/')}/{MANIFEST}")
    has_skipped = "skipped" in training.columns
    kept = F.col("skipped").isNull() if has_skipped else F.lit(True)
    sampled = kept & F.col("rejected").isNotNull()
    counts = Observation()
    counted = training.observe(
        counts,
        F.count_if(kept).alias("sft"),
        F.count_if(sampled).alias("dpo"),
        F.count_if(~kept).alias("quarantine"),
    )
    fields = ["text", "prompt", "chosen", "rejected", *(SKIPPED if has_skipped else ())]

    def row(kind: str, *own: str) -> Column:
        kinds = {name: "bigint" if name in ("block", "line") else "string" for name in fields}
        source = {name: F.col("skipped")[name] if name in SKIPPED else F.col(name) for name in own}
        return F.struct(
            F.lit(kind).alias("kind"), *(source.get(f, F.lit(None)).cast(kinds[f]).alias(f) for f in fields)
        )

    sft, dpo = row("sft", "text", "prompt", "chosen"), row("dpo", "prompt", "chosen", "rejected")
    both = F.when(sampled, F.array(sft, dpo)).otherwise(F.array(sft))
    if has_skipped:
        both = F.when(~kept, F.array(row("quarantine", *SKIPPED))).otherwise(both)
    written = counted.select(F.explode(both).alias("row")).select("row.*").write.mode("overwrite")
    written.partitionBy("kind").format(fmt).save(path)
    sets = {kind: {"path": f"kind={kind}", "rows": rows} for kind, rows in counts.get.items()}
    manifest = {"format": fmt, "sets": sets}
    write_small_file(spark, f"{path.rstrip('/')}/{MANIFEST}", json.dumps(manifest, indent=1))
    return manifest
