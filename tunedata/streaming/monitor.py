"""Reward monitor: windowed reward means over a stream of rollouts."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from tunedata.functions.reward import with_breakdown
from tunedata.sources.files import file_exists, numbered_folders, remove, write_small_file

LATE = "_late"

MEANS = (
    "n", "avg_reward", "avg_reward_total", "avg_code_score", "avg_info_score", "avg_len_score",
    "format_compliance",
)


def reward_windows(
    rollouts: DataFrame,
    response: str = "response",
    time: str = "event_time",
    window: str = "5 minutes",
    delay: str = "10 minutes",
    keys: Sequence[str] = (),
    mode: str = "literal",
) -> DataFrame:
    """Reward means per tumbling window (and ``keys``); for streams and for batch tables.

    Only the checks and the time reach the aggregation, so the state holds a few counters per
    open window and no texts. A window closes when the latest event time is ``delay`` past its
    end; rows that come later still are dropped. Batch tables have no late rows.
    """
    narrow = rollouts.select(
        *keys, F.col(time).cast("timestamp").alias("_time"), F.col(response).alias("_text")
    )
    scored = with_breakdown(narrow, "_text", mode).drop("_text")
    grouped = scored.withWatermark("_time", delay).groupBy(F.window("_time", window), *keys)
    sums = grouped.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("reward").alias("avg_reward"),
        F.avg("reward_total").alias("avg_reward_total"),
        F.avg(F.col("has_code").cast("int")).alias("avg_code_score"),
        F.avg(F.col("has_info").cast("int")).alias("avg_info_score"),
        F.avg(F.col("info_len").cast("int")).alias("avg_len_score"),
        F.avg(F.col("compliant").cast("int")).alias("format_compliance"),
    )
    return sums.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[c for c in sums.columns if c != "window"],
    )


class RewardMonitor:
    """A running monitor: a streaming query that keeps its late rows with the batch that dropped them.

    All else is the query's own (``status``, ``lastProgress``, ``isActive``, ...).
    """

    def __init__(self, spark: SparkSession, output: str):
        self._spark = spark
        self._output = output
        self._kept: set[int] = set()
        self.query: StreamingQuery | None = None

    def __getattr__(self, name: str) -> Any:
        return getattr(self.query, name)

    def keep_late_rows(self) -> None:
        """Write the counts of finished batches that have none yet, each to a file of its own."""
        for progress in list(self.query.recentProgress) if self.query is not None else []:
            batch = progress["batchId"]
            dropped = sum(state["numRowsDroppedByWatermark"] for state in progress["stateOperators"])
            # A batch without new rows may report once more; only a first report or a count is written.
            if batch not in self._kept or dropped:
                path = f"{self._output}/{LATE}/batch={batch}.json"
                write_small_file(self._spark, path, json.dumps({"batch": batch, "late": dropped}))
                self._kept.add(batch)

    def awaitTermination(self, timeout: int | None = None) -> bool | None:
        ended = self.query.awaitTermination(timeout)
        self.keep_late_rows()
        return ended

    def stop(self) -> None:
        self.query.stop()
        self.keep_late_rows()


def start_reward_monitor(
    windows: DataFrame, output: str, checkpoint: str, every: str | None = "1 minute"
) -> RewardMonitor:
    """Write the windows of a stream to a Parquet table; read it by :func:`read_reward_windows`.

    Every batch writes the windows that it changed to a folder of its own, over again if it is
    repeated. With a period the monitor goes on; ``every=None`` handles what is there and stops. Both
    kinds of run may follow each other on one ``output`` and ``checkpoint``, which must be on storage
    that all executors share; a restart goes on where the last run was. Rows later than the delay are
    dropped, and their number is kept with the batch: :func:`late_rows`. Only a crash between the end
    of a batch and the start of the next can lose the number of that one batch.
    """
    output = output.rstrip("/")
    monitor = RewardMonitor(windows.sparkSession, output)

    def write(changed: DataFrame, number: int) -> None:
        monitor.keep_late_rows()
        changed.write.mode("overwrite").parquet(f"{output}/batch={number}")

    stream = windows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).outputMode("update")
    timed = stream.trigger(availableNow=True) if every is None else stream.trigger(processingTime=every)
    monitor.query = timed.start()
    return monitor


def _parts(spark: SparkSession, output: str) -> tuple[int, list[tuple[int, str]]]:
    """The newest whole ``base`` (-1 without one), and the folders to read: base and later batches."""
    bases = [b for b, path in numbered_folders(spark, output, "base") if file_exists(spark, f"{path}/_SUCCESS")]
    base = max(bases, default=-1)
    later = [part for part in numbered_folders(spark, output, "batch") if part[0] > base]
    return base, ([(base, f"{output}/base={base}")] if base >= 0 else []) + sorted(later)


def read_reward_windows(spark: SparkSession, output: str, schema: StructType) -> DataFrame:
    """The windows below ``output``, each as its latest batch left it."""
    output = output.rstrip("/")
    _, parts = _parts(spark, output)
    if not parts:
        return spark.createDataFrame([], schema)
    number = F.regexp_extract(F.col("_metadata.file_path"), r"/(?:batch|base)=(\d+)/[^/]*$", 1).cast("long")
    rows = spark.read.schema(schema).parquet(*(path for _, path in parts)).select("*", number.alias("_batch"))
    names = [name for name in schema.names if name not in MEANS]
    latest = rows.groupBy(*names).agg(F.max("_batch").alias("_latest"))
    latest = latest.select(*[F.col(name).alias(f"_{name}") for name in names], "_latest")
    same = F.col("_batch") == F.col("_latest")
    for name in names:
        same &= F.col(name).eqNullSafe(F.col(f"_{name}"))
    return rows.join(latest, same).select(schema.names)


def compact_reward_windows(spark: SparkSession, output: str, schema: StructType) -> int:
    """Gather all batches written so far in one table, ``base=N`` for the last of them; returns N.

    Readers take the newest base that was written to the end and the batches after it. The batches
    gathered and older bases are removed afterwards, so a failure at any point loses nothing. Run it
    when the monitor is not repeating a batch, that is after a clean stop or between two batches.
    """
    output = output.rstrip("/")
    base, parts = _parts(spark, output)
    last = parts[-1][0] if parts else -1
    if last > base:
        read_reward_windows(spark, output, schema).write.mode("overwrite").parquet(f"{output}/base={last}")
        for kind in ("batch", "base"):
            for number, path in numbered_folders(spark, output, kind):
                if number < last or (kind == "batch" and number == last):
                    remove(spark, path)
    return last


def late_rows(spark: SparkSession, output: str) -> int:
    """Rows that all batches of all runs on ``output`` dropped as too late."""
    folder = f"{output.rstrip('/')}/{LATE}"
    if not file_exists(spark, folder):
        return 0
    return spark.read.schema("batch long, late long").json(f"{folder}/*.json").agg(F.sum("late")).first()[0] or 0
