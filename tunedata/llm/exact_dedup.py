"""Exact de-duplication with a heavy-hitter split. DataFrame functions only.

Digests that many rows share would pull all their rows into one task. Spark's frequent-items
aggregate, a Misra-Gries sketch with a fixed number of counters, names the candidates in one pass
with partial aggregation. Their exact sizes and keepers are then counted, and those that really
are frequent - never more than ``counters`` rows - are broadcast: their rows are decided where
they lie. All other digests go through an ordinary shuffle, whose largest group the sketch bounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunedata.llm.common import internal, materialize

COUNTERS = 4096


def duplicate_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", counters: int = COUNTERS
) -> DataFrame:
    """One row per row of ``docs``: key, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; a null text is the empty text. The row with the largest
    key stays, null keys being smallest; of rows with equal key and text exactly one stays. An empty
    table gives an empty result. Other columns are not read, so their names cannot clash.

    Only key and digest are shuffled or written, never texts.
    """
    if counters < 64 or counters & (counters - 1):
        raise ValueError("counters must be a power of two, 64 at least")
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)
    rows, _ = materialize(
        docs.select(
            F.col(key).alias("key"), digest.alias("sha"), F.monotonically_increasing_id().alias("row")
        ),
        "digests",
    )
    rank = F.struct("key", "row")  # null keys compare smallest

    # Frequent-items sketch: at most counters / 2 names come back, as one small row.
    names = rows.agg(
        F.expr(f"approx_top_k(xxhash64(sha), {counters // 4}, {counters})").alias("top")
    ).select(F.explode("top.item").alias("name"))
    # A name frequent by its short hash is verified by its full digest.
    heavy = (
        rows.join(F.broadcast(names), F.xxhash64("sha") == F.col("name"), "left_semi")
        .groupBy("sha")
        .agg(F.count(F.lit(1)).alias("size"), F.max(rank).alias("keeper"))
        .filter(F.col("size") > 1)
    )
    # Two digests under one short hash are thinkable; the limit keeps the broadcast bounded all the
    # same, and a digest beyond it takes the ordinary path.
    heavy, _ = materialize(heavy.orderBy(F.desc("size"), "sha").limit(counters), "heavy")
    decided = rows.join(F.broadcast(heavy), "sha")
    others = rows.join(F.broadcast(heavy.select("sha")), "sha", "left_anti")
    group = Window.partitionBy("sha")
    shuffled = others.select(
        "sha",
        "key",
        "row",
        F.count(F.lit(1)).over(group).alias("size"),
        F.max(rank).over(group).alias("keeper"),
    )
    return decided.select(shuffled.columns).unionByName(shuffled).select(
        F.col("key").alias(key),
        F.col("keeper.key").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("keeper.row") == F.col("row")).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns.

    ``key`` must tell rows with different texts apart; of repeated rows one stays.
    """
    sha, kept = internal(docs, "sha", "kept_key")
    keep = (
        duplicate_groups(docs, key, text)
        .filter("kept")
        .select(F.col(key).alias(kept), F.col("text_sha256").alias(sha))
    )
    marked = docs.withColumn(sha, F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    same = F.col(key).eqNullSafe(F.col(kept)) & (marked[sha] == keep[sha])
    found = marked.join(keep, same, "left_semi")
    return found.dropDuplicates([key, sha]).drop(sha)
