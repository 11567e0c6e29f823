"""Mixing sources to target weights by weighted fair queueing.

Each source serves its documents in a shuffled order, over again up to ``repeats`` times. A copy's
virtual finish time is the source's cumulative words up to its end, divided by the source's weight;
the mix is all copies in the order of their finish times, truncated where the next one would
overspend the total budget, which is the sum of all sizes. Times are integers (the cumulative words
times the least common multiple of the weights over the weight), so that no rounding decides; of
copies that finish together the source that comes first goes first.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunedata.llm.common import WORD, discard, internal, materialize

WEIGHTS = (5, 2, 1)
REPEATS = 3
BUCKETS = 4096
SLICES = 4096


def word_count(text: str = "text"):
    """Words of a text, separated by ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("bigint")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS
) -> DataFrame:
    """Per source (null is one): source, source_size, turn, weight, target.

    ``sizes`` has source and size. Sources by code point, null last, take ``weights`` in turn and
    share the sum of all sizes. A target stops at ``repeats`` times its source's size and the excess
    goes to the others by weight: target = min(repeats * size, weight * level), where level is the
    largest of (budget - capped sizes) / weight left over all splits of the sources, in the order in
    which they reach their caps, into capped and free.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("turn", turn.cast("bigint")).withColumn("weight", weight.cast("bigint"))
    cap = F.col("source_size") * repeats
    full = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    after = full.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    capped = F.coalesce(F.sum(cap).over(before), F.lit(0))
    split = (F.sum("source_size").over(everything) - capped) / F.sum("weight").over(after)
    leveled = ranked.withColumn("_split", split).withColumn("_level", F.max("_split").over(everything))
    target = F.least(cap.cast("double"), F.col("weight") * F.col("_level"))
    return leveled.select("source", "source_size", "turn", "weight", target.alias("target"))


def _place(key: Column, text: Column, seed: str) -> Column:
    """Where a row stands in its source's shuffled order; rows without a key go by their text."""
    return F.md5(F.concat(F.lit(seed), F.coalesce(key.cast("string"), text, F.lit(""))))


def finish_times(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    seed: str = "",
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per row: key, place, source, size, source_size, turn, target, served, pace.

    ``served`` is the source's words up to the row's end in its first round, ``pace`` the time that a
    word takes. The shuffled order is that of md5(seed, key), or of the text where the key is null,
    then key and size; rows equal in all of these are interchangeable. Texts are read once.
    A running sum over a whole source would be one task's work, so it is taken in two steps: over
    the ``buckets`` of the hash's leading digits, then within a bucket. The result does not depend
    on their number (at most 65,536).
    """
    rows, rows_path = materialize(
        docs.select(
            F.col(key).alias("key"),
            F.col(source).cast("string").alias("source"),
            word_count(text).alias("size"),
            _place(F.col(key), F.col(text), seed).alias("place"),
        ),
        "sizes",
    )
    lead = F.conv(F.substring("place", 1, 4), 16, 10).cast("int")
    rows = rows.withColumn("bucket", F.floor(lead * buckets / 65536))
    parts = rows.groupBy("source", "bucket").agg(F.sum("size").alias("part"))
    sofar = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(
        F.col("source").alias("s"),
        F.col("bucket").alias("b"),
        F.coalesce(F.sum("part").over(sofar), F.lit(0)).alias("offset"),
    )
    targets = source_targets(parts.withColumnRenamed("part", "size"), weights, repeats)
    offsets = offsets.join(
        targets.withColumnRenamed("source", "t"), F.col("s").eqNullSafe(F.col("t")), "left"
    )
    within = (
        Window.partitionBy("source", "bucket")
        .orderBy("place", "key", "size")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    pace = F.call_function("div", F.lit(math.lcm(*weights)), F.col("weight"))
    times, _ = materialize(
        rows.withColumn("inner", F.sum("size").over(within))
        .join(offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .select(
            "key", "place", "source", "size", "source_size", "turn", "target",
            (F.col("offset") + F.col("inner")).alias("served"), pace.alias("pace"),
        ),
        "times",
    )
    discard(rows.sparkSession, rows_path)
    return times


def _finishes(repeats: int) -> Column:
    """When the copies of a row finish, one a round."""
    rounds = F.sequence(F.lit(0), F.lit(repeats - 1))
    return F.transform(rounds, lambda r: (F.col("served") + r * F.col("source_size")) * F.col("pace"))


def _crossing(rows: DataFrame, column: str, budget: int, high: int) -> tuple[int, int] | None:
    """The value of ``column`` (0 to ``high``) at which the sizes of all rows up to it exceed the
    budget, and what the smaller ones leave of it; None if all rows fit.

    Range partitions in place of a sort: each pass sums ``SLICES`` slices of the range and goes on with
    that in which the budget ends, so the driver sees as many rows, whatever the input.
    """
    low = 0
    while True:
        step = (high - low) // SLICES + 1
        part = F.call_function("div", F.col(column) - low, F.lit(step))
        sums = rows.filter(F.col(column).between(low, high)).groupBy(part.alias("part"))
        for slot, size in sorted(sums.agg(F.sum("size").alias("size")).collect()):
            if size > budget:
                break
            budget -= size
        else:
            return None
        low, high = low + slot * step, min(high, low + (slot + 1) * step - 1)
        if step == 1:
            return low, budget


def truncation(times: DataFrame, repeats: int = REPEATS) -> tuple[int, int]:
    """(finish, turn) of the first copy that the mix leaves out; the budget is the sum of all sizes."""
    budget, turns, pace = times.agg(F.sum("size"), F.max("turn"), F.max("pace")).first()
    if not budget:
        return 0, 0
    sized = times.filter("size > 0").select("size", "turn", F.explode(_finishes(repeats)).alias("finish"))
    found = _crossing(sized, "finish", budget, budget * repeats * pace)
    if found is None:
        return budget * repeats * pace + 1, 0
    finish, rest = found
    turn, _ = _crossing(sized.filter(F.col("finish") == finish), "turn", rest, turns)
    return finish, turn


def schedule(times: DataFrame, repeats: int = REPEATS) -> DataFrame:
    """``times`` with ``copies``: the finish times of the copies that the mix takes, in order.

    Every row is offered once per round. Empty texts are never taken.
    """
    finish, turn = truncation(times, repeats)
    last = F.lit(finish) - (F.col("turn") >= turn).cast("bigint")
    copies = F.filter(_finishes(repeats), lambda at: (at <= last) & (F.col("size") > 0))
    return times.withColumn("copies", copies)


def mixed_sizes(docs: DataFrame, repeats: int = REPEATS, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, size, source_size, target, taken.

    Whole documents are taken, in all less than one document short of the budget.
    Null and empty texts have size 0 and are never taken; an empty table gives an empty result.
    """
    taken = schedule(finish_times(docs, repeats=repeats, **options), repeats)
    return taken.select(
        F.col("key").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.size("copies")).alias("taken"),
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    repeats: int = REPEATS,
    seed: str = "",
    **options,
) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as taken, in the order of finish times.

    The order is a global range sort. Rows that agree in key, source and size are numbered by their
    text on one side and by their finish times on the other, and each takes its own copies.
    """
    names = internal(docs, "_place", "_size", "_source", "_turn", "_copies", "_finish")
    place, size, origin, turn, copies, finish = names
    times = finish_times(docs, key=key, text=text, source=source, repeats=repeats, seed=seed, **options)
    taken = (
        schedule(times, repeats)
        .filter("size > 0")
        .groupBy(F.col("place").alias(place), F.col("size").alias(size), F.xxhash64("source").alias(origin))
        .agg(F.array_sort(F.collect_list(F.struct("served", "copies"))).alias(copies))
        .filter(F.exists(copies, lambda own: F.size(own["copies"]) > 0))
    )
    alike = Window.partitionBy(place, size, origin).orderBy(F.xxhash64(F.col(text)))
    own = (
        docs.withColumn(place, _place(F.col(key), F.col(text), seed))
        .withColumn(size, word_count(text))
        .withColumn(origin, F.xxhash64(F.col(source).cast("string")))
        .withColumn(turn, F.row_number().over(alike))
    )
    return (
        own.join(taken, [place, size, origin])
        .withColumn(finish, F.explode(F.element_at(copies, F.col(turn))["copies"]))
        .orderBy(finish, place)
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
