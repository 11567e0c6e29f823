"""Sharding by balanced label propagation.

A label is a shard. Linked rows see how many members of their group every shard holds and wish to
move to the fullest one with room; quotas per pair of shards, found on the driver from a matrix of
shards by shards, keep every shard within its capacity at every round, so the numbers of rows stay
even while links between shards become fewer. Groups are only counted per shard, never paired.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunedata.llm.common import discard, internal, materialize
from tunedata.llm.ordered import numbered
from tunedata.operators.lookup import attach_by_key

SHARDS = 8
ROUNDS = 12


def quotas(wishes: Sequence[Sequence[int]], held: Sequence[int], capacity: Sequence[int]) -> list[list[int]]:
    """How many of the wished moves a -> b take place, so that no shard exceeds its capacity.

    ``held`` must be within ``capacity``. Moves are cut back where too many arrive; that keeps rows
    where they are, which may cut back others. Every round lowers some quota, so it ends; swaps
    need no room and survive.
    """
    shards = len(held)
    moves = [[0 if a == b else int(wishes[a][b]) for b in range(shards)] for a in range(shards)]
    while True:
        for b in range(shards):
            arriving = sum(moves[a][b] for a in range(shards))
            excess = held[b] + arriving - sum(moves[b]) - capacity[b]
            if excess <= 0:
                continue
            # Shares by size, rounded so that they add up; one-way moves go before swaps.
            for weigh in (lambda a: max(moves[a][b] - moves[b][a], 0), lambda a: moves[a][b]):
                weights = [weigh(a) for a in range(shards)]
                total = sum(weights)
                cut = min(excess, total)
                given = 0
                for a in range(shards):
                    share = cut * sum(weights[: a + 1]) // total - given if total else 0
                    moves[a][b] -= share
                    given += share
                excess -= cut
            break
        else:
            return moves


def _votes(state: DataFrame, shards: int) -> DataFrame:
    """Per group, how many members each shard holds."""
    return state.groupBy("link").agg(
        F.array(*(F.count(F.when(F.col("shard") == s, 1)) for s in range(shards))).alias("votes")
    )


def _wishes(state: DataFrame, room: Sequence[int], shards: int) -> DataFrame:
    """Unsettled rows with the shard they wish to move to, if any, and what they would gain.

    A row only ever wishes to go where its group is stronger, or as strong and first in an order of
    the shards that is the group's own, so that two rows never chase each other and wishes go both
    ways between any two shards. Among such shards with room the strongest is wished for; without
    any, the strongest, which a swap may still give.
    """
    seen = attach_by_key(state, _votes(state, shards), "link", ["row"])
    split = seen.filter(F.size(F.filter("votes", lambda v: v > 0)) > 1)
    own = F.element_at("votes", F.col("shard") + 1)
    here = F.struct(own.alias("v"), F.xxhash64("link", "shard").alias("t"))

    def strength(s: int, only_room: bool):
        votes = F.element_at("votes", s + 1)
        turn = F.xxhash64("link", F.lit(s))
        allowed = (F.struct(votes.alias("v"), turn.alias("t")) > here) & F.lit(room[s] > 0 or not only_room)
        return F.when(allowed, F.struct(votes.alias("v"), turn.alias("t"), F.lit(s).alias("s")))

    first = F.greatest(*(strength(s, True) for s in range(shards)))
    best = F.coalesce(first, F.greatest(*(strength(s, False) for s in range(shards))))
    return split.select(
        "row", "link", "shard", best["s"].alias("to"), (best["v"] - own + 1).alias("gain")
    )


def propagate(
    state: DataFrame, capacity: Sequence[int], rounds: int = ROUNDS
) -> tuple[DataFrame, list[int]]:
    """Rounds of label propagation on (row, link, shard), shard a valid first labelling.

    Returns (row, shard) and the number of rows in each shard. Groups that lie in one shard are
    settled, written once and left out of later rounds. Ends when no row moves.
    """
    shards = len(capacity)
    spark = state.sparkSession
    done: list[DataFrame] = []
    counts = dict(state.groupBy("shard").count().collect())
    held = [int(counts.get(s, 0)) for s in range(shards)]
    for _ in range(rounds if shards > 1 else 0):
        room = [c - h for c, h in zip(capacity, held)]
        wishing, path = materialize(_wishes(state, room, shards), "wishes")
        asked = wishing.filter(F.col("to").isNotNull()).groupBy("shard", "to").count().collect()
        if not asked:
            discard(spark, path)
            break
        matrix = [[0] * shards for _ in range(shards)]
        for a, b, count in asked:
            matrix[a][b] = count
        moves = quotas(matrix, held, capacity)
        pairs = [(a * shards + b, moves[a][b]) for a in range(shards) for b in range(shards)]
        if not any(q for _, q in pairs):
            discard(spark, path)
            break
        # Within a pair of shards the largest gains go first; whole groups stand together.
        rows = wishing.filter(F.col("to").isNotNull()).select(
            "*",
            (F.col("shard") * shards + F.col("to")).cast("long").alias("pair"),
            (-F.col("gain")).alias("loss"),
        )
        placed = numbered(rows, "pair", ["loss", "link", "row"], "moves")
        quota = F.element_at(F.array(*(F.lit(q) for _, q in pairs)), F.col("pair").cast("int") + 1)
        moved = placed.filter(F.col("place") <= quota).select(F.col("row").alias("_row"), "to")
        joined = state.join(moved, F.col("row") == F.col("_row"), "left")
        following, labelled = materialize(
            joined.select("row", "link", F.coalesce("to", "shard").alias("shard")), "labels"
        )
        discard(spark, path)
        held = [
            held[s] + sum(moves[a][s] for a in range(shards)) - sum(moves[s]) for s in range(shards)
        ]
        settled = _votes(following, shards).select(
            "link", (F.size(F.filter("votes", lambda v: v > 0)) == 1).alias("settled")
        )
        marked, _ = materialize(attach_by_key(following, settled, "link", ["row"]), "marked")
        discard(spark, labelled)
        done.append(marked.filter("settled").select("row", "shard"))
        state = marked.filter(~F.col("settled")).select("row", "link", "shard")
    labels = state.select("row", "shard")
    for part in done:
        labels = labels.unionByName(part)
    return labels, held


def even_shards(
    rows: DataFrame,
    link: str,
    order: Sequence[str],
    shards: int = SHARDS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``rows`` with ``shard`` and ``slot``: shards whose numbers of rows differ by one at most.

    Rows with equal ``link`` are linked; a null link, and a link that only one row has, links
    nothing. A first labelling deals linked rows out in turn, by a hash of their ``order``
    columns; label propagation then gathers them under the capacities; rows without links fill what
    is left. A group larger than a shard spreads over few. Sizes always hold; how few links are cut
    depends on room: a shard full of linked rows changes by swaps alone. ``order`` should tell rows apart: rows
    equal in it may swap places, all else is the same at every run. Slots run from 0 in every
    shard. An empty table gives an empty result. Helper names avoid those of ``rows``.

    All columns of ``rows`` travel with the rows, so select narrow ones; texts are not needed.
    """
    size, row, mix, own = internal(rows, "link_size", "row", "mix", "own_row")
    sizes = rows.groupBy(link).agg(F.count(F.lit(1)).alias(size))
    marked, _ = materialize(
        attach_by_key(rows, sizes, link, list(order))
        .withColumn(size, F.when(F.col(link).isNotNull() & (F.col(size) > 1), F.lit(1)).otherwise(0).cast("long"))
        .withColumn(mix, F.xxhash64(*order)),
        "linked",
    )
    # Linked rows (1) and the others (0) are each numbered in a fixed random order.
    dealt = numbered(marked, size, [mix, *order], "dealt", place=row)
    total = dict(marked.groupBy(size).count().collect())
    loose, bound = int(total.get(0, 0)), int(total.get(1, 0))
    capacity = [(loose + bound) // shards + (s < (loose + bound) % shards) for s in range(shards)]
    start = dealt.filter(F.col(size) == 1).select(
        F.col(row).alias("row"),
        F.xxhash64(link).alias("link"),
        F.pmod(F.col(row) - 1, F.lit(shards)).cast("int").alias("shard"),
    )
    state, _ = materialize(start, "labels")
    labels, held = propagate(state, capacity, rounds)
    slots = numbered(
        labels.select("row", F.col("shard").cast("long").alias("shard")), "shard", ["row"], "slots"
    ).select(F.col("row").alias(own), F.col("shard").cast("int").alias("shard"), (F.col("place") - 1).alias("slot"))
    gathered = dealt.filter(F.col(size) == 1).join(slots, F.col(row) == F.col(own))
    # The others fill the shards one after the other; their order is a random one already.
    ends = [sum(capacity[: s + 1]) - sum(held[: s + 1]) for s in range(shards)]
    at = F.col(row) - 1
    into = sum((at >= F.lit(e)).cast("int") for e in ends[:-1]) if shards > 1 else F.lit(0)
    begin = F.element_at(F.array(*(F.lit(e).cast("long") for e in [0, *ends[:-1]])), into + 1)
    base = F.element_at(F.array(*(F.lit(h).cast("long") for h in held)), into + 1)
    filled = dealt.filter(F.col(size) == 0).select(
        *rows.columns, into.cast("int").alias("shard"), (at - begin + base).alias("slot")
    )
    return gathered.select(*rows.columns, "shard", "slot").unionByName(filled)


def sharded_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """Shard and slot of every document, documents of equal text linked: key, size (bytes of the text
    and one more), text_crc32, law (``rows``: counts differ by one at most), shard, slot, and
    grown_shard, null under this law. A null text counts as empty. Other columns are not read.
    """
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    narrow = docs.select(
        F.col(key).alias("key"),
        (F.octet_length(data).cast("long") + 1).alias("size"),
        F.crc32(data).alias("text_crc32"),
        F.unhex(F.md5(data)).alias("digest"),
    )
    narrow, _ = materialize(narrow, "digests")  # texts are read and hashed once
    placed = even_shards(narrow, "digest", ["key", "digest"], shards, rounds)
    return placed.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
