"""Similarity join on word n-grams as a blocked product of the document by n-gram matrix.

The product of the incidence matrix with its transpose holds the overlaps of all pairs. It is never
formed as a whole:

* Columns are blocks of their own, hash-partitioned by n-gram. Of each row only those columns enter
  the product that the size bound leaves: two sets with overlap / union >= t share one of their
  first n - ceil(t n) + 1 n-grams in any common order. Rare n-grams come first in it; how rare, a
  table of fixed size tells, which counts n-grams by the leading bits of their hashes.
* Entries are shuffled once. Columns that this table shows to be very frequent are split by a salt,
  and of a text with very many copies one row makes entries, so that no block holds a hot key.
* Every row first meets the hub of each of its columns, a set with many copies if there is one, and of
  these hubs the one with which it shares most columns. Verified pairs join rows to groups.
* Only entries of columns whose rows are then in different groups enter the product. It accumulates
  the overlap of each pair; sizes and the last shared positions discard pairs that cannot reach the
  threshold, and for the others what follows these positions is added.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunedata.llm.common import (
    add_up,
    broadcast_if_small,
    discard,
    internal,
    materialize,
    pack_arrays,
    tidied,
    unpack_array,
)
from tunedata.llm.components import components
from tunedata.llm.hashing import mix, shingles, word_hashes
from tunedata.operators.lookup import attach_by_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 5
PERCENT = 75
CELL_BITS = 20
CELL_BLOCKS = 64
# A cell of n-grams that holds this share of all is split by a salt; so are texts with that many copies.
HEAVY_SHARE = 4096
HEAVY_LEAST = 256
SPREAD = 64
GRAM_BYTES = 6
# Entries hold the upper 48 bits, with the cell's; members hold the lower ones.
ENTRY_BITS = np.uint64(0xFFFFFFFFFFFF0000)
COPIED_TEXTS = 1024
# Fixed numbers; a column's hub is the row that is smallest after flipping bits by one of them.
FLIPS = (0, 0x2545F4914F6CDD1D, -0x61C8864680B583EB, 0x3C6EF372FE94F82A)
MAX_ROWS = 20_000
MAX_GRAMS = 1_000_000


def set_id(grams: np.ndarray) -> int:
    """Signed 64-bit identity of a sorted set of n-grams."""
    order = np.arange(1, len(grams) + 1, dtype=np.uint64)
    total = mix(grams + mix(order)).sum(dtype=np.uint64) + np.uint64(len(grams))
    return int(mix(np.array([total]))[0].astype(np.int64))


def _sets(batch: pa.RecordBatch, column: int, width: int) -> Iterator[np.ndarray]:
    texts = batch.column(column)
    for at in range(batch.num_rows):
        yield shingles(word_hashes(texts[at].as_buffer()), width)


def _cell(grams: np.ndarray) -> np.ndarray:
    return (grams >> np.uint64(64 - CELL_BITS)).astype(np.int64)


def _content(text: str) -> Column:
    return F.col(text).cast("binary").alias("text")


def _pick(key: str, text: str) -> Column:
    """Tells rows apart, but for repeated ones."""
    return F.xxhash64(key, text).alias("pick")


def _read_sets(docs: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """Per row: key, pick, n, sid, at (its number); per task and block of cells: block, counts."""
    rows = docs.select(F.col(key).alias("key"), _pick(key, text), _content(text))
    names = ["key", "pick", "n", "sid", "at", "block", "counts"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << CELL_BITS, np.int64)
        kind, at = None, TaskContext.get().partitionId() << 40
        for batch in batches:
            kind = batch.schema.field(0).type
            n, sid, waiting, waits = [], [], [], 0
            for grams in _sets(batch, 2, width):
                n.append(len(grams))
                sid.append(set_id(grams))
                waiting.append(_cell(grams))
                waits += len(grams)
                if waits >= MAX_GRAMS:
                    counts += np.bincount(np.concatenate(waiting), minlength=len(counts))
                    waiting, waits = [], 0
            if waits:
                counts += np.bincount(np.concatenate(waiting), minlength=len(counts))
            size = batch.num_rows
            arrays = [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(sid, pa.int64())]
            arrays += [pa.array(np.arange(at, at + size)), pa.nulls(size, pa.int32()), pa.nulls(size, pa.binary())]
            at += size
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        if kind is not None:
            arrays = [pa.nulls(CELL_BLOCKS, kind), *[pa.nulls(CELL_BLOCKS, pa.int64())] * 4]
            arrays += pack_arrays(range(CELL_BLOCKS), counts.reshape(CELL_BLOCKS, -1)).columns
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    # The rows that carry counts have no key, whatever the table says of its own.
    schema = T.StructType([T.StructField("key", rows.schema["key"].dataType)])
    for name, kind in (("pick", "long"), ("n", "long"), ("sid", "long"), ("at", "long"), ("block", "integer"), ("counts", "binary")):
        schema = schema.add(name, kind)
    return rows.mapInArrow(tidied(run), schema)


class Rarity(NamedTuple):
    """Per cell: how often its n-grams occur, on a logarithmic scale of one byte; whether very often."""

    levels: np.ndarray
    heavy: np.ndarray


def _rarity(cells: DataFrame) -> Rarity:
    total = np.zeros((CELL_BLOCKS, (1 << CELL_BITS) // CELL_BLOCKS), np.int64)
    for row in add_up(cells, "block", "counts", "<i8").collect():
        total[row["key"]] = unpack_array(row["value"], "<i8")
    counts = total.ravel()
    levels = np.minimum(6 * np.log2(counts + 1.0), 255).astype(np.uint8)
    return Rarity(levels, counts >= max(HEAVY_LEAST, int(counts.sum()) // HEAVY_SHARE))


def _ordered_grams(grams: np.ndarray, levels: np.ndarray) -> np.ndarray:
    return grams[np.argsort(levels[_cell(grams)], kind="stable")]


def _copied(rows: DataFrame) -> dict[int, int]:
    """The pick of one row for each of the sets that most rows have; at most ``COPIED_TEXTS``.

    Spark's frequent-items sketch names them; they are counted exactly.
    """
    names = rows.filter("n > 0").agg(F.expr(f"approx_top_k(sid, {COPIED_TEXTS}, {4 * COPIED_TEXTS})").alias("top"))
    names = names.select(F.explode("top.item").alias("name"))
    found = rows.join(F.broadcast(names), F.col("sid") == F.col("name"), "left_semi").groupBy("sid")
    counted = found.agg(F.count(F.lit(1)).alias("copies"), F.min("pick").alias("pick")).filter("copies > 1")
    return {row["sid"]: row["pick"] for row in counted.collect()}


def prefix_length(n: int, percent: int) -> int:
    """How many n-grams of a set can be the first that it shares with a similar one."""
    return n - -(-percent * n // 100) + 1


def _entries(
    docs: DataFrame, key: str, text: str, width: int, percent: int, rarity: Rarity, copied: dict[int, int]
) -> DataFrame:
    """Entries of the matrix that the size bound leaves: gram, salt, sid, copied, pos.

    ``pos`` holds the set's size in its upper and the place of the gram (from 0, rare first) in its
    lower half. ``salt`` is -1 but in heavy cells. Sets in ``copied`` enter by one row only.
    """
    # About 2 MB and 1,024 numbers, whatever the input.
    shared = docs.sparkSession.sparkContext.broadcast((rarity.levels, rarity.heavy, copied))

    def columns(found: list[tuple[np.ndarray, int, int]]) -> pa.RecordBatch:
        counts = [len(first) for first, _, _ in found]
        grams = np.concatenate([first for first, _, _ in found])
        sid = np.repeat(np.array([x for _, x, _ in found], np.int64), counts)
        n = np.repeat(np.array([x for _, _, x in found], np.int64), counts)
        place = np.concatenate([np.arange(x) for x in counts])
        grams &= ENTRY_BITS
        many = np.isin(sid, list(shared.value[2]))
        own = (mix(sid.view(np.uint64)) % np.uint64(SPREAD)).astype(np.int32)
        salt = np.where(shared.value[1][_cell(grams)], own, np.int32(-1))
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (grams.view(np.int64), salt, sid, many, (n << 32) | place)],
            names=["gram", "salt", "sid", "copied", "pos"],
        )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            picks = batch.column(0).to_pylist()
            for pick, grams in zip(picks, _sets(batch, 1, width)):
                sid = set_id(grams)
                if len(grams) and shared.value[2].get(sid, pick) == pick:
                    first = _ordered_grams(grams, shared.value[0])[: prefix_length(len(grams), percent)]
                    found.append((first, sid, len(grams)))
                    size += len(first)
                if size >= MAX_ROWS:
                    yield columns(found)
                    found, size = [], 0
        if found:
            yield columns(found)

    # Without nulls, lest a join filter one use of the shuffled entries and not the other.
    kinds = {"gram": "bigint", "salt": "int", "sid": "bigint", "copied": "boolean", "pos": "bigint"}
    fields = ", ".join(f"{name} {kind} NOT NULL" for name, kind in kinds.items())
    return docs.select(_pick(key, text), _content(text)).mapInArrow(tidied(run), fields)


def _size(pos: str) -> Column:
    return F.shiftright(pos, 32)


def _place(pos: str) -> Column:
    return F.col(pos).bitwiseAND(F.lit(0xFFFFFFFF))


def _reaches(x: str, y: str, percent: int) -> Column:
    """If this is the first column that two rows share, what follows still reaches the bound.

    Of a pair that reaches it, the first shared column passes, and those that pass come before those
    that do not, so no pair is lost.
    """
    rest = F.least(_size(x) - _place(x), _size(y) - _place(y))
    return rest * (100 + percent) >= (_size(x) + _size(y)) * percent


def _shared_columns(entries: DataFrame) -> DataFrame:
    """Entries of columns with several rows, with the hub of their block: gram, salt, copied, sid, pos,
    rank, hub, hub_pos.

    The dealt entries serve both the hubs and the rows, so they are made and shuffled once. Rows of a
    salted column stay even if alone in their block.
    """
    dealt = entries.repartition("gram", "salt")
    flips = F.array(*[F.lit(x).cast("bigint") for x in FLIPS])
    flip = F.element_at(flips, (F.pmod("gram", F.lit(len(FLIPS))) + 1).cast("int"))
    mixed = F.col("sid").bitwiseXOR(flip)
    # Smallest for sets with many copies.
    rank = F.when(F.col("copied"), F.shiftright(mixed, 2) - F.lit(1 << 62)).otherwise(F.shiftright(mixed, 2))
    # Conditions on aggregates, and both uses reading all columns: Spark then runs the exchange once.
    blocks = (
        dealt.groupBy("gram", "salt")
        .agg(
            F.min(rank).alias("rank"),
            F.min_by("sid", rank).alias("hub"),
            F.min_by("pos", rank).alias("hub_pos"),
            F.min("sid").alias("low"),
            F.max("sid").alias("high"),
            F.max("salt").alias("block"),
        )
        .filter("low <> high OR block >= 0")
        .drop("low", "high", "block")
    )
    found = dealt.join(blocks.hint("shuffle_hash"), ["gram", "salt"])
    return found.select("gram", "salt", "copied", "sid", "pos", "rank", "hub", "hub_pos").distinct()


def _first_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """(a, b): each row with the hub with which it shares most columns."""
    columns = ["sid", "pos", "hub", "hub_pos"]
    # A salted column's hub is the first of those of its blocks.
    heavy = shared.filter("salt >= 0")
    tops = heavy.groupBy("gram").agg(F.min_by("hub", "rank").alias("hub"), F.min_by("hub_pos", "rank").alias("hub_pos"))
    rows = attach_by_key(heavy.select("gram", "sid", "pos"), tops, "gram", ["sid"]).select(columns)
    rows = rows.unionByName(shared.filter("salt < 0").select(columns))
    met = rows.filter((F.col("sid") != F.col("hub")) & _reaches("pos", "hub_pos", percent)).groupBy("sid", "hub")
    best = met.agg(F.count(F.lit(1)).alias("count")).groupBy("sid").agg(F.max_by("hub", "count").alias("hub"))
    return best.select(*_ordered("sid", "hub")).distinct()


def _open_entries(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """(gram, salt, sid, pos, root): entries of columns whose rows are in several groups, and of salted ones."""
    placed = (
        shared.select("gram", "salt", "sid", "pos")
        .join(roots, F.col("sid") == F.col("node"), "left")
        .select("gram", "salt", "sid", "pos", F.coalesce("root", "sid").alias("root"))
    )
    dealt = placed.repartition("gram", "salt")
    blocks = dealt.groupBy("gram", "salt").agg(
        F.min("root").alias("low"),
        F.max("root").alias("high"),
        F.max("salt").alias("block"),
        F.max(F.greatest("sid", F.col("pos"))).alias("most"),  # never null: read for the exchange's sake
    )
    blocks = blocks.filter("(low <> high OR block >= 0) AND most IS NOT NULL").select("gram", "salt")
    # Not a semi-join: Spark would move that below the exchange.
    return dealt.join(blocks.hint("shuffle_hash"), ["gram", "salt"])


def _product(shared: DataFrame, roots: DataFrame, percent: int) -> tuple[DataFrame, str]:
    """Pairs of rows of different groups that can reach the threshold, with their overlap so far:
    (a, b, count, after_a, after_b). What follows the places ``after_*`` is not counted yet."""
    found, path = materialize(_open_entries(shared, roots), "open")
    heavy = found.filter("salt >= 0")
    mixed = heavy.groupBy("gram").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    open_entries = found.filter("salt < 0").unionByName(
        heavy.join(mixed.select("gram"), "gram", "left_semi").select(found.columns)
    )
    left = open_entries.select("gram", *(F.col(c).alias(f"{c}_a") for c in ("sid", "pos", "root")))
    right = open_entries.select("gram", *(F.col(c).alias(f"{c}_b") for c in ("sid", "pos", "root")))
    both = left.join(right, "gram").filter((F.col("root_a") < F.col("root_b")) & _reaches("pos_a", "pos_b", percent))
    overlap = both.groupBy(F.col("sid_a").alias("a"), F.col("sid_b").alias("b")).agg(
        F.count(F.lit(1)).alias("count"),
        F.max(_place("pos_a")).alias("after_a"),
        F.max(_place("pos_b")).alias("after_b"),
        F.max(_size("pos_a")).alias("n_a"),
        F.max(_size("pos_b")).alias("n_b"),
    )
    most = F.col("count") + F.least(F.col("n_a") - F.col("after_a"), F.col("n_b") - F.col("after_b")) - 1
    return overlap.filter(most * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent).drop("n_a", "n_b"), path


def _members(docs: DataFrame, key: str, text: str, width: int, rarity: Rarity, wanted: DataFrame) -> DataFrame:
    """sid and grams, rare first, of the sets in ``wanted`` (pick), which names one row for each.

    A gram goes by 48 bits of its hash: two sets of 1,000 are told apart but for one in 10^8 pairs.
    """
    shared = docs.sparkSession.sparkContext.broadcast(rarity.levels)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # repeated rows share a pick
        for batch in batches:
            sids, found, size = [], [], 0
            for grams in _sets(batch, 0, width):
                sid = set_id(grams)
                if sid in seen:
                    continue
                seen.add(sid)
                sids.append(sid)
                ordered = _ordered_grams(grams, shared.value).astype("<u8")
                found.append(ordered.view(np.uint8).reshape(-1, 8)[:, :GRAM_BYTES].tobytes())
                size += len(grams)
                if size >= MAX_ROWS:
                    yield pa.RecordBatch.from_pydict({"sid": sids, "grams": found})
                    sids, found, size = [], [], 0
            if sids:
                yield pa.RecordBatch.from_pydict({"sid": sids, "grams": found})

    rows = docs.select(_pick(key, text), _content(text)).join(broadcast_if_small(wanted), "pick", "left_semi")
    return rows.select("text").mapInArrow(tidied(run), "sid bigint NOT NULL, grams binary NOT NULL")


def _unpacked(grams: pa.BinaryScalar, after: int) -> np.ndarray:
    rows = np.frombuffer(grams.as_buffer(), np.uint8).reshape(-1, GRAM_BYTES)[after + 1 :]
    return np.pad(rows, ((0, 0), (0, 8 - GRAM_BYTES))).view("<u8").ravel()


def _alike(percent: int):
    """Keep the pairs whose overlap, with what follows the counted places, reaches the threshold."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, count, after_a, after_b = (batch.column(i).to_pylist() for i in range(5))
            kept = []
            for at, left, right in zip(range(batch.num_rows), batch.column(5), batch.column(6)):
                sizes = len(left.as_buffer()) + len(right.as_buffer())
                rest = np.intersect1d(_unpacked(left, after_a[at]), _unpacked(right, after_b[at]), assume_unique=True)
                if (count[at] + len(rest)) * (100 + percent) * GRAM_BYTES >= sizes * percent:
                    kept.append(at)
            if kept:
                yield pa.RecordBatch.from_pydict({"a": [a[i] for i in kept], "b": [b[i] for i in kept]})

    return run


def _ordered(a: str, b: str) -> list:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def linked(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """One row per row of ``docs``: key, n_shingles, component_id.

    A row's set: the distinct shingles of ``width`` words (ASCII white space between, A-Z in lower
    case), or all its words as one where there are fewer. Rows link when
    100 * overlap >= percent * union; component_id is the smallest key that links lead to. Rows without a word are
    alone and have n_shingles 0. Equal sets, repeated rows included, are one row of the matrix; of the
    sets with most copies, one row makes the entries. Null keys are kept and never name a component
    unless all its keys are null. An empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    sets, _ = materialize(_read_sets(docs, key, text, width), "sets")
    rows = sets.filter(F.col("block").isNull()).select("key", "pick", "n", "sid", "at")
    rarity = _rarity(sets.filter(F.col("block").isNotNull()).select("block", "counts"))
    entries = _entries(docs, key, text, width, percent, rarity, _copied(rows))
    shared, shared_path = materialize(_shared_columns(entries), "shared")
    picks = rows.filter("n > 0").groupBy("sid").agg(F.min("pick").alias("pick"))

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of ``pairs`` whose whole overlap reaches the threshold: (a, b)."""
        asked_for = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct()
        wanted, asked = materialize(picks.join(asked_for, "sid", "left_semi").select("pick"), "wanted")
        members = _members(docs, key, text, width, rarity, wanted)  # shuffled once for both sides
        left = members.select(F.col("sid").alias("a"), F.col("grams").alias("left"))
        right = members.select(F.col("sid").alias("b"), F.col("grams").alias("right"))
        n = F.octet_length("left"), F.octet_length("right")
        near = F.least(*n).cast("long") * 100 >= F.greatest(*n).cast("long") * percent
        both = pairs.join(left, "a").join(right, "b").filter(near)
        both = both.select("a", "b", *(F.col(c).cast("long").alias(c) for c in ("count", "after_a", "after_b")), "left", "right")
        found, _ = materialize(both.mapInArrow(tidied(_alike(percent)), "a bigint, b bigint").distinct(), "links")
        discard(spark, asked)
        return found

    first, first_path = materialize(_first_pairs(shared, percent), "pairs")
    uncounted = [F.lit(0).alias("count"), F.lit(-1).alias("after_a"), F.lit(-1).alias("after_b")]
    roots = components(verified(first.select("a", "b", *uncounted)))
    product, open_path = _product(shared, roots, percent)
    # A pair of the product is unordered; those that were tried already have failed.
    tried = first.select(F.col("a").alias("ta"), F.col("b").alias("tb"))
    same = (F.least("a", "b") == F.col("ta")) & (F.greatest("a", "b") == F.col("tb"))
    second, second_path = materialize(product.join(tried, same, "left_anti"), "pairs")
    more = verified(second)
    roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    discard(spark, shared_path, first_path, open_path, second_path)

    # Copies share a set and a root; both may be hot.
    some = attach_by_key(rows.filter("n > 0"), roots.withColumnRenamed("node", "sid"), "sid", ["at"])
    grouped = some.select("key", "n", "at", F.coalesce("root", "sid").alias("root"))
    names = grouped.groupBy("root").agg(F.min("key").alias("name"))
    named = attach_by_key(grouped, names, "root", ["at"]).select("key", "n", "name")
    alone = rows.filter("n = 0").select("key", "n", F.col("key").alias("name"))
    return named.unionByName(alone).select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), F.col("name").alias("component_id")
    )


def one_per_group(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` with the smallest key of their group, with their own columns.

    Null keys come last; of repeated rows one stays.
    """
    (own,) = internal(docs, "_row")
    ranked = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.xxhash64(text).alias("sum"))
    named = docs.withColumn(own, ranked)
    groups = linked(named, key=own, text=text, **options)
    kept = groups.filter(F.col(own) == F.col("component_id")).select(F.col("component_id").alias("kept")).distinct()
    kept, _ = materialize(kept, "kept")
    # A null inside the identity must not keep it from being found.
    same = named[own].eqNullSafe(kept["kept"])
    found = named.join(kept, same, "left_semi").dropDuplicates([own])
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])
