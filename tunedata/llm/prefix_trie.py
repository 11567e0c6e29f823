"""A trie of conversation prefixes in balanced parentheses, one forest per shard.

Every conversation is cut into segments of at most 64 turns; a segment is known by the prefix
before it (its root) and the digests of its turns (its path). Distinct segments, each with the
number of its conversations, are range-sorted, so that a shard - some thousand neighbouring
segments - is a forest in preorder. There the parentheses delimit subtrees, rank counts leaf
pairs, and cumulative arrays give members and savings. Only nodes on the first or the last path
of a shard can go on in another one; these spines are merged by identity. Totals of long
conversations' later segments are carried upwards by pointer doubling.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunedata.llm.common import discard, materialize
from tunedata.llm.ordered import numbered
from tunedata.llm.parentheses import Parentheses
from tunedata.operators.lookup import attach_by_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BAND = 64
SHARD = 1 << 16
SIBLINGS = 5
SHARED = 9
CHUNK = 1 << 16
_DIGEST = 16

_NODES = (
    "id binary, level int, depth long, root binary, parent binary, parent_first long, n long, first long, "
    "size long, children long, leaves long, saved long, spine boolean, next binary, ancestors array<binary>"
)


def _digest(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*(p.cast("binary") for p in parts))))


def _first_root() -> Column:
    return F.unhex(F.md5(F.lit("").cast("binary")))


def turns(conversations: DataFrame) -> DataFrame:
    """(conv, place, digest, size) of every turn in order; turns alike in ``turn`` go by their digest."""
    role, text = (F.coalesce(F.col(c), F.lit("")).cast("binary") for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        _digest(F.octet_length(role).cast("string"), F.lit(":"), role, text).alias("digest"),
        F.octet_length(text).cast("long").alias("size"),
    )
    return numbered(rows, "conv", ["turn", "digest"], "turns").drop("turn")


def rebuilt(own: DataFrame, siblings: int = SIBLINGS, shared: int = SHARED) -> DataFrame:
    """Conversations rebuilt from ``turns``: (conv, place, digest, size), and a row (conv, null, ...)
    for a conversation that is left without turns.

    Of conversation c the first h = crc32(c) % ``shared`` turns are those of c - c % ``siblings``,
    all where that has fewer, none where it is absent; then come its own turns after its first h.
    """
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % shared
    base = F.col("conv") - F.pmod("conv", F.lit(siblings))
    convs = own.filter("place = 1").select("conv", head.alias("head"), base.alias("base"))
    firsts = own.filter((F.pmod("conv", F.lit(siblings)) == 0) & (F.col("place") < shared)).select(
        F.col("conv").alias("of"), "place", "digest", "size"
    )
    borrowed = convs.join(firsts, F.col("base") == F.col("of")).filter(F.col("place") <= F.col("head"))
    kept = own.filter(F.col("place") > head)
    together = borrowed.select("conv", F.col("place").alias("at"), "digest", "size").unionByName(
        kept.select("conv", (F.col("place") + shared).alias("at"), "digest", "size")
    )
    placed = numbered(together, "conv", ["at"], "rebuilt").drop("at")
    bare = convs.select("conv").join(
        placed.filter("place = 1").select(F.col("conv").alias("some")), F.col("conv") == F.col("some"), "left_anti"
    )
    none = F.lit(None)
    return placed.unionByName(
        bare.select(
            "conv", none.cast("long").alias("place"), none.cast("binary").alias("digest"), none.cast("long").alias("size")
        )
    )


def _segments(placed: DataFrame) -> DataFrame:
    """(conv, band, root, path, sizes, next): segments of at most 64 turns.

    ``next`` identifies the prefix up to the segment's end where the conversation goes on after it.
    It is a sum over segments of digests salted by their place, hence found by running sums.
    """
    turns_ = placed.filter(F.col("place").isNotNull())
    cut = (
        turns_.groupBy("conv", F.floor((F.col("place") - 1) / BAND).alias("band"))
        .agg(F.array_sort(F.collect_list(F.struct("place", "digest", "size"))).alias("own"))
        .select(
            "conv",
            "band",
            F.unhex(F.array_join(F.transform("own", lambda t: F.hex(t["digest"])), "")).alias("path"),
            F.col("own.size").alias("sizes"),
        )
    )
    bare = placed.filter(F.col("place").isNull()).select(
        "conv", F.lit(0).cast("long").alias("band"), F.lit(b"").alias("path"), F.array().cast("array<bigint>").alias("sizes")
    )
    cut, _ = materialize(cut.unionByName(bare), "segments")
    full = cut.filter(F.size("sizes") == BAND).withColumn(
        "hash", F.md5(F.concat(F.col("band").cast("string").cast("binary"), F.lit(b":"), F.col("path")))
    )
    lanes = [f"lane{i}" for i in range(4)]
    parts = [F.conv(F.substring("hash", 8 * i + 1, 8), 16, 10).cast("long").alias(lanes[i]) for i in range(4)]
    ends = numbered(full.select("conv", "band", *parts), "conv", ["band"], "prefixes", sums=lanes).select(
        "conv",
        "band",
        F.unhex(F.md5(F.concat_ws(":", "band", *(F.col(f"run_{x}") % (1 << 32) for x in lanes)).cast("binary"))).alias("end"),
    )
    later = ends.select("conv", (F.col("band") + 1).alias("band"), F.col("end").alias("root"))
    goes_on = cut.filter("band > 0").select("conv", (F.col("band") - 1).alias("band"))
    following = ends.join(goes_on, ["conv", "band"]).withColumnRenamed("end", "next")
    return (
        cut.join(later, ["conv", "band"], "left")
        .join(following, ["conv", "band"], "left")
        .withColumn("root", F.coalesce("root", _first_root()))
    )


def _forest(rows: dict[str, list]) -> pa.RecordBatch:
    """The nodes of one shard: neighbouring distinct segments in sorted order."""
    keys = [root + path for root, path in zip(rows["root"], rows["path"])]
    lengths = np.array([len(k) // _DIGEST for k in keys])
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.frombuffer(b"".join(keys), "<u8").reshape(-1, 2)
    sizes = np.zeros(len(flat), np.int64)
    inner = np.ones(len(flat), bool)
    inner[offsets[:-1]] = False
    sizes[inner] = [s for own in rows["sizes"] for s in own]

    # Common levels with the segment before.
    common = np.zeros(len(keys), np.int64)
    if len(keys) > 1:
        both = np.minimum(lengths[1:], lengths[:-1])
        begins = np.concatenate([[0], np.cumsum(both)])
        step = np.arange(begins[-1]) - np.repeat(begins[:-1], both)
        same = (flat[np.repeat(offsets[1:-1], both) + step] == flat[np.repeat(offsets[:-2], both) + step]).all(axis=1)
        stop = np.where(same, np.iinfo(np.int64).max, step)
        common[1:] = np.minimum(np.minimum.reduceat(stop, begins[:-1]), both)
    fresh = lengths - common
    closing = np.append(lengths[:-1] - common[1:], lengths[-1])
    counts = np.stack([fresh, closing], axis=1).ravel()
    tree = Parentheses(np.repeat(np.tile([True, False], len(keys)), counts))

    ends = np.cumsum(fresh)
    total = int(ends[-1])
    row = np.repeat(np.arange(len(keys)), fresh)
    level = np.arange(total) - np.repeat(ends - fresh, fresh) + common[row]
    start, stop = np.arange(total), np.arange(total) + tree.subtree_sizes()
    parent = np.full(total, -1)
    spine = row == 0
    for at in range(int(level.max()) + 1):
        here = np.flatnonzero(level == at)
        if at:
            parent[here] = above[np.searchsorted(above, here) - 1]
        if at < lengths[-1]:
            spine[here[-1]] = True  # the last path
        above = here

    def summed(values: np.ndarray) -> np.ndarray:
        running = np.concatenate([[0], np.cumsum(values)])
        return running[stop] - running[start]

    last = ends - 1  # the node at which a segment ends
    members = np.zeros(total, np.int64)
    members[last] = rows["n"]
    members = summed(members)
    least = np.full(total + 1, np.iinfo(np.int64).max)
    least[last] = rows["first"]
    least = np.minimum.reduceat(least, np.stack([start, stop], axis=1).ravel())[::2]
    bytes_ = sizes[offsets[row] + level]
    following: list[bytes | None] = [None] * total
    for at, value in zip(last.tolist(), rows["next"]):
        following[at] = value
    goes_on = np.array([v is not None for v in following])
    saved = summed(np.where(spine, 0, (members - 1) * bytes_))
    leaves = summed(tree.leaves() & ~spine & ~goes_on)
    rooted = (parent >= 0) & ~spine
    children = np.bincount(parent[rooted], minlength=total)

    ids = [hashlib.md5(keys[r][: _DIGEST * (l + 1)]).digest() for r, l in zip(row.tolist(), level.tolist())]
    up = parent.tolist()
    wanted = spine | goes_on
    ancestors: list[list[bytes] | None] = [None] * total
    for at in np.flatnonzero(wanted).tolist():
        line, node = [ids[at]], up[at]
        while node >= 0:
            line.append(ids[node])
            node = up[node]
        ancestors[at] = line
    roots, bands = rows["root"], np.array(rows["band"])
    known = rooted & ~spine[parent]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.binary()),
            pa.array(level.astype(np.int32)),
            pa.array(bands[row] * BAND + level),
            pa.array([roots[r] for r in row.tolist()], pa.binary()),
            pa.array([ids[p] if p >= 0 else None for p in up], pa.binary()),
            pa.array(least[parent], mask=~known),
            pa.array(members),
            pa.array(least),
            pa.array(bytes_),
            pa.array(children.astype(np.int64)),
            pa.array(leaves.astype(np.int64)),
            pa.array(saved),
            pa.array(spine),
            pa.array(following, pa.binary()),
            pa.array(ancestors, pa.list_(pa.binary())),
        ],
        names=[field.split()[0] for field in _NODES.split(", ")],
    )


def _forests(elements: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        weight = 0
        for batch in batches:
            columns = {name: batch.column(at).to_pylist() for at, name in enumerate(batch.schema.names)}
            for at in range(batch.num_rows):
                for name, values in columns.items():
                    held.setdefault(name, []).append(values[at])
                weight += len(columns["sizes"][at]) + 1
                if weight >= elements:
                    yield _forest(held)
                    held, weight = {}, 0
        if held:
            yield _forest(held)

    return run


def _merge_spines(spines: DataFrame) -> DataFrame:
    """One row per spine node, with what its copies in several shards hold and with spine children.

    A shard has at most 130 spine nodes, so all this is small against the nodes.
    """
    fixed = ("level", "depth", "root", "parent", "size", "ancestors")
    merged, _ = materialize(
        spines.groupBy("id").agg(
            *(F.first(c).alias(c) for c in fixed),
            F.max("next").alias("next"),
            F.min("first").alias("first"),
            *(F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")),
        ),
        "spines",
    )
    kids = merged.groupBy(F.col("parent").alias("_of")).agg(F.count(F.lit(1)).alias("_kids"))
    counted = merged.join(kids, F.col("id") == F.col("_of"), "left").withColumn(
        "children", F.col("children") + F.coalesce("_kids", F.lit(0))
    )
    own = counted.select(
        F.explode("ancestors").alias("_to"),
        ((F.col("children") == 0) & F.col("next").isNull()).cast("long").alias("_leaf"),
        ((F.col("n") - 1) * F.col("size")).alias("_own"),
    )
    gained = own.groupBy("_to").agg(F.sum("_leaf").alias("_leaf"), F.sum("_own").alias("_own"))
    return (
        counted.join(gained, F.col("id") == F.col("_to"))
        .withColumn("leaves", F.col("leaves") + F.col("_leaf"))
        .withColumn("saved", F.col("saved") + F.col("_own"))
        .drop("_of", "_kids", "_to", "_leaf", "_own")
    )


def _add_later_segments(nodes: DataFrame) -> DataFrame:
    """Add to every node what segments below its own hold."""
    spark = nodes.sparkSession
    hooks = nodes.filter(F.col("next").isNotNull())
    above = hooks.select(F.col("next").alias("_root"), F.col("root").alias("up"))
    totals = (
        nodes.filter("level = 0")
        .select("root", "leaves", "saved", "children")
        .join(above, F.col("root") == F.col("_root"), "left")
        .drop("_root")
    )
    totals, path = materialize(totals, "totals")
    while totals.filter(F.col("up").isNotNull()).limit(1).count():
        given = totals.filter(F.col("up").isNotNull()).groupBy(F.col("up").alias("_up"))
        given = given.agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
        jump = totals.select(F.col("root").alias("up"), F.col("up").alias("further"))
        following, other = materialize(
            attach_by_key(
                totals.join(given, F.col("root") == F.col("_up"), "left").select(
                    "root",
                    "children",
                    "up",
                    (F.col("leaves") + F.coalesce("_leaves", F.lit(0))).alias("leaves"),
                    (F.col("saved") + F.coalesce("_saved", F.lit(0))).alias("saved"),
                ),
                jump,
                "up",
                ["root"],
            ).select("root", "leaves", "saved", "children", F.col("further").alias("up")),
            "totals",
        )
        discard(spark, path)
        totals, path = following, other
    below = totals.select(F.col("root").alias("_root"), F.col("leaves").alias("l"), F.col("saved").alias("s"))
    # A hook's ancestors within its segment: 64 rows per node that has a later segment.
    gained = (
        hooks.select("next", "ancestors")
        .join(below, F.col("next") == F.col("_root"))
        .select(F.explode("ancestors").alias("_to"), "l", "s")
        .groupBy("_to")
        .agg(F.sum("l").alias("_l"), F.sum("s").alias("_s"))
    )
    kids = totals.select(F.col("root").alias("_next"), F.col("children").alias("_kids"))
    top = totals.select(F.col("root").alias("_top"), F.col("leaves").alias("_tl"), F.col("saved").alias("_ts"))
    counted = (
        nodes.join(gained, F.col("id") == F.col("_to"), "left")
        .join(kids, F.col("next") == F.col("_next"), "left")
        .withColumn("children", F.col("children") + F.coalesce("_kids", F.lit(0)))
        .withColumn("leaves", F.col("leaves") + F.coalesce("_l", F.lit(0)))
        .withColumn("saved", F.col("saved") + F.coalesce("_s", F.lit(0)))
    )
    whole = counted.filter("depth = 0").join(top, F.col("root") == F.col("_top"))
    return (
        counted.filter("level > 0")
        .select(nodes.columns)
        .unionByName(
            whole.withColumn("leaves", F.col("_tl")).withColumn("saved", F.col("_ts")).select(nodes.columns)
        )
    )


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring numbers of one key, joined by commas in pieces of some 64 KB."""
    key, numbers, weight, out = None, [], 0, []

    def piece() -> tuple[bytes, int, str]:
        return key, numbers[0], ",".join(map(str, numbers))

    def block() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([o[i] for o in out], t) for i, t in enumerate((pa.binary(), pa.int64(), pa.string()))],
            names=["end", "least", "piece"],
        )

    held = 0
    for batch in batches:
        for own, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if numbers and (own != key or weight >= CHUNK):
                out.append(piece())
                held += weight
                numbers, weight = [], 0
            key = own
            numbers.append(number)
            weight += 12
            if held >= 1 << 20:
                yield block()
                out, held = [], 0
    if numbers:
        out.append(piece())
    if out:
        yield block()


def _hash(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the pieces of each key, one piece at a time."""
    key, state = None, None

    def block(keys: list[bytes], values: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(values)], names=["end", "ends_sha256"]
        )

    for batch in batches:
        keys, values = [], []
        for own, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if own == key:
                state.update(b"," + piece.encode())
                continue
            if key is not None:
                keys.append(key)
                values.append(state.hexdigest())
            key, state = own, hashlib.sha256(piece.encode())
        if keys:
            yield block(keys, values)
    if key is not None:
        yield block([key], [state.hexdigest()])


def end_hashes(ends: DataFrame) -> DataFrame:
    """(end, ends_sha256) of (end, conv): the hash of each end's numbers, ascending, comma-joined.

    Numbers are sorted in ranges, so an end may have any share of them, and packed there; the hash of
    a hot end, sequential by its nature, then streams over few long pieces.
    """
    width = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (
        ends.select("end", "conv")
        .repartitionByRange(width, "end", "conv")
        .sortWithinPartitions("end", "conv")
        .mapInArrow(_pack, "end binary, least long, piece string")
    )
    return pieces.repartition("end").sortWithinPartitions("end", "least").mapInArrow(_hash, "end binary, ends_sha256 string")


def prefix_trie(placed: DataFrame, elements: int = SHARD) -> DataFrame:
    """One row per distinct prefix of the conversations (conv, place, digest, size), root included.

    ``place`` runs from 1; a conversation without turns is one row with a null place. Columns:
    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256. Conversations may have any number of turns; no row holds more than 64 of them.
    Prefixes are told apart by 128-bit digests. No conversation, no row.
    """
    segments, _ = materialize(_segments(placed), "segments")
    distinct = segments.groupBy("root", "path").agg(
        F.first("band").alias("band"),
        F.first("sizes").alias("sizes"),
        F.count(F.lit(1)).alias("n"),
        F.min("conv").alias("first"),
        F.max("next").alias("next"),
    )
    width = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    written, _ = materialize(
        distinct.repartitionByRange(width, "root", "path")
        .sortWithinPartitions("root", "path")
        .mapInArrow(_forests(elements), _NODES),
        "nodes",
    )
    inner = written.filter(~F.col("spine")).drop("spine")
    spines = _merge_spines(written.filter("spine")).withColumn("parent_first", F.lit(None).cast("long"))
    nodes, _ = materialize(inner.unionByName(spines.select(inner.columns)), "trie")
    deep = bool(nodes.filter(F.col("next").isNotNull()).limit(1).count())
    if deep:
        nodes, _ = materialize(_add_later_segments(nodes), "trie")

    # Parents on a spine, and those in the segment before, have been merged only now.
    unknown = nodes.filter(F.col("parent_first").isNull())
    later = (F.col("level") == 1) & (F.col("depth") > 1)
    sought = unknown.withColumn("_parent", F.when(later, F.col("root")).otherwise(F.col("parent"))).drop("parent_first")
    found = spines.filter((F.col("level") > 0) | (F.col("depth") == 0)).select("id", "first")
    if deep:
        found = found.unionByName(nodes.filter(F.col("next").isNotNull()).select(F.col("next").alias("id"), "first"))
    found = found.select(F.col("id").alias("_parent"), F.col("first").alias("parent_first"))
    placed_ = attach_by_key(sought, found, "_parent", ["id"])
    named = nodes.filter(F.col("parent_first").isNotNull()).unionByName(placed_.select(nodes.columns))
    ends = segments.filter(F.col("next").isNull()).select(_digest(F.col("root"), F.col("path")).alias("end"), "conv")
    hashes = end_hashes(ends)
    return named.join(hashes, F.col("id") == F.col("end"), "left").select(
        F.col("first").alias("conv_id"),
        "depth",
        F.col("parent_first").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def rebuilt_prefixes(conversations: DataFrame, elements: int = SHARD) -> DataFrame:
    """The trie of the rebuilt conversations (``rebuilt``) of a table (conv_id, turn, role, text).

    A null role or text is empty, null turns come first, rows alike in ``turn`` are ordered by a
    digest of role and text, rows without ``conv_id`` belong to no conversation. An empty table
    gives an empty result; other columns are not read.
    """
    return prefix_trie(rebuilt(turns(conversations)), elements)
