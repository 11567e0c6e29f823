"""Removal of repeated substrings by bucket-pointer refinement.

A position's bucket holds all positions at which the same bytes follow; its identifier names it
everywhere. Identifiers for 2m bytes come from those for m bytes at the position and at m bytes
later, so every refinement reuses the previous ones. They are 64-bit fingerprints in place of ranks:
no order between tasks is needed to compare them, and buckets meet by sorting rows on them.

Windows are the strings of ``width`` bytes. A window is named by its anchor, the position of its
smallest 32-byte identifier, and by how far it begins before the anchor. Equal windows have equal
anchors and distances, so one row stands for all windows of one anchor: one in about 85 bytes.

1. The initial bucket of a row is the 32 bytes at its anchor, which all its windows hold.
2. Rows that are alone in their bucket are settled: none of their windows is repeated. So are rows
   whose whole run of windows is equal to another one: all of them are.
3. Where runs in a bucket differ, one row of each kind goes on. Its distances are halved, and each half
   is refined to the bucket of all bytes that its windows have in common, by identifiers of later
   offsets; then 2 is applied again, down to single windows.

Halves are cut at fixed distances, not at the ends of a run, so that equal windows of two runs are
always in the same bucket. Beyond the first step a row carries its own few hundred bytes.
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

from tunedata.llm.common import discard, internal, materialize, tidied
from tunedata.operators.lookup import attach_by_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 200
GRAM = 32
LARGEST = 256
CHUNK = 1 << 17
PARTS = 400
HOT_ROWS = 10_000
HOT_BUCKETS = 4096
SPREAD = 64
_POSITION = np.uint64((1 << 24) - 1)

_VALUES = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_FACTORS = np.random.default_rng(13).integers(1, 1 << 63, (9, 2), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _combine(first: np.ndarray, later: np.ndarray, level: int) -> np.ndarray:
    found = first * _FACTORS[level, 0]
    found ^= found >> np.uint64(32)
    found += later * _FACTORS[level, 1]
    return found


class Buckets:
    """Identifiers of all positions of some bytes, for 32, 64, 128 and 256 bytes.

    Zeros behind the end let each array have one element per byte; identifiers that reach them are
    never used, since only strings within a text are looked at.
    """

    def __init__(self, data: np.ndarray):
        ids = _VALUES[np.concatenate([data, np.zeros(LARGEST, np.uint8)])]
        self.by: dict[int, np.ndarray] = {}
        size, level = 1, 0
        while size < LARGEST:
            ids = _combine(ids[:-size], ids[size:], level)
            size, level = size * 2, level + 1
            if size >= GRAM:
                self.by[size] = ids

    def cover(self, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two buckets that together hold ``lengths`` bytes (32 to 512)."""
        first, later = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64)
        for size, ids in self.by.items():
            own = (lengths >= size) & ((lengths < 2 * size) | (size == LARGEST))
            first[own] = ids[starts[own]]
            later[own] = ids[starts[own] + lengths[own] - size]
        return first, later

    def one(self, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """One identifier of ``lengths`` bytes."""
        return _combine(*self.cover(starts, lengths), 8)


def _smallest(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    rest = width - size
    return np.minimum(keys[: len(keys) - rest], keys[rest:]) if rest else keys


def anchors(data: np.ndarray, ends: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """Anchors of the texts that lie in ``data`` one after the other, ending at ``ends``.

    at: the anchor's place; low, high: how far before it the last and the first of its windows begin;
    core: the bucket of its 32 bytes; one, two: buckets that hold all its windows.
    """
    starts = np.concatenate([[0], ends[:-1]])
    counts = np.maximum(ends - starts - width + 1, 0)
    begin = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    if not len(begin):
        return {}
    buckets = Buckets(data)
    gram = buckets.by[GRAM][: len(data)]
    keys = (gram & ~_POSITION) | np.arange(len(data), dtype=np.uint64)
    at = (_smallest(keys, width - GRAM + 1)[begin] & _POSITION).astype(np.int64)
    edge = np.flatnonzero(np.diff(at)) + 1
    first, last = begin[np.concatenate([[0], edge])], begin[np.concatenate([edge - 1, [len(begin) - 1]])]
    at = at[np.concatenate([[0], edge])]
    one, two = buckets.cover(first, last - first + width)
    return {"at": at, "low": at - last, "high": at - first, "core": gram[at], "one": one, "two": two}


def _pieces(column: pa.BinaryArray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, int, int]]:
    """(bytes, ends, row, offset): whole texts of about ``CHUNK`` bytes, or one piece of a long text.

    Pieces of a text overlap by a window less one byte, so that every window is in one of them.
    """
    rows = len(column)
    if not rows:
        return
    _, offsets, data = column.buffers()
    places = np.frombuffer(offsets, np.int32)[column.offset : column.offset + rows + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < rows:
        end = max(row + 1, int(np.searchsorted(places, places[row] + CHUNK, "right")) - 1)
        own = whole[places[row] : places[end]]
        if len(own) <= 2 * CHUNK:
            yield own, places[row + 1 : end + 1] - places[row], row, 0
        else:  # a single long text
            for begin in range(0, len(own), CHUNK):
                piece = own[begin : begin + CHUNK + width - 1]
                yield piece, np.array([len(piece)]), row, begin
        row = end


ROW = "mark bigint, at int, low smallint, high smallint, cell smallint, core bigint, one bigint, two bigint"
PART = "mark bigint, at int, low smallint, high smallint, cell smallint, size smallint, piece binary"


def _columns(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _read_anchors(texts: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = batch.column(0).to_numpy(zero_copy_only=False)
            for data, ends, row, offset in _pieces(batch.column(1), width):
                found = anchors(data, ends, width)
                if not found:
                    continue
                text = np.searchsorted(ends, found["at"], "right")
                shift = np.concatenate([[0], ends[:-1]])[text] - offset
                arrays = [pa.array(marks[row + text]), pa.array((found["at"] - shift).astype(np.int32))]
                arrays += [pa.array(found[c].astype(np.int16)) for c in ("low", "high")]
                arrays += [pa.array(np.zeros(len(text), np.int16))]
                arrays += [pa.array(found[c].view(np.int64)) for c in ("core", "one", "two")]
                yield pa.RecordBatch.from_arrays(arrays, names=_columns(ROW))

    return texts.mapInArrow(tidied(run), ROW)


def _cut_out(texts: DataFrame, width: int) -> DataFrame:
    """Parts from (mark, text, places): the bytes that the windows of each place cover."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                mark, text = batch.column(0)[row].as_py(), batch.column(1)[row].as_buffer()
                places = batch.column(2)[row].as_py()
                for begin in range(0, len(places), 5000):
                    own = [(p["at"], p["low"], p["high"]) for p in places[begin : begin + 5000]]
                    at, low, high = zip(*own, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([mark] * len(own), pa.int64()),
                            pa.array(at, pa.int32()),
                            pa.array(low, pa.int16()),
                            pa.array(high, pa.int16()),
                            pa.array([0] * len(own), pa.int16()),
                            pa.array([width - GRAM + 1] * len(own), pa.int16()),
                            pa.array([text[a - h : a - w + width].to_pybytes() for a, w, h in own], pa.binary()),
                        ],
                        names=_columns(PART),
                    )

    return texts.mapInArrow(tidied(run), PART)


def _halves(parts: DataFrame, width: int) -> DataFrame:
    """The two halves of each part that hold windows, with the buckets of the bytes that a half's
    windows have in common and of all its bytes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, PARTS):
                batch = whole.slice(begin, PARTS)
                mark, at, low, high, cell, size = (
                    batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(6)
                )
                bytes_ = [p.as_buffer() for p in batch.column(6)]
                data = np.frombuffer(b"".join(bytes_), np.uint8)
                buckets = Buckets(data)
                origin = np.cumsum([0] + [len(p) for p in bytes_[:-1]])
                half = (size + 1) // 2
                for from_, count in ((cell, half), (cell + half, size - half)):
                    to = from_ + count - 1
                    least, most = np.maximum(low, from_), np.minimum(high, to)
                    own = np.flatnonzero(least <= most)
                    if not len(own):
                        continue
                    least, most, upto, start = least[own], most[own], to[own], from_[own]
                    base = origin[own] + high[own]
                    core = buckets.one(base - start, start - upto + width)
                    one, two = buckets.cover(base - most, most - least + width)
                    cuts = zip(own, high[own] - most, high[own] - least + width, strict=True)
                    kept = [bytes_[i][int(a) : int(b)].to_pybytes() for i, a, b in cuts]
                    shorts = (x.astype(np.int16) for x in (least, most, start))
                    arrays = [pa.array(mark[own]), pa.array(at[own].astype(np.int32)), *map(pa.array, shorts)]
                    arrays += [pa.array(x.view(np.int64)) for x in (core, one, two)]
                    arrays += [pa.array(count[own].astype(np.int16)), pa.array(kept, pa.binary())]
                    yield pa.RecordBatch.from_arrays(arrays, names=[*_columns(ROW), "size", "piece"])

    return parts.mapInArrow(tidied(run), f"{ROW}, size smallint, piece binary")


def _settle(rows: DataFrame, *carried: str) -> tuple[DataFrame, str] | None:
    """Rows that share their bucket: ``shared`` if the whole run is found elsewhere, ``open`` if the
    row is the one of its kind that has to be refined; rows that are neither are left out.

    At most ``HOT_BUCKETS`` buckets can hold more than that part of all rows: their list is
    broadcast, and their rows meet what is known of the bucket under ``SPREAD`` salts.
    """
    spark, bucket, kind = rows.sparkSession, ["cell", "core"], ["low", "high", "one", "two"]
    look = F.xxhash64(*kind)
    several = rows.groupBy(*bucket).agg(
        F.count(F.lit(1)).alias("n"), (F.min(look) != F.max(look)).alias("mixed")
    )
    several, several_path = materialize(several.filter("n > 1"), "buckets")
    total = several.agg(F.sum("n")).first()[0]
    if total is None:
        discard(spark, several_path)
        return None
    hot = F.col("n") > max(HOT_ROWS, total // HOT_BUCKETS)

    def salts(is_hot: Column) -> Column:
        return F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(SPREAD - 1))).otherwise(F.array(F.lit(-1))))

    own = rows.withColumn("own", F.xxhash64("mark", "at"))
    salted = own.join(F.broadcast(several.filter(hot).select(*bucket, F.lit(True).alias("hot"))), bucket, "left")
    salted = salted.withColumn("salt", F.when(F.col("hot"), F.pmod("own", F.lit(SPREAD)).cast("int")).otherwise(-1))
    slots = several.select(*bucket, "mixed", salts(hot).alias("salt"))
    kept, kept_path = materialize(salted.drop("hot").join(slots, [*bucket, "salt"]), "kept")

    twins = kept.groupBy(*bucket, *kind).agg(
        F.count(F.lit(1)).alias("places"), F.min("own").alias("chosen"), F.max("salt").alias("top")
    )
    twins = twins.filter("places > 1").select(*bucket, *kind, "chosen", salts(F.col("top") >= 0).alias("salt"))
    shared = F.col("chosen").isNotNull()
    goes_on = F.col("mixed") & (F.col("chosen").isNull() | (F.col("own") == F.col("chosen")))
    placed = (
        kept.join(twins, [*bucket, *kind, "salt"], "left")
        .withColumn("shared", shared)
        .withColumn("open", goes_on)
        .filter("shared or open")
        .select(
            "mark", "at", "low", "high", "cell", "shared", "open",
            *[F.when(F.col("open"), F.col(c)).alias(c) for c in carried],
        )
    )
    found = materialize(placed, "placed")
    discard(spark, several_path, kept_path)
    return found


def merged(spans: np.ndarray) -> np.ndarray:
    """Maximal runs that half-open spans cover; touching spans are one."""
    if not len(spans):
        return spans.reshape(0, 2)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    fresh = np.concatenate([[True], spans[1:, 0] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(fresh)[1:] - 1, [len(spans) - 1]])
    return np.stack([spans[fresh, 0], reach[last]], axis=1)


def repeated_spans(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """(mark, a, b): half-open byte ranges that windows found elsewhere cover, for (mark, text).

    ``text`` is binary and never null, one row per mark; ranges may overlap and come out repeatedly.
    """
    spark = texts.sparkSession
    tables: list[DataFrame] = []
    paths: list[str] = []

    def add(placed: tuple[DataFrame, str]) -> DataFrame:
        rows, path = placed
        spans = rows.filter("shared").select(
            "mark", (F.col("at") - F.col("high")).alias("a"), (F.col("at") - F.col("low") + width).alias("b")
        )
        tables.append(spans)
        paths.append(path)
        return rows.filter("open")

    placed = _settle(_read_anchors(texts, width))
    if placed is not None:
        places = add(placed).groupBy("mark").agg(F.collect_list(F.struct("at", "low", "high")).alias("places"))
        parts, last = materialize(_cut_out(texts.join(places, "mark").select("mark", "text", "places"), width), "parts")
        for step in range((width - GRAM).bit_length()):
            halves, halves_path = materialize(_halves(parts.select(*_columns(PART)), width), "halves")
            if step == 0:
                discard(spark, last)
            placed = _settle(halves, "size", "piece")
            discard(spark, halves_path)
            if placed is None:
                break
            parts = add(placed)
            if parts.isEmpty():
                break
    if not tables:
        return spark.createDataFrame([], "mark bigint, a int, b int")
    every = tables[0]
    for rows in tables[1:]:
        every = every.unionByName(rows)
    found, _ = materialize(every, "spans")
    discard(spark, *paths)
    return found


def _per_text(docs: DataFrame, text: str, width: int, run, schema: str) -> tuple[DataFrame, Column]:
    """What ``run`` makes of (mark, text, n, spans), one row per distinct text, and the mark of a row of
    ``docs``: of equal texts one is looked at."""
    spark = docs.sparkSession
    content = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    mark = F.xxhash64(content)
    rows = docs.select(mark.alias("mark"), content.alias("text"))
    distinct = rows.groupBy("mark").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("n"))
    texts, texts_path = materialize(distinct, "texts")
    spans = repeated_spans(texts.filter(F.length("text") >= width).select("mark", "text"), width)
    lists = spans.groupBy("mark").agg(F.collect_set(F.struct("a", "b")).alias("spans"))
    ready = texts.join(lists, "mark", "left").select("mark", "text", "n", "spans")
    found, _ = materialize(ready.mapInArrow(tidied(run), schema), "per_text")
    discard(spark, texts_path)
    return found, mark


def _removed(batch: pa.RecordBatch, at: int, size: int, width: int) -> np.ndarray:
    if batch.column(2)[at].as_py() > 1 and size >= width:
        return np.array([[0, size]])
    values = batch.column(3)[at].as_py() or []
    return merged(np.array([(s["a"], s["b"]) for s in values], np.int64).reshape(-1, 2))


def _kept(data: bytes, runs: np.ndarray) -> bytes:
    edges = np.concatenate([[0], runs.ravel(), [len(data)]]).astype(np.int64)
    return b"".join(data[a:b] for a, b in edges.reshape(-1, 2).tolist())


def _attach(docs: DataFrame, key: str, mark: Column, found: DataFrame, names: list[str]) -> DataFrame:
    (own,) = internal(found.withColumn(key, F.lit(0)), "text_mark")
    rows = docs.select(key, mark.alias(own))
    # The salt need not tell rows apart, only spread those of one text.
    return attach_by_key(rows, found.withColumnRenamed("mark", own), own, [key], SPREAD).select(key, *names)


def removals(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs``: key, n_bytes, n_removed, n_spans, kept_sha256.

    Every byte goes that a string of ``width`` bytes (128 to 256) covers which starts anywhere else,
    in the same text or another; matches lie within one text. Overlaps count, and strings are judged on
    the input. A null text is empty; repeated rows are places of their own, so all but short ones lose
    everything. An empty table gives an empty result; other columns are not read.
    """
    if not 128 <= width <= 256:
        raise ValueError("width must be from 128 to 256 bytes")
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for at in range(batch.num_rows):
                data = batch.column(1)[at].as_py()
                runs = _removed(batch, at, len(data), width)
                kept = _kept(data, runs)
                rows.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
            if rows:
                columns = [pa.array(c) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["mark", *names])

    schema = "mark bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    found, mark = _per_text(docs, text, width, run, schema)
    return _attach(docs, key, mark, found, names)


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """key and kept: what is left of every text, as bytes; a cut may fall within a character."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for at in range(batch.num_rows):
                data = batch.column(1)[at].as_py()
                kept.append(_kept(data, _removed(batch, at, len(data), width)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary())], names=["mark", "kept"])

    found, mark = _per_text(docs, text, width, run, "mark bigint, kept binary")
    return _attach(docs, key, mark, found, ["kept"])
