"""Token ids in bit-packed binary files.

File: magic, version, bits per id, ids per block; the blocks, each padded to whole bytes; then the
byte offset of every block, the first id of every document, the document keys, and a trailer that
says where these begin. Any block can be read and unpacked by itself.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import uuid
import zlib
from collections.abc import Iterable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunedata.llm.common import open_shared, release_memory, scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAGIC = b"TKID"
HEADER = "<4sBBxxI"  # magic, version, bits, ids per block
TRAILER = "<QQQ4s"  # ids, documents, begin of the index, magic
BLOCK_IDS = 1 << 16
END_ID = 0
MEMO = 1_000_000
CHUNK = 4_000_000

MEMO_BYTES = 64  # longer segments are not remembered
MEMO_SIZE = 1 << 26  # bytes of all that are
TOGETHER = 4096  # segments encoded in one call

# Unicode's white space, as the byte-level pre-tokenizer knows it.
_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONE = re.compile(f" ?[^{_SPACE}]+")
_ASCII_SPACE = np.isin(np.arange(256), list(b"\t\n\x0b\x0c\r "))
_ASCII_LETTER = np.isin(np.arange(256), list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
_ASCII_MARK = (np.arange(256) > 0x20) & (np.arange(256) < 0x7F) & ~_ASCII_LETTER
_WIDE_SPACE = [int.from_bytes(chr(c).encode(), "big") for c in (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
_OTHER_SPACE = [0xC285, 0xC2A0]


def bits_for(vocabulary: int) -> int:
    """Least number of bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """Ids as consecutive little-endian fields of ``bits`` bits."""
    if len(ids) and int(ids.max()) >> bits:
        raise ValueError("an id does not fit")
    raw = ids.astype("<u4")
    if bits % 8 == 0:
        return raw.view(np.uint8).reshape(-1, 4)[:, : bits // 8].tobytes()
    planes = np.unpackbits(raw.view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
    return np.packbits(planes[:, :bits].ravel(), bitorder="little").tobytes()


def unpack(data: bytes, bits: int, count: int) -> np.ndarray:
    """The first ``count`` ids of a packed block, as uint32."""
    raw = np.frombuffer(data, np.uint8)
    out = np.zeros((count, 4), np.uint8)
    if bits % 8 == 0:
        out[:, : bits // 8] = raw[: count * bits // 8].reshape(count, bits // 8)
    else:
        planes = np.zeros((count, 32), np.uint8)
        planes[:, :bits] = np.unpackbits(raw, bitorder="little")[: count * bits].reshape(count, bits)
        out = np.packbits(planes, axis=1, bitorder="little")
    return out.reshape(-1).view("<u4")


class TokenWriter:
    """Writes one file; memory holds a block and the index of documents."""

    def __init__(self, out, bits: int, block_ids: int = BLOCK_IDS):
        self.out, self.bits, self.block_ids = out, bits, block_ids
        self.out.write(struct.pack(HEADER, MAGIC, 1, bits, block_ids))
        self.at = struct.calcsize(HEADER)
        self.offsets: list[int] = []
        self.starts: list[int] = []
        self.keys: list[int | None] = []
        self.ids = 0
        self.waiting: list[np.ndarray] = []
        self.waits = 0

    def add(self, key: int | None, ids: np.ndarray) -> None:
        self.keys.append(key)
        self.starts.append(self.ids)
        self.ids += len(ids)
        self.waiting.append(ids)
        self.waits += len(ids)
        if self.waits >= self.block_ids:
            joined = np.concatenate(self.waiting)
            whole = len(joined) - len(joined) % self.block_ids
            for begin in range(0, whole, self.block_ids):
                self._block(joined[begin : begin + self.block_ids])
            self.waiting, self.waits = [joined[whole:]], len(joined) - whole

    def _block(self, ids: np.ndarray) -> None:
        data = pack(ids, self.bits)
        self.offsets.append(self.at)
        self.out.write(data)
        self.at += len(data)

    def close(self) -> None:
        if self.waits:
            self._block(np.concatenate(self.waiting))
        known = np.array([k is not None for k in self.keys], np.uint8)
        keys = np.array([k or 0 for k in self.keys], "<i8")
        for part in (np.array(self.offsets, "<u8"), np.array(self.starts, "<u8"), keys, known):
            self.out.write(part.tobytes())
        self.out.write(struct.pack(TRAILER, self.ids, len(self.keys), self.at, MAGIC))


class TokenReader:
    """Random access to one file."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(0)
        magic, version, self.bits, self.block_ids = struct.unpack(HEADER, source.read(struct.calcsize(HEADER)))
        source.seek(size - struct.calcsize(TRAILER))
        self.ids, documents, index, end = struct.unpack(TRAILER, source.read(struct.calcsize(TRAILER)))
        if magic != MAGIC or end != MAGIC or version != 1:
            raise ValueError("not a token file")
        blocks = -(-self.ids // self.block_ids)
        source.seek(index)
        data = source.read(size - struct.calcsize(TRAILER) - index)
        if len(data) != blocks * 8 + documents * 17:
            raise ValueError("index cut short")
        self.offsets = np.append(np.frombuffer(data, "<u8", blocks), np.uint64(index))
        self.starts = np.append(np.frombuffer(data, "<u8", documents, blocks * 8), np.uint64(self.ids))
        keys = np.frombuffer(data, "<i8", documents, (blocks + documents) * 8)
        known = np.frombuffer(data, np.uint8, documents, (blocks + 2 * documents) * 8)
        self.keys = [k if there else None for k, there in zip(keys.tolist(), known.tolist(), strict=True)]

    def read(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count`` of the file, from the blocks that hold them."""
        if not count:
            return np.zeros(0, "<u4")
        first, last = start // self.block_ids, (start + count - 1) // self.block_ids
        self.source.seek(int(self.offsets[first]))
        data = self.source.read(int(self.offsets[last + 1] - self.offsets[first]))
        found = []
        for block in range(first, last + 1):
            begin = int(self.offsets[block] - self.offsets[first])
            ids = min(self.block_ids, self.ids - block * self.block_ids)
            end = int(self.offsets[block + 1] - self.offsets[first])
            found.append(unpack(data[begin:end], self.bits, ids))
        skip = start - first * self.block_ids
        return np.concatenate(found)[skip : skip + count]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """Key, first id and ids of every document; memory holds a few blocks and one document."""
        begin = 0
        while begin < len(self.keys):
            end = begin + 1
            limit = int(self.starts[begin]) + 16 * self.block_ids
            end = max(end, int(np.searchsorted(self.starts, limit, "right")) - 1)
            end = min(end, len(self.keys))
            at = int(self.starts[begin])
            ids = self.read(at, int(self.starts[end]) - at)
            for doc in range(begin, end):
                own = int(self.starts[doc])
                yield self.keys[doc], own, ids[own - at : int(self.starts[doc + 1]) - at]
            begin = end


def _begins(data: np.ndarray, starts: np.ndarray, at_marks: bool) -> np.ndarray:
    """Where segments begin in the bytes of texts that begin at ``starts``, and last the end.

    A segment begins with each text and at each step from non-space to ASCII space; where the character
    before is other white space there is no such step. With ``at_marks`` one begins also where an ASCII
    letter is followed by a digit or punctuation.
    """
    marks = np.zeros(len(data) + 1, bool)
    if at_marks:
        marks[1:-1] = _ASCII_LETTER[data[:-1]] & _ASCII_MARK[data[1:]]
    space = _ASCII_SPACE[data]
    steps = np.flatnonzero(space[1:] & ~space[:-1]) + 1
    marks[steps] = True
    wide = steps[data[steps - 1] >= 0x80].astype(np.int64)
    if len(wide):
        low = (data[wide - 2].astype(np.int32) << 8) | data[wide - 1]
        code = (data[np.maximum(wide - 3, 0)].astype(np.int32) << 16) | low
        marks[wide[np.isin(low, _OTHER_SPACE) | np.isin(code, _WIDE_SPACE)]] = False
    marks[starts] = True
    marks[len(data)] = True
    return np.flatnonzero(marks)


def _can_be_cut(spec: dict) -> bool:
    """Whether the tokenizer is one that never joins characters across the steps where segments begin."""
    before, model = spec.get("pre_tokenizer") or {}, spec["model"]
    return (
        spec.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and before.get("use_regex", True)
        and not before.get("add_prefix_space", True)
        and model.get("type") == "BPE"
        and not model.get("dropout")
        and not any(
            t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(f"[{_SPACE}]", t["content"])
            for t in spec.get("added_tokens", ())
        )
    )


def _pieces(segments: pa.Array, ids: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([segments, ids], names=["segment", "ids"])


class Encoder:
    """Byte-level BPE of whole texts by the tokenizers library, remembering what it has encoded.

    The tokenizer never joins characters across a step from non-space to space, or from a letter to a
    digit or punctuation outside its own special tokens, so texts are cut there. Of a batch each distinct
    segment (an Arrow dictionary tells) is looked up once; those not seen before are encoded many at a
    time, as lines of one text. Other tokenizers get whole texts. ``memo`` bounds the segments remembered,
    ``MEMO_SIZE`` their bytes: when either is reached, those not met since the last time are forgotten.
    They lie in Arrow arrays: as Python objects they would take several times their bytes.
    """

    def __init__(self, path: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        self.cuts = _can_be_cut(spec)
        self.special = [token["content"].encode() for token in spec.get("added_tokens", ())]
        self.memo = memo
        self.known = _pieces(pa.array([], pa.binary()), pa.array([], pa.list_(pa.uint32())))
        self.met = np.zeros(0, bool)
        self.newline = self._plain(["\n"])[0]

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(one.ids, "<u4") for one in found]

    def _encoded(self, segments: list[str]) -> pa.Array:
        """The ids of every segment, a list each."""
        lone: list[int] = []
        rest: list[int] = []
        for at, segment in enumerate(segments):
            (lone if _LONE.fullmatch(segment) else rest).append(at)
        order: list[int] = []
        counts, found = [np.zeros(1, np.int64)], []
        for begin in range(0, len(lone), TOGETHER):
            group = lone[begin : begin + TOGETHER]
            (ids,) = self._plain(["\n".join([segments[at] for at in group])])
            line_end = ids == self.newline[0]
            ends = np.flatnonzero(line_end)
            if len(self.newline) != 1 or len(ends) != len(group) - 1:  # a line end was joined with its neighbour
                rest += group
                continue
            order += group
            counts.append(np.diff(ends, prepend=-1, append=len(ids)) - 1)
            found.append(ids[~line_end])
        for begin in range(0, len(rest), TOGETHER):
            group = rest[begin : begin + TOGETHER]
            own = self._plain([segments[at] for at in group])
            order += group
            counts.append(np.array([len(ids) for ids in own]))
            found += own
        ends = np.cumsum(np.concatenate(counts)).astype(np.int32)
        return pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found))).take(pa.array(np.argsort(order)))

    def _remember(self, pieces: pa.RecordBatch, met: np.ndarray) -> None:
        """Keep ``pieces``; ``met`` says which of them were met since some were last forgotten."""
        lengths = pc.binary_length(pieces.column(0)).to_numpy()
        sizes = lengths + 4 * pc.list_value_length(pieces.column(1)).to_numpy().astype(np.int64) + 9
        keep = lengths <= MEMO_BYTES
        if keep.sum() > self.memo or sizes[keep].sum() > MEMO_SIZE:
            keep &= met
            met = np.zeros(len(met), bool)
            # Of what was met, the latest, up to half of either bound.
            later = np.cumsum(np.where(keep, sizes, 0)[::-1])[::-1]
            keep &= (np.cumsum(keep[::-1])[::-1] <= self.memo // 2) & (later <= MEMO_SIZE // 2)
        self.known, self.met = pieces if keep.all() else pieces.filter(pa.array(keep)), met[keep]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return self.encode_column(pa.array(texts, pa.string()))

    def encode_column(self, texts: pa.StringArray) -> list[np.ndarray]:
        """The ids of every text of a column without nulls."""
        if not self.cuts:
            return self._plain(texts.to_pylist())
        _, places, content = texts.buffers()
        if not len(texts) or content is None:
            return [np.zeros(0, "<u4")] * len(texts)
        places = np.frombuffer(places, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(content, np.uint8)[places[0] : places[-1]]
        if not len(data):
            return [np.zeros(0, "<u4")] * len(texts)
        places = places - places[0]
        raw = data.tobytes()
        begins = _begins(data, places, not any(token in raw for token in self.special))
        cut = pa.Array.from_buffers(
            pa.binary(), len(begins) - 1, [None, pa.py_buffer(begins.astype(np.int32)), pa.py_buffer(data)]
        ).dictionary_encode()
        pieces = self.known
        at = pc.fill_null(pc.index_in(cut.dictionary, pieces.column(0)), -1).to_numpy().copy()
        missing = np.flatnonzero(at < 0)
        if len(missing):
            at[missing] = np.arange(len(pieces), len(pieces) + len(missing))
            segments = cut.dictionary.take(pa.array(missing))
            new = _pieces(segments, self._encoded([segment.decode() for segment in segments.to_pylist()]))
            pieces = _pieces(*(pa.concat_arrays([pieces.column(i), new.column(i)]) for i in range(2)))
        met = np.zeros(len(pieces), bool)
        met[: len(self.met)] = self.met
        met[at] = True
        found = pieces.column(1).take(pa.array(at).take(cut.indices))
        self._remember(pieces, met)
        ids = found.flatten().to_numpy()
        bounds = found.offsets.to_numpy()[np.searchsorted(begins, places)]
        return [ids[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def _worker_encoder(path: str) -> Encoder:
    """The encoder of this Python worker: Spark keeps workers, so what one task learned serves the next."""
    held = sys.modules.setdefault("_tunedata_encoders", ModuleType("_tunedata_encoders")).__dict__
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list, pa.StringArray]]:
    """Keys and texts, about ``CHUNK`` bytes at a time; a longer text comes alone."""
    for batch in batches:
        texts = batch.column(1).cast(pa.string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        begin = 0
        while begin < len(texts):
            before = int(ends[begin - 1]) if begin else 0
            end = max(begin + 1, int(np.searchsorted(ends, before + CHUNK, "right")))
            yield batch.column(0).slice(begin, end - begin).to_pylist(), texts.slice(begin, end - begin)
            begin = end


MANIFEST = "part int, path string, ids bigint, documents bigint"


def write_tokens(
    docs: DataFrame,
    folder: str,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> DataFrame:
    """Encode every whole text, append ``end_id`` and write files in ascending key order.

    One row per file: part (files in ascending order), path, ids, documents. ``tokenizer`` is the
    path of a tokenizers JSON file on every machine. A null text is the empty text, a null key comes
    first, rows with equal keys follow in the order of their texts. An empty table gives no files.
    Texts are range-partitioned by key; each task writes its range as one file under a name of its
    own, and only files that the manifest lists are read.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("key", F.xxhash64("text")).sortWithinPartitions(
        "key", F.xxhash64("text"), "text"
    )

    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = writer = None
        for keys, texts in _chunks(batches):
            if writer is None:
                encoder = _worker_encoder(tokenizer)
                bits = bits_for(encoder.tokenizer.get_vocab_size())
                part = TaskContext.get().partitionId()
                path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tok"
                where, inner = open_shared(path)
                where.create_dir(inner.rpartition("/")[0], recursive=True)
                out = where.open_output_stream(inner)
                writer = TokenWriter(out, bits, block_ids)
            for one, ids in zip(keys, encoder.encode_column(texts), strict=True):
                writer.add(one, np.append(ids, np.uint32(end_id)))
            release_memory()  # the encoder stays for the worker's next task, what a chunk took does not
        if writer is not None:
            writer.close()
            out.close()
            found = {"part": [part], "path": [path], "ids": [writer.ids], "documents": [len(writer.keys)]}
            yield pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), *[pa.array(found[c]) for c in ("path", "ids", "documents")]],
                names=list(found),
            )

    return ordered.mapInArrow(write, MANIFEST)


def read_tokens(manifest: DataFrame, with_ids: bool = False) -> DataFrame:
    """One row per document of the listed files: key, start, n_tokens, ids_crc32, and ids if asked.

    ``start`` counts the ids of all documents before it, over all files in their order.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset"))
    kinds = {"key": pa.int64(), "start": pa.int64(), "n_tokens": pa.int64(), "ids_crc32": pa.int64()}
    if with_ids:
        kinds["ids"] = pa.list_(pa.int64())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=list(kinds))

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for listed in batches:
            for path, offset in zip(*(listed.column(c).to_pylist() for c in ("path", "offset")), strict=True):
                where, inner = open_shared(path)
                rows: list[tuple] = []
                with where.open_input_file(inner) as source:
                    for key, start, ids in TokenReader(source, source.size()).documents():
                        row = (key, offset + start, len(ids), zlib.crc32(np.ascontiguousarray(ids)))
                        rows.append((*row, ids.tolist()) if with_ids else row)
                        if len(rows) >= 5000:
                            yield batch(rows)
                            rows = []
                if rows:
                    yield batch(rows)

    schema = "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    # A given number of tasks: AQE would merge the few small rows of a manifest into one task that reads all files.
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInArrow(read, schema + ", ids array<bigint>" * with_ids)


def tokenize(docs: DataFrame, tokenizer: str, folder: str | None = None, **options) -> DataFrame:
    """Write the token files and read them back; ``folder`` defaults to a scratch folder."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "tokens")
    write_tokens(docs, f"{folder}/files", tokenizer, **options).write.parquet(f"{folder}/manifest")
    return read_tokens(spark.read.schema(MANIFEST).parquet(f"{folder}/manifest"))
