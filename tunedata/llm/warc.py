"""WARC archives with Zstandard: one frame per record, dictionary in a leading skippable frame.

File layout, as in the public WARC-zstd convention: a skippable frame (magic 0x184D2A5D) holding
the dictionary, then one Zstandard frame per record. Each writing task trains the dictionary of
its own file on the first records it sees, a sample bounded in bytes.

The reader takes archives of others as well: files without a dictionary, other skippable frames in
between, all record types, HTTP messages (the payload is what follows the HTTP headers), folded and
repeated WARC-Concurrent-To headers, and digests by SHA-1, SHA-256 or MD5 in base32 or hex.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import sys
import uuid
from collections.abc import Iterable, Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tunedata.llm.common import open_shared, scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed values of the format.
SKIPPABLE_MAGIC = 0x184D2A5D
SKIPPABLE_FIRST = 0x184D2A50
SKIPPABLE_LAST = 0x184D2A5F
REPEATABLE = "warc-concurrent-to"
DIGESTS = ("sha1", "sha256", "md5")
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SAMPLE_BYTES = 4_000_000
DICTIONARY_BYTES = 64_000
LEVEL = 6
SPREAD = 1024
READ_BYTES = 1 << 20


class WarcError(ValueError):
    """An archive that breaks the format."""


def payload_digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str, kind: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}/{kind}')}>"


def encode_record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = [VERSION] + [f"{k}: {v}".encode() for k, v in headers]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def digest_agrees(stated: str, data: bytes) -> bool:
    """Whether ``algorithm:value`` is a digest of ``data``; unknown algorithms are not checked."""
    name, _, value = stated.partition(":")
    name = name.strip().lower().replace("-", "")
    if name not in DIGESTS:
        return True
    own = hashlib.new(name, data, usedforsecurity=False).digest()
    value = value.strip()
    return value.lower() == own.hex() or value.upper().rstrip("=") == base64.b32encode(own).decode().rstrip("=")


def _without_chunks(body: bytes) -> bytes | None:
    """The body of an HTTP message that was sent in chunks; None if it is not made of chunks."""
    parts, at = [], 0
    while True:
        line, found, _ = body[at : at + 1024].partition(b"\r\n")
        size = line.partition(b";")[0].strip()
        if not found or not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return None
        at += len(line) + 2
        if int(size, 16) == 0:
            return b"".join(parts)
        parts.append(body[at : at + int(size, 16)])
        at += int(size, 16)
        if body[at : at + 2] != b"\r\n":
            return None
        at += 2


def split_http(headers: dict[str, str], block: bytes) -> tuple[int | None, list[bytes]]:
    """HTTP status and the possible payloads of a block, the preferred one first.

    Archives differ in whether the digest of a message that was sent in chunks is that of its body
    with or without them, so both are given. A block that is no HTTP message is its own payload.
    """
    kind = headers.get("content-type", "").partition(";")[0].strip().lower()
    if kind != "application/http":
        return None, [block]
    end = re.search(rb"\r?\n\r?\n", block)
    head, body = (block[: end.start()], block[end.end() :]) if end else (block, b"")
    first = re.match(rb"HTTP/[0-9.]+ +([0-9]{3})", head)
    status = int(first[1]) if first else None
    if re.search(rb"(?im)^transfer-encoding:.*chunked", head):
        plain = _without_chunks(body)
        if plain is not None:
            return status, [plain, body]
    return status, [body]


def decode_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of one record; raises WarcError.

    Values of the one header that may be repeated are joined by blanks. Lengths and digests are
    checked, but for payloads that are not here (revisits) or not whole (WARC-Truncated).
    """
    head, found, rest = data.partition(b"\r\n\r\n")
    if not found:
        raise WarcError("no end of headers")
    first, *lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[01]", first):
        raise WarcError("no version line")
    headers: dict[str, str] = {}
    unfolded: list[bytes] = []
    for line in lines:
        if line[:1] in (b" ", b"\t") and unfolded:
            unfolded[-1] += b" " + line.strip()
        else:
            unfolded.append(line)
    for line in unfolded:
        name, found, value = line.partition(b":")
        if not found or not name or name != name.strip():
            raise WarcError("malformed header line")
        try:
            key = name.decode("ascii").lower()
            if key in headers and key != REPEATABLE:
                raise WarcError(f"repeated header {key}")
            own = value.strip().decode("utf-8")
            headers[key] = f"{headers[key]} {own}" if key in headers else own
        except UnicodeDecodeError as error:
            raise WarcError("undecodable header") from error
    for need in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if need not in headers:
            raise WarcError(f"missing header {need}")
    if not re.fullmatch(r"[0-9]+", headers["content-length"]):
        raise WarcError("malformed Content-Length")
    length = int(headers["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise WarcError("Content-Length does not match the record")
    block = rest[:length]
    if not digest_agrees(headers.get("warc-block-digest", ""), block):
        raise WarcError("block digest does not match")
    if headers["warc-type"] != "revisit" and "warc-truncated" not in headers:
        stated = headers.get("warc-payload-digest", "")
        if not any(digest_agrees(stated, payload) for payload in split_http(headers, block)[1]):
            raise WarcError("payload digest does not match")
    return headers, block


def train_dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for these records, or none where they are too few to train on."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def skippable_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE_MAGIC, len(dictionary)) + dictionary


def read_dictionary(stream: io.BufferedIOBase) -> tuple[bytes, bytes]:
    """The dictionary of the leading skippable frame (empty if the file begins with another frame),
    and what has been read beyond it."""
    head = stream.read(8)
    if len(head) != 8:
        raise WarcError("no frame")
    magic, size = struct.unpack("<II", head)
    if magic != SKIPPABLE_MAGIC:
        return b"", head
    dictionary = stream.read(size)
    if len(dictionary) != size:
        raise WarcError("dictionary cut short")
    if dictionary[:4] == b"\x28\xb5\x2f\xfd":  # the dictionary itself may be compressed
        dictionary = zstandard.ZstdDecompressor().decompressobj().decompress(dictionary)
    return dictionary, b""


def _after_skippable(stream: io.BufferedIOBase, rest: bytes) -> bytes:
    """``rest`` and what follows in the stream, without leading skippable frames."""
    while True:
        rest += stream.read(8 - len(rest)) if len(rest) < 8 else b""
        if len(rest) < 8:
            return rest
        magic, size = struct.unpack("<II", rest[:8])
        if not SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
            return rest
        rest = rest[8:]
        while size > len(rest):
            size -= len(rest)
            rest = stream.read(min(size, READ_BYTES))
            if not rest:
                raise WarcError("skippable frame cut short")
        rest = rest[size:]


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """All records of an archive, one frame at a time; memory holds one record."""
    dictionary, rest = read_dictionary(stream)
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    decompressor = zstandard.ZstdDecompressor(dict_data=data)
    while True:
        rest = _after_skippable(stream, rest or stream.read(READ_BYTES))
        if not rest:
            return
        frame, parts = decompressor.decompressobj(), []
        try:
            while not frame.eof:
                parts.append(frame.decompress(rest))
                rest = frame.unused_data if frame.eof else stream.read(READ_BYTES)
                if not rest and not frame.eof:
                    raise WarcError("frame cut short")
        except zstandard.ZstdError as error:
            raise WarcError(f"bad frame: {error}") from error
        yield decode_record(b"".join(parts))


def page_record(row: dict, date: str) -> bytes:
    """The record of one page row: page_id, url, payload, digest, size, first, kind."""
    headers = [
        ("WARC-Type", row["kind"]),
        ("WARC-Record-ID", record_id(row["page_id"], row["digest"], row["kind"])),
        ("WARC-Date", date),
        ("WARC-Payload-Digest", f"sha1:{row['digest']}"),
        ("X-Payload-Bytes", str(row["size"])),
    ]
    if row["page_id"] is not None:
        headers.append(("X-Page-Id", str(row["page_id"])))
    if row["url"]:
        headers.append(("WARC-Target-URI", quote(row["url"], safe=":/?#[]@!$&'()*+,;=%-._~")))
    if row["kind"] == "revisit":
        headers.append(("WARC-Profile", REVISIT_PROFILE))
        headers.append(("WARC-Refers-To", record_id(row["first"], row["digest"], "response")))
        if row["first"] is not None:
            headers.append(("X-Refers-To-Page", str(row["first"])))
        return encode_record(headers, b"")
    headers.append(("Content-Type", "text/html; charset=utf-8"))
    return encode_record(headers, row["payload"])


def _writer(folder: str, date: str, level: int):
    def write(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (page_record(row, date) for b in batches for row in _rows(b))
        sample, size = [], 0
        for record in records:
            sample.append(record)
            size += len(record)
            if size >= SAMPLE_BYTES:
                break
        if not sample:
            return
        # A name of its own for each attempt; only those that the manifest lists are read.
        path = f"{folder}/{uuid.uuid4().hex}.warc.zst"
        where, inner = open_shared(path)
        where.create_dir(inner.rpartition("/")[0], recursive=True)
        dictionary = train_dictionary(sample)
        data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        compressor = zstandard.ZstdCompressor(level=level, dict_data=data, write_checksum=True)
        count = 0
        with where.open_output_stream(inner, compression=None) as out:
            out.write(skippable_frame(dictionary))
            for part in (sample, records):
                for record in part:
                    out.write(compressor.compress(record))
                    count += 1
                sample.clear()
        yield pa.RecordBatch.from_pydict({"path": [path], "records": [count]})

    return write


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    for at in range(batch.num_rows):
        yield {name: batch.column(name)[at].as_py() for name in batch.schema.names}


def write_warc(
    pages: DataFrame,
    folder: str,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
    date: str = "1970-01-01T00:00:00Z",
    least: int = 0,
    level: int = LEVEL,
    spread: int = SPREAD,
) -> DataFrame:
    """Write one record per row into archives below ``folder``; the manifest: path, records.

    Of rows with equal payloads of ``least`` bytes or more, that with the smallest key becomes the
    response, others revisit it. A null payload is the empty one; null keys come last, and repeated
    rows give one response and revisits. A null url leaves its header out; other characters than a
    URI's are percent-encoded. An empty table gives an empty manifest and no archive. Other
    columns are not read.

    A digest may hold any share of the rows: sizes and keepers are partial aggregates, and rows
    meet them under (digest, salt), where the salt hashes the key.
    """
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(
        F.col(key).cast("bigint").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        payload.alias("payload"),
        F.unhex(F.sha1(payload)).alias("sha"),
        F.pmod(F.xxhash64(F.col(key)), F.lit(spread)).alias("salt"),
    )
    firsts = rows.groupBy("sha").agg(F.min("page_id").alias("first"))
    slots = rows.select("sha", "salt").distinct().join(firsts, "sha")
    twin = Window.partitionBy("sha", "salt", "page_id").orderBy("page_id")
    alone = F.length("payload") < least
    response = alone | (F.col("page_id").eqNullSafe(F.col("first")) & (F.col("turn") == 1))
    ready = (
        rows.join(slots, ["sha", "salt"])
        .withColumn("turn", F.row_number().over(twin))
        .withColumn("kind", F.when(response, "response").otherwise("revisit"))
        .select(
            "page_id",
            "url",
            F.when(F.col("kind") == "response", F.col("payload")).alias("payload"),
            F.hex("sha").alias("digest"),
            F.length("payload").cast("bigint").alias("size"),
            "first",
            "kind",
        )
    )
    return ready.mapInArrow(_with_base32(_writer(folder, date, level)), "path string, records bigint")


def _with_base32(write):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def converted() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = batch.schema.get_field_index("digest")
                names = [
                    base64.b32encode(bytes.fromhex(x)).decode() for x in batch.column(at).to_pylist()
                ]
                yield batch.set_column(at, "digest", pa.array(names, pa.string()))

        yield from write(converted())

    return run


RECORD = (
    "page_id bigint, url string, record_type string, payload binary, payload_bytes bigint, "
    "payload_digest string, refers_to bigint, record_id string, refers_to_record string, "
    "http_status int"
)


def _reader(with_payload: bool):
    def number(value: str | None) -> int | None:
        return None if value is None else int(value)

    def row(headers: dict[str, str], block: bytes) -> tuple:
        status, (payload, *_) = split_http(headers, block)
        stated = headers.get("warc-payload-digest")
        # A bare digest is SHA-1, others keep their names.
        digest = None if stated is None else stated.removeprefix("sha1:")
        size = number(headers.get("x-payload-bytes"))
        kind = headers["warc-type"]
        if kind == "response" and size is not None and size != len(payload):
            raise WarcError("payload length does not match")
        return (
            number(headers.get("x-page-id")),
            headers.get("warc-target-uri"),
            kind,
            payload if with_payload else None,
            (None if kind == "revisit" else len(payload)) if size is None else size,
            digest,
            number(headers.get("x-refers-to-page")),
            headers["warc-record-id"],
            headers.get("warc-refers-to"),
            status,
        )

    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.int64()]
    kinds += [pa.string(), pa.string(), pa.int32()]
    names = [part.split()[0] for part in RECORD.split(", ")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for listed in batches:
            counts = listed.column("records").to_pylist()
            for path, expected in zip(listed.column("path").to_pylist(), counts, strict=True):
                where, inner = open_shared(path)
                rows, size, seen = [], 0, 0
                with where.open_input_stream(inner, compression=None, buffer_size=READ_BYTES) as stream:
                    for headers, block in read_records(stream):
                        rows.append(row(headers, block))
                        seen += 1
                        size += len(block) if with_payload else 0
                        if len(rows) >= 5000 or size >= 16_000_000:
                            yield batch(rows)
                            rows, size = [], 0
                if expected is not None and seen != expected:
                    raise WarcError(f"{path}: {seen} records instead of {expected}")
                if rows:
                    yield batch(rows)

    return read


def read_warc(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of the archives that ``manifest`` lists (path, records; a null count is unknown).

    Each task streams its archives: dictionary first, then one frame per record. A broken frame,
    header, length, digest or record count fails the job. ``payload`` is what the record itself
    carries: what follows the HTTP headers of a message, the whole block of other records, as a rule
    nothing for a revisit. Records of all types are returned; what they do not state is null.
    """
    files = manifest.select("path", F.col("records").cast("bigint").alias("records"))
    # A given number of tasks: AQE would merge the few small rows of a manifest into one task that reads all archives.
    tasks = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(tasks, "path").mapInArrow(_reader(with_payload), RECORD)


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write ``pages`` as archives and read them back; ``folder`` defaults to a scratch folder."""
    spark: SparkSession = pages.sparkSession
    folder = folder or scratch(spark, "warc")
    manifest = f"{folder}/manifest"
    write_warc(pages, f"{folder}/archives").write.parquet(manifest)
    return read_warc(spark.read.schema("path string, records bigint").parquet(manifest), False)
