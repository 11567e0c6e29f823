import base64
import collections
import hashlib
import io
import random

import pytest
import zstandard
from llm_cases import FOLDER

from tunedata.llm import warc
from tunedata.llm.common import scratch

SCHEMA = "page_id bigint, url string, html string, kind string, first string, salt string"


def pages():
    rows = [(i, f"http://x/{i}", f"<p>page {i % 40} é</p>" * (i % 7 + 1)) for i in range(120)]
    rows += [(200, None, None), (201, "u\r\nX: y", ""), (202, "http://é/ü", "x" * 2_000_000)]
    rows += [(203, "a", "twice"), (203, "a", "twice"), (None, "n", "page of nobody"), (None, None, "page of nobody")]
    rows += [(300 + i, "http://hot/", "hot") for i in range(150)]
    return [(*r, "a", "b", "c") for r in rows]


def check(rows, found):
    first, count = {}, collections.Counter()
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        key = base64.b32encode(hashlib.sha1(data).digest()).decode()
        known = first.get(key)
        first[key] = page if known is None else known if page is None else min(known, page)
        count[page, len(data), key] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest) for r in found) == count
    responses = collections.Counter(r.payload_digest for r in found if r.record_type == "response")
    assert responses == dict.fromkeys(first, 1)
    for row in found:
        if row.record_type == "response":
            assert row.page_id == first[row.payload_digest] and row.refers_to is None
        else:
            assert row.record_type == "revisit" and row.refers_to == first[row.payload_digest]


def test_round_trip_of_odd_pages(spark):
    rows = pages()
    found = warc.archive_pages(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    check(rows, found)


def test_round_trip_of_given_pages(spark):
    table = spark.read.parquet(f"{FOLDER}/pages.parquet")
    check(table.select("page_id", "url", "html").collect(), warc.archive_pages(table).collect())


def test_payloads_come_back(spark):
    rows = spark.createDataFrame(pages(), SCHEMA)
    folder = scratch(spark, "warc-test")
    manifest = spark.createDataFrame(warc.write_warc(rows, folder).collect(), "path string, records bigint")
    found = warc.read_warc(manifest).filter("record_type = 'response'").collect()
    html = {r[0]: (r[2] or "").encode() for r in pages()}
    assert all(bytes(r.payload) == html[r.page_id] for r in found if r.page_id is not None)


def test_files_follow_the_format(spark):
    """The bytes on disk are a dictionary frame and record frames, compressed once."""
    folder = scratch(spark, "warc-test")
    written = warc.write_warc(spark.createDataFrame(pages(), SCHEMA), folder).collect()
    for path, records in written:
        with open(path.removeprefix("file://"), "rb") as stream:
            data = stream.read()
        assert data[:4] == b"\x5d\x2a\x4d\x18" and len(read(data)) == records


def test_empty_table(spark):
    assert warc.archive_pages(spark.createDataFrame([], SCHEMA)).collect() == []


def test_least_payload(spark):
    rows = spark.createDataFrame([(i, "u", "ab", "", "", "") for i in range(4)], SCHEMA)
    folder = scratch(spark, "warc-test")
    manifest = spark.createDataFrame(warc.write_warc(rows, folder, least=3).collect(), "path string, records bigint")
    assert {r.record_type for r in warc.read_warc(manifest).collect()} == {"response"}


def archive(records, dictionary=b""):
    data = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    compressor = zstandard.ZstdCompressor(dict_data=data)
    return warc.skippable_frame(dictionary) + b"".join(compressor.compress(r) for r in records)


def record(block=b"hello", **changes):
    headers = {
        "WARC-Type": "response",
        "WARC-Record-ID": "<urn:uuid:1>",
        "WARC-Date": "2020-01-01T00:00:00Z",
        "WARC-Payload-Digest": "sha1:" + warc.payload_digest(block),
    }
    headers.update({k.replace("_", "-"): v for k, v in changes.items()})
    return warc.encode_record([(k, v) for k, v in headers.items() if v is not None], block)


def read(data):
    return list(warc.read_records(io.BytesIO(data)))


def test_reader_takes_trained_and_compressed_dictionaries():
    random.seed(1)
    samples = [record(f"<p>{random.random()} some shared text {i}</p>".encode() * 5) for i in range(200)]
    dictionary = warc.train_dictionary(samples)
    assert dictionary
    plain = archive(samples, dictionary)
    assert len(read(plain)) == 200
    packed = zstandard.ZstdCompressor().compress(dictionary)
    frames = plain[8 + len(dictionary) :]
    assert len(read(warc.skippable_frame(packed) + frames)) == 200


@pytest.mark.parametrize(
    "broken",
    [
        archive([record()])[4:],
        archive([record()])[:-3],
        b"",
        archive([record()[1:]]),
        archive([record(WARC_Date=None)]),
        archive([record(WARC_Payload_Digest="sha1:AAAA")]),
        archive([record() + b"x"]),
        archive([record()[:-2]]),
        archive([record().replace(b"Content-Length: 5", b"Content-Length: -5")]),
        archive([record().replace(b"Content-Length: 5", b"Content-Length: 5\r\nContent-Length: 5")]),
        archive([record().replace(b"WARC-Date:", b"WARC-Date")]),
        archive([record()]) + b"rubbish",
    ],
)
def test_reader_refuses(broken):
    with pytest.raises(warc.WarcError):
        read(broken)


def foreign(kind, block, *more):
    headers = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:uuid:{kind}>"), ("WARC-Date", "2021-01-01T00:00:00Z")]
    return warc.encode_record(headers + list(more), block)


def foreign_records():
    body = b"<p>found elsewhere</p>"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + body
    chunked = b"HTTP/1.1 404 Gone\r\nTransfer-Encoding: chunked\r\n\r\n4\r\n<p>f\r\n12;x=1\r\n"
    chunked += body[4:] + b"\r\n0\r\n\r\n"
    message = ("Content-Type", "application/http; msgtype=response")
    digest = ("WARC-Payload-Digest", "sha1:" + warc.payload_digest(body))
    return [
        foreign("warcinfo", b"software: other\r\n"),
        foreign("request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", ("Content-Type", "application/http")),
        foreign(
            "response", http, message, digest, ("WARC-Concurrent-To", "<a>"), ("WARC-Concurrent-To", "<b>"),
            ("WARC-Block-Digest", "sha256:" + hashlib.sha256(http).hexdigest()), ("WARC-Target-URI", "http://x/"),
        ),
        foreign("response", chunked, message, digest),
        foreign("response", chunked, message, ("WARC-Payload-Digest", "md5:" + hashlib.md5(chunked[49:]).hexdigest())),
        foreign("resource", body, ("Content-Type", "text/html")),
        foreign("revisit", b"", digest, ("WARC-Refers-To", "<urn:uuid:response>")),
        foreign("metadata", b"fetch: 3\r\n", ("X-Folded", "one\r\n two")),
        foreign("conversion", b"", ("WARC-Payload-Digest", "blake9:zz")),
    ]


@pytest.mark.parametrize("lead", [b"", warc.skippable_frame(b"")])
def test_archives_of_others(spark, tmp_path, lead):
    frames = [zstandard.ZstdCompressor().compress(r) for r in foreign_records()]
    other = b"\x50\x2a\x4d\x18\x03\x00\x00\x00abc"
    path = tmp_path / "other.warc.zst"
    path.write_bytes(lead + frames[0] + other + other + b"".join(frames[1:]) + other)
    found = warc.read_warc(spark.createDataFrame([(f"file://{path}", None)], "path string, records bigint")).collect()
    kinds = "warcinfo request response response response resource revisit metadata conversion"
    assert [r.record_type for r in found] == kinds.split()
    body = b"<p>found elsewhere</p>"
    assert [bytes(r.payload) for r in found[2:6]] == [body] * 4
    assert [r.http_status for r in found] == [None, None, 200, 404, 404, None, None, None, None]
    assert found[6].payload_bytes is None and found[6].refers_to_record == "<urn:uuid:response>"
    assert found[0].payload_digest is None and found[2].payload_digest == warc.payload_digest(body)
    headers = [h for h, _ in read(path.read_bytes())]
    assert headers[2]["warc-concurrent-to"] == "<a> <b>" and headers[7]["x-folded"] == "one two"


@pytest.mark.parametrize(
    "broken",
    [
        foreign("resource", b"x", ("WARC-Block-Digest", "sha1:AAAA")),
        foreign("response", b"HTTP/1.1 200 OK\r\n\r\nx", ("Content-Type", "application/http"),
                ("WARC-Payload-Digest", "md5:00")),
    ],
)
def test_wrong_digests_of_others(broken):
    with pytest.raises(warc.WarcError):
        read(archive([broken]))
