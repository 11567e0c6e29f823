"""Rows that every operator must stand: nulls, empty and long texts, repeats, clashing columns."""

import zlib

import duckdb

FOLDER = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "key string, size string, mark string, n string, _row string, sha string, kept string"
)
CLASH = ("k", "s", "m", "n", "r", "h", "p")


def given(table="documents", columns="doc_id, text, lang, source"):
    return duckdb.sql(f"SELECT {columns} FROM '{FOLDER}/{table}.parquet' ORDER BY 1").fetchall()


def documents():
    """Given rows, edited copies of them, and odd ones."""
    rows = given()[:80]
    words = rows[3][1].split()
    long_text = " ".join(f"{w}{i % 977}" for i, w in enumerate(words * 60))
    more = [
        (1001, None, "en", "src0"),
        (1002, "", "en", None),
        (1003, " \t\n", None, "src1"),
        (1004, "a", None, None),
        (1005, "one two three four", "en", "src1"),
        (1006, "ONE two\tthree\x0bfour", "en", "src1"),
        (1007, long_text, "fr", "src2"),
        (1008, long_text + " and one more", "fr", "src2"),
        (1009, "12 34 -- 56", "de", "src2"),
        (1010, "é ü   ß 日本 語", "de", "src3"),
        (1010, "é ü   ß 日本 語", "de", "src3"),
        (None, "a text without an id " * 20, "en", "src3"),
        (None, "a text without an id " * 20, "en", "src3"),
        (1011, "ab" * 400, "en", "src4"),
        (1012, None, None, None),
    ]
    for n, row in enumerate(rows[:12]):
        own = row[1].split(" ")
        own[len(own) // 2] = "changed"
        more.append((2000 + n, " ".join(own), row[2], row[3]))
        more.append((3000 + n, row[1], row[2], "other"))
    return [(*r, len(r[1] or ""), *CLASH) for r in rows + more]


def frame(spark, rows=None, parts=5):
    rows = documents() if rows is None else rows
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def remainder(doc_id, divisor):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % divisor


def write_tables(spark, folder, rows=None):
    """A folder of tables with the odd rows, for the registered queries."""
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    for name in ("benchmark", "labels", "pages", "conversations", "embeddings"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)
