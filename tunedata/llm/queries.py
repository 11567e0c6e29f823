"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunedata.llm.common import id_remainder, materialize, table
from tunedata.llm.decontaminate import contaminations
from tunedata.llm.exact_dedup import duplicate_groups
from tunedata.llm.language import identify, learn_dictionaries
from tunedata.llm.lm import score
from tunedata.llm.mixing import mixed_sizes
from tunedata.llm.ngram_join import linked
from tunedata.llm.prefix_trie import rebuilt_prefixes
from tunedata.llm.quality import fit, with_scores, with_statistics
from tunedata.llm.sharding import sharded_documents
from tunedata.llm.substrings import removals
from tunedata.llm.token_files import tokenize
from tunedata.llm.warc import archive_pages
from tunedata.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def default_tokenizer() -> str:
    """Path of the public byte-level vocabulary, on this machine as on all executors."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_warc(spark: SparkSession, folder: str) -> DataFrame:
    return archive_pages(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return duplicate_groups(table(spark, folder, "documents"))


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows, _ = materialize(
        with_statistics(docs.withColumn("held_out", id_remainder(4) == 2)), "statistics"
    )
    # A fifth of the training rows calibrates; the fold depends on another hash than the hold-out.
    labels = (
        table(spark, folder, "labels")
        .filter(F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").alias("labelled_id"))
        .agg(F.avg("quality").alias("label"))
    )
    labelled = (
        rows.filter(~F.col("held_out"))
        .join(labels, F.col("doc_id") == F.col("labelled_id"))
        .select("statistics", "label", (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("fold"))
    )
    training, _ = materialize(labelled, "labelled")
    scored = with_scores(rows, fit(training), "statistics", "score")
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return removals(table(spark, folder, "documents"))


def op5_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return linked(table(spark, folder, "documents"))


def op6_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixed_sizes(table(spark, folder, "documents"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    dictionaries = learn_dictionaries(docs.filter(id_remainder(3) != 1))
    found = identify(
        docs.select("doc_id", "text", (id_remainder(3) == 1).alias("held_out")),
        dictionaries,
        names=("lang_pred", "score", "accepted"),
    )
    return found.select("doc_id", "held_out", "lang_pred", "score", "accepted")


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return tokenize(table(spark, folder, "documents"), default_tokenizer()).withColumnRenamed(
        "key", "doc_id"
    )


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminations(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return score(table(spark, folder, "documents"), id_remainder(7) == 2)


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return rebuilt_prefixes(table(spark, folder, "conversations"))


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharded_documents(table(spark, folder, "documents"))


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(table(spark, folder, "embeddings"))


_QUERIES: dict[str, Query] = {
    build.__name__: build
    for build in (
        op1_warc,
        op2_exact_dedup,
        op3_quality,
        op4_substring_dedup,
        op5_ngram_join,
        op6_mixing,
        op7_language,
        op8_token_files,
        op9_decontamination,
        op10_lm_scoring,
        op11_prefix_trie,
        op12_sharding,
        op13_whitening,
    )
}


def llm_queries() -> dict[str, Query]:
    return dict(_QUERIES)


_WORDS = r"CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT)"

_ORACLES: dict[str, str] = {
    "op2_exact_dedup": """
WITH t AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, text_sha256
FROM t WINDOW g AS (PARTITION BY text_sha256)""",
    "op6_mixing": rf"""
WITH d AS (SELECT doc_id, source, {_WORDS} AS size, md5(coalesce(CAST(doc_id AS VARCHAR), text, '')) AS place
           FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             row_number() OVER (ORDER BY source NULLS LAST) AS turn FROM d GROUP BY source),
w AS (SELECT *, CASE turn % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS weight FROM s),
x AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))
                / CAST(sum(weight) OVER after AS DOUBLE) AS split
      FROM w WINDOW before AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    after AS (ORDER BY CAST(source_size AS DOUBLE) / weight, source NULLS LAST
                              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
l AS (SELECT *, max(split) OVER () AS level FROM x),
c AS (SELECT d.doc_id, d.size, l.source_size, l.turn, 10 // l.weight AS pace,
             least(CAST(3 * l.source_size AS DOUBLE), l.weight * l.level) AS target,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place, d.doc_id, d.size
                               ROWS UNBOUNDED PRECEDING) AS served
      FROM d JOIN l ON d.source IS NOT DISTINCT FROM l.source),
k AS (SELECT size, turn, (served + unnest([0, 1, 2]) * source_size) * pace AS finish FROM c WHERE size > 0),
m AS (SELECT finish, turn, sum(size) OVER (ORDER BY finish, turn ROWS UNBOUNDED PRECEDING) AS spent FROM k),
e AS (SELECT min(finish * 1000000 + turn) AS first_out FROM m WHERE spent > (SELECT sum(size) FROM d))
SELECT doc_id, size, source_size, target,
       CAST(size * (CAST(served * pace * 1000000 + turn < first_out AS INT)
                  + CAST((served + source_size) * pace * 1000000 + turn < first_out AS INT)
                  + CAST((served + 2 * source_size) * pace * 1000000 + turn < first_out AS INT)) AS BIGINT) AS taken
FROM c, e""",
}


def llm_oracles() -> dict[str, str]:
    return dict(_ORACLES)
