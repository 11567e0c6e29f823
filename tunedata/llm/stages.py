"""The stages of the corpus pipeline: (spark, docs, folder of the tables) -> rows that go on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunedata.llm.common import id_remainder, internal, table
from tunedata.llm.decontaminate import decontaminate
from tunedata.llm.language import identify, learn_dictionaries
from tunedata.llm.mixing import mix
from tunedata.llm.ngram_join import one_per_group
from tunedata.llm.queries import default_tokenizer
from tunedata.llm.token_files import tokenize


def language_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows whose language is told clearly, learned from rows with crc32(doc_id) mod 3 other than 1."""
    dictionaries = learn_dictionaries(docs.filter(id_remainder(3) != 1))
    names = internal(docs, "_lang_pred", "_lang_score", "_lang_accepted")
    found = identify(docs, dictionaries, names=tuple(names))
    return found.filter(F.col(names[2])).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near-duplicates, the row with the smallest id."""
    return one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Rows that contain no benchmark item."""
    return decontaminate(docs, table(spark, folder, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix: rows as often as taken, in the order of their finish times."""
    return mix(docs)


def token_stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token files of the mix, read back: one row per document of the files."""
    return tokenize(docs, default_tokenizer()).withColumnRenamed("key", "doc_id")
