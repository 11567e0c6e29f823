"""JSON-lines sources: one that tolerates bad lines and one that does not."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunedata.functions.text import is_blank, strip
from tunedata.sources.sinks import MANIFEST, read_manifest

# Workers receive these functions by value: the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Where a line comes from: its file, the byte at which the scan's block of that file begins, and the
# number of the line in the block, from 1. In a file's first block that is the line's number in the
# file; the lines of any other block are those that start after its first byte.
PLACE = ("_file", "_block", "_line")

MESSAGE = T.StructType(
    [T.StructField("role", T.StringType()), T.StructField("content", T.StringType())]
)


def _raw_record(text: T.DataType) -> T.StructType:
    # Fields that are never read (label, scores, execution, ...) are left out, so they are not parsed.
    return T.StructType(
        [
            T.StructField("id", T.StringType()),
            T.StructField("prompt", text),
            T.StructField("response", text),
            T.StructField("conversation", T.ArrayType(MESSAGE)),
        ]
    )


# A record as its line holds it, and as `decode_lines` gives it. Variants tell the text "false" from
# the value false; decoding turns them into texts.
RAW_LINE = _raw_record(T.VariantType())
RAW_RECORD = _raw_record(T.StringType())
SFT_RECORD = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("text", "prompt", "chosen")]
)
PREFERENCE_RECORD = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("prompt", "chosen", "rejected")]
)

# Python's json module rejects single quotes.
_STRICT = {"allowSingleQuotes": "false"}


def value_text(value: Column) -> Column:
    """A JSON value as text: a text as it is, and what Python holds for false - null, false, 0, an
    empty list or object - as the empty text. Other values become their JSON text."""
    text = value.cast("string")
    nothing = text.isin("false", "[]", "{}") | F.coalesce(text.try_cast("double") == 0, F.lit(False))
    other = F.when(nothing, "").otherwise(text)
    return F.when(F.schema_of_variant(value) == "STRING", text).otherwise(other)


def decode_lines(
    lines: DataFrame, schema: T.StructType = RAW_LINE, value: str = "value", raw: str | None = None
) -> DataFrame:
    """Drop blank lines and decode the others: the schema's fields plus ``malformed``.

    Variant fields become texts (:func:`value_text`). With ``raw``, malformed lines are kept in a
    column of that name.

    A line must be exactly one JSON object. ``from_json`` alone ignores what follows the first
    object; read as the only element of an array, trailing text breaks the array and a second
    object makes it longer. Columns of ``lines`` other than ``value`` pass through.

    Fields are taken from the array by ``explode``: Spark moves filters on them below a
    projection, which would decode each line once more per use, but not below a generator.
    """
    others = [F.col(f"`{c}`") for c in lines.columns if c != value]
    line = F.concat(F.lit("["), strip(value), F.lit("]"))
    found, one, bad = F.col("_found"), F.size("_found") == 1, F.col("_object").isNull()
    kept = [] if raw is None else [F.col(value).alias("_value")]
    fields = [
        (value_text(F.col("_object")[f.name]) if isinstance(f.dataType, T.VariantType) else F.col("_object")[f.name]).alias(f.name)
        for f in schema.fields
    ]
    return (
        lines.filter(~is_blank(value))
        .select(*others, *kept, F.from_json(line, T.ArrayType(schema), _STRICT).alias("_found"))
        .select(*others, *(["_value"] if kept else []), F.explode_outer(F.when(one, found)).alias("_object"))
        .select(*others, *fields, bad.alias("malformed"), *([F.when(bad, F.col("_value")).alias(raw)] if kept else []))
    )


@F.pandas_udf(T.LongType())
def _number_in_block(blocks: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Count the lines of each block from 1; a task reads a block's lines in order and together."""
    last, count = None, 0
    for batch in blocks:
        keys = batch.to_numpy()
        if not len(keys):
            yield pd.Series(keys, dtype="int64")
            continue
        starts = np.flatnonzero(np.concatenate([[keys[0] != last], keys[1:] != keys[:-1]]))
        begins = np.concatenate([[-count], starts]) if not len(starts) or starts[0] else starts
        ends = np.append(np.maximum(begins[1:], 0), len(keys))
        numbers = np.arange(1, len(keys) + 1) - np.repeat(begins, ends - np.maximum(begins, 0))
        last, count = keys[-1], int(numbers[-1])
        yield pd.Series(numbers)


# Not deterministic, lest Spark drop blank lines before they are counted.
_number_in_block = _number_in_block.asNondeterministic()


def located_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value`` of every line and its place: ``_file``, ``_block`` and ``_line``.

    Only a hash of file and block goes to the worker that counts; the line stays in the JVM. A plan
    that does not use ``_line`` does not count.
    """
    lines = spark.read.text(path)
    return lines.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        _number_in_block(F.xxhash64("_metadata.file_path", "_metadata.file_block_start")).alias("_line"),
    )


def read_jsonl_tolerant(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW_LINE,
    places: bool = False,
    raw: str | None = None,
) -> DataFrame:
    """Rows of ``schema`` plus ``malformed``; a bad line becomes a tagged row, not an error.

    With ``places`` a row also tells its file, block and line, and with ``raw`` a bad line its text.
    """
    lines = located_lines(spark, path) if places else spark.read.text(path)
    return decode_lines(lines, schema, raw=raw)


def _must(condition: Column, message: Column) -> Column:
    """True where ``condition`` holds; elsewhere the job fails."""
    return F.when(condition, True).otherwise(F.raise_error(message).cast("boolean"))


def read_jsonl(
    spark: SparkSession, path: str | list[str], schema: T.StructType, required: Sequence[str] = ()
) -> DataFrame:
    """Rows of ``schema``; a line that is not one JSON object fails the job.

    So does a row in which a ``required`` field is absent or null. The error names file and line.
    Partition columns of the path pass through.
    """
    rows = decode_lines(located_lines(spark, path), schema)
    place = F.concat(
        F.lit(" at line "),
        "_line",
        F.when(F.col("_block") > 0, F.concat(F.lit(" after byte "), "_block")).otherwise(""),
        F.lit(" of "),
        "_file",
    )
    rows = rows.filter(_must(~F.col("malformed"), F.concat(F.lit("Malformed JSON"), place)))
    for name in required:
        missing = F.concat(F.lit(f"required field {name} is missing"), place)
        rows = rows.filter(_must(F.col(name).isNotNull(), missing))
    return rows.drop("malformed", *PLACE)


def read_training_set(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """The ``sft`` or ``dpo`` rows below ``path``.

    A plain file, a folder of files, or the folder that ``write_training_sets`` made: there the
    manifest says which sets are complete, a kind without rows is no error, and a folder without a
    manifest, which a failed write leaves, is refused. Preference pairs must be complete.
    """
    record = {"sft": SFT_RECORD, "dpo": PREFERENCE_RECORD}[kind]
    required = record.names if kind == "dpo" else ()
    manifest = read_manifest(spark, path)
    if manifest is not None:
        written = manifest["sets"][kind]
        if not written["rows"]:
            return spark.createDataFrame([], record)
        path = f"{path.rstrip('/')}/{written['path']}"
    elif "kind" in spark.read.text(path).columns:
        raise ValueError(f"{path} has no {MANIFEST}: its training sets were not written to the end")
    return read_jsonl(spark, path, record, required).select(record.names)


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """``status, file, block, line, raw`` of the lines that preparation left out."""
    schema = "status string, file string, block bigint, line bigint, raw string"
    manifest = read_manifest(spark, path)
    if manifest is None or not manifest["sets"].get("quarantine", {}).get("rows"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(f"{path.rstrip('/')}/{manifest['sets']['quarantine']['path']}")
