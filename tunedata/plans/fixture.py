"""Inputs of the registered queries, derived from the given tables.

The tables hold prose without fences or tags. The CASE below adds markup to every text; being
plain SQL, it gives the same texts in Spark and in the checking database, while the operators
under test are written separately on each side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunedata.sources.tables import read_table

EVENT_EPOCH = 1_700_000_000


def decorated_sql(pick: str, text: str = "text") -> str:
    """SQL text of a response: the whole ``text`` with markup, chosen by ``pick`` modulo 8.

    Code grows with the rows: most blocks carry the row's number, some are long, some are repeated,
    and every seventh holds the same block. Those that do not parse contain an open bracket.
    """
    name = f"concat('v', cast(({pick}) AS string))"
    valid = f"concat({name}, ' = 1', chr(10))"
    broken = f"concat({name}, ' = (', chr(10))"
    long = (
        f"concat('def f', {name}, '(a):', chr(10), repeat(concat('    a = a + 1', chr(10)), "
        f"cast(({pick}) % 97 AS int)), '    return a', chr(10))"
    )
    fenced = f"concat('```python', chr(10), {{}}, '```')"
    either = f"CASE WHEN ({pick}) % 7 = 0 THEN concat('x = 1', chr(10)) WHEN ({pick}) % 3 = 0 THEN {broken} ELSE {valid} END"
    return f"""CASE ({pick}) % 8
 WHEN 0 THEN {text}
 WHEN 1 THEN concat('<info>', {text}, '</info>', chr(10), '<python>', chr(10), {either}, '</python>')
 WHEN 2 THEN concat({text}, chr(10), '<PYTHON>', chr(10), {long}, '</Python>')
 WHEN 3 THEN concat('<info>', {text}, '</info>')
 WHEN 4 THEN concat('<info>short one</info>', chr(10), {text}, '<python>', chr(10), {broken}, '</python>')
 WHEN 5 THEN concat({text}, chr(10), {fenced.format(either)}, chr(10), 'done')
 WHEN 6 THEN concat({text}, chr(10), '```html', chr(10), '<p>hi</p>', chr(10), '```', chr(10), 'tail', chr(10),
                    {fenced.format(long)})
 ELSE concat('<info>', {text}, '</info> and <info>', {text}, '</info> <python>pass</python><python>y = (</python>')
END"""


RESPONSE_SQL = decorated_sql("conv_id * 7 + turn")
DOCUMENT_SQL = decorated_sql("doc_id * 7")
PAIR_SQL = decorated_sql("conv_id", "response")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, f"{folder}/{name}.parquet")


def responses(spark: SparkSession, folder: str) -> DataFrame:
    """``conv_id, turn, response`` of all assistant turns."""
    return decorate_turns(table(spark, folder, "conversations"))


def decorate_turns(turns: DataFrame) -> DataFrame:
    return turns.filter(F.col("role") == "assistant").select(
        "conv_id", "turn", F.expr(RESPONSE_SQL).alias("response")
    )


def document_responses(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, source, response`` of all documents."""
    return table(spark, folder, "documents").select(
        "doc_id", "source", F.expr(DOCUMENT_SQL).alias("response")
    )


def event_time(rows: DataFrame) -> DataFrame:
    """Add an event time: a minute per conversation and a second per turn."""
    seconds = F.lit(EVENT_EPOCH) + F.col("conv_id") * 60 + F.col("turn")
    return rows.withColumn("event_time", F.timestamp_seconds(seconds))


def rollout_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The responses with event time as a stream over the table's files."""
    schema = table(spark, folder, "conversations").schema
    # A pattern lists a table kept as a single file as well as one kept as a folder; this one
    # matches that name only.
    turns = spark.readStream.schema(schema).parquet(f"{folder}/conversations.parque[t]")
    return event_time(decorate_turns(turns))


def json_lines(pairs: DataFrame) -> DataFrame:
    """``conv_id, value``: a JSON line per conversation, every eleventh blank, some damaged."""
    line = F.to_json(F.struct("prompt", "response"))
    number = F.col("conv_id")
    damaged = (
        F.when(number % 11 == 0, "  ")
        .when(number % 5 == 0, F.substring(line, 1, 20))
        .when(number % 7 == 0, F.concat(line, F.lit(" junk")))
        .otherwise(line)
    )
    return pairs.select("conv_id", damaged.alias("value"))


# A prompt of each JSON kind; the first seven are nothing to Python.
KINDS = ("null", "false", "0", "-0.0", "[]", "{}", '""', "true", "7", "0.5", '["a"]', '{"a":1}', '"false"', '"0"', '"null"')


def kind_lines(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, value``: documents as conversation lines whose own prompt is of each JSON kind."""
    kinds = F.array(*(F.lit(kind) for kind in KINDS))
    kind = F.get(kinds, (F.col("doc_id") % len(KINDS)).cast("int"))
    talk = F.to_json(
        F.array(
            F.struct(F.lit("student").alias("role"), F.col("text").alias("content")),
            F.struct(F.lit("tutor").alias("role"), F.concat(F.lit("re: "), "text").alias("content")),
        )
    )
    line = F.concat(F.lit('{"prompt":'), kind, F.lit(',"response":"own","conversation":'), talk, F.lit("}"))
    return table(spark, folder, "documents").select("doc_id", line.alias("value"))


def document_records(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as conversation records: each line a message, roles in turn.

    Own prompts are absent, null, blank or filled, and some records have no conversation. Where the
    conversation does not count, the text is in the record's own fields.
    """
    number = F.col("doc_id")
    roles = F.array(F.lit("student"), F.lit("tutor"), F.lit("system"))
    said = F.transform(
        F.split("text", "\n"),
        lambda line, i: F.struct(
            F.get(roles, (i % 3).cast("int")).alias("role"), line.alias("content")
        ),
    )
    return table(spark, folder, "documents").select(
        number.cast("string").alias("id"),
        F.when(number % 4 == 0, "")
        .when(number % 4 == 1, F.lit(None))
        .when(number % 4 == 2, "  ")
        .otherwise(F.concat(F.lit(" own prompt "), "text"))
        .alias("prompt"),
        F.when(number % 12 == 0, "").otherwise(F.concat(F.lit("own response\n"), "text")).alias("response"),
        F.when(number % 10 != 9, said).alias("conversation"),
    )
