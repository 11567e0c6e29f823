"""Registered queries: name -> function of (session, folder of the given tables)."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunedata.constants import TAG_SYSTEM_PROMPT, WHITESPACE
from tunedata.functions import corrupt
from tunedata.functions.chat import bare_prompt, chat_prompt, messages
from tunedata.functions.fences import (
    has_html_block,
    has_python_block,
    html_blocks,
    is_valid_html,
    python_blocks,
)
from tunedata.functions.reward import (
    breakdown_text,
    explain_reward,
    is_compliant,
    with_breakdown,
    with_reward,
    with_rewards,
)
from tunedata.functions.sampling import in_sample
from tunedata.functions.syntax import is_valid_python
from tunedata.functions.tags import code_blocks, info_length_ok
from tunedata.functions.text import strip
from tunedata.operators import metrics as m
from tunedata.operators import prep
from tunedata.operators.limits import first_n
from tunedata.operators.pairs import informative_pairs, pair_report
from tunedata.operators.rollouts import (
    evaluation_requests,
    group_relative,
    prompt_or_text,
    rollout_requests,
    score_rollouts,
)
from tunedata.operators.syntax import python_validity
from tunedata.plans.evaluate import evaluate_responses
from tunedata.plans.fixture import (
    PAIR_SQL,
    document_records,
    document_responses,
    event_time,
    json_lines,
    kind_lines,
    responses,
    rollout_stream,
    table,
)
from tunedata.plans.preference import load_preference_pairs
from tunedata.plans.prepare import prepare_datasets, write_prepared
from tunedata.sources.jsonl import SFT_RECORD, decode_lines, located_lines, read_jsonl
from tunedata.sources.sinks import write_rows
from tunedata.streaming.monitor import read_reward_windows, reward_windows, start_reward_monitor

Query = Callable[[SparkSession, str], DataFrame]

ROW = ("conv_id", "turn")

_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    """Register under the function's name; a final underscore only avoids a clash of names."""
    _QUERIES[build.__name__.rstrip("_")] = build
    return build


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a table that a query writes and reads back.

    It lies in the shared folder that ``spark.checkpoint.dir`` names. Without that setting a local
    session gets a temporary folder; any other session is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="tunedata-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def rounded(rows: DataFrame) -> DataFrame:
    """Doubles to six decimals."""
    doubles = [name for name, kind in rows.dtypes if kind == "double"]
    return rows.withColumns({name: F.round(name, 6) for name in doubles})


def _numbered(rows: DataFrame, items: Column, name: str) -> DataFrame:
    """One row per array item with its position."""
    return rows.select(*ROW, F.posexplode(items).alias("pos", name)).withColumn(
        "pos", F.col("pos").cast("bigint")
    )


def _turn_key() -> Column:
    return F.concat_ws(":", "conv_id", "turn")


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return prep.pair_from_turns(table(spark, folder, "conversations"))


def _statused(spark: SparkSession, folder: str, gate: prep.Gate = prep.accept_all) -> DataFrame:
    marked_up = _pairs(spark, folder).select(
        "conv_id",
        "prompt",
        F.when(F.col("response") != "", F.expr(PAIR_SQL)).otherwise("").alias("response"),
    )
    return prep.with_status(marked_up.withColumn("response", strip("response")), gate)


def _training(spark: SparkSession, folder: str) -> DataFrame:
    return prep.training_rows(_statused(spark, folder), F.col("conv_id"))


# Reward and evaluation


@query
def eval_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.compute_metrics(responses(spark, folder)))


@query
def eval_metrics_all_checks(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.compute_metrics(responses(spark, folder), mode="all_checks"))


@query
def eval_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.compute_metrics(document_responses(spark, folder), keys=["source"]))


@query
def metrics_report(spark: SparkSession, folder: str) -> DataFrame:
    return m.metrics_report(m.compute_metrics(responses(spark, folder)))


@query
def metrics_sink(spark: SparkSession, folder: str) -> DataFrame:
    output = f"{scratch_path(spark, 'metrics')}/nested/eval_results.json"
    return rounded(evaluate_responses(document_responses(spark, folder), output=output))


@query
def reward_breakdown(spark: SparkSession, folder: str) -> DataFrame:
    explained = responses(spark, folder).select(*ROW, explain_reward("response").alias("checks"))
    return explained.select(*ROW, "checks.*")


@query
def reward_breakdown_documents(spark: SparkSession, folder: str) -> DataFrame:
    scored = with_breakdown(document_responses(spark, folder))
    return scored.select(
        "doc_id", "has_code", "has_info", "info_len", "reward_total", "reward", "compliant"
    )


@query
def reward_text(spark: SparkSession, folder: str) -> DataFrame:
    explained = responses(spark, folder).select(*ROW, explain_reward("response").alias("checks"))
    return explained.select(*ROW, breakdown_text("checks").alias("breakdown"))


@query
def reward_functions(spark: SparkSession, folder: str) -> DataFrame:
    """Three registered rewards with weights, and their sum."""
    scored = with_rewards(
        document_responses(spark, folder), {"format": 1.0, "checks": 0.5, "all_checks": 2.0}
    )
    return scored.drop("response")


@query
def reward_weighted(spark: SparkSession, folder: str) -> DataFrame:
    return with_reward(responses(spark, folder))


@query
def compliant_modes(spark: SparkSession, folder: str) -> DataFrame:
    return responses(spark, folder).select(
        *ROW,
        is_compliant("response").alias("literal"),
        is_compliant("response", "all_checks").alias("all_checks"),
    )


@query
def info_length(spark: SparkSession, folder: str) -> DataFrame:
    return responses(spark, folder).select(*ROW, info_length_ok("response").alias("info_len"))


@query
def tag_blocks(spark: SparkSession, folder: str) -> DataFrame:
    return _numbered(responses(spark, folder), code_blocks("response"), "block")


# Fences and syntax


@query
def fence_flags(spark: SparkSession, folder: str) -> DataFrame:
    return responses(spark, folder).select(
        *ROW,
        has_python_block("response").alias("has_python"),
        has_html_block("response").alias("has_html"),
    )


@query
def fence_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Both languages from one scan."""
    found = F.array(
        F.struct(F.lit("python").alias("language"), python_blocks("response").alias("blocks")),
        F.struct(F.lit("html").alias("language"), html_blocks("response").alias("blocks")),
    )
    return (
        responses(spark, folder)
        .select(*ROW, F.explode(found).alias("found"))
        .select(*ROW, "found.language", F.posexplode("found.blocks").alias("pos", "block"))
        .withColumn("pos", F.col("pos").cast("bigint"))
    )


@query
def html_valid(spark: SparkSession, folder: str) -> DataFrame:
    return responses(spark, folder).select(*ROW, is_valid_html("response").alias("html_valid"))


@query
def html_valid_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Every page as a fenced response; each fourth has a second fence without a tag."""
    fenced = F.concat(
        F.lit("```HTML\n"),
        "html",
        F.lit("\n```"),
        F.when(F.col("page_id") % 4 == 0, "\n```html\nno tag < here >\n```").otherwise(""),
    )
    return table(spark, folder, "pages").select("page_id", is_valid_html(fenced).alias("html_valid"))


@query
def html_valid_rate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.html_valid_rate(responses(spark, folder)))


@query
def html_valid_rate_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.html_valid_rate(document_responses(spark, folder), keys=["source"]))


@query
def syntax_rate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.syntax_rate(responses(spark, folder)))


@query
def syntax_rate_by_source(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(m.syntax_rate(document_responses(spark, folder), keys=["source"]))


@query
def python_valid(spark: SparkSession, folder: str) -> DataFrame:
    return python_validity(responses(spark, folder), ROW)


@query
def python_valid_column(spark: SparkSession, folder: str) -> DataFrame:
    return responses(spark, folder).select(*ROW, is_valid_python("response").alias("python_valid"))


# Preparation


@query
def strip_text(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn padded with all ASCII whitespace on both sides."""
    padding = F.lit("".join(c for c in WHITESPACE if c < "\x80"))
    turns = table(spark, folder, "conversations")
    return turns.select(*ROW, strip(F.concat(padding, "text", padding)).alias("stripped"))


@query
def conv_to_pair_flat(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder)


@query
def conv_to_pair_nested(spark: SparkSession, folder: str) -> DataFrame:
    return prep.pair_from_messages(document_records(spark, folder))


@query
def chat_template(spark: SparkSession, folder: str) -> DataFrame:
    return _pairs(spark, folder).select(
        "conv_id",
        chat_prompt("prompt").alias("fence_prompt"),
        chat_prompt("prompt", TAG_SYSTEM_PROMPT).alias("tag_prompt"),
    )


@query
def prompt_recover(spark: SparkSession, folder: str) -> DataFrame:
    """Turns as they are, templated, and templated twice."""
    once = chat_prompt("text")
    source = (
        F.when(F.col("turn") % 3 == 0, once)
        .when(F.col("turn") % 3 == 1, F.concat(once, once))
        .otherwise(F.concat("text", F.lit("\n")))
    )
    turns = table(spark, folder, "conversations")
    return turns.select(*ROW, bare_prompt(source).alias("prompt"))


@query
def messages_array(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "conversations").filter(F.col("role") == "user")
    return _numbered(users, messages("text"), "message").select(*ROW, "pos", "message.*")


@query
def jsonl_scan_status(spark: SparkSession, folder: str) -> DataFrame:
    decoded = decode_lines(json_lines(_pairs(spark, folder)))
    return prep.with_status(prep.pair_from_messages(decoded)).select(
        "conv_id", "status", "prompt", "response"
    )


@query
def jsonl_value_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """Prompts of every JSON kind before conversations: what Python holds for false gives way."""
    statused = prep.with_status(prep.pair_from_messages(decode_lines(kind_lines(spark, folder))))
    return statused.select("doc_id", "status", "prompt", "response")


@query
def jsonl_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    """Lines left out by preparation, written by the job that writes the training sets.

    Each is found again by its place: ``found`` tells whether that line of that file holds it.
    """
    base = scratch_path(spark, "quarantine")
    json_lines(_pairs(spark, folder)).select("value").write.text(f"{base}/raw")
    sets = prepare_datasets(spark, f"{base}/raw", f"{base}/sets", quarantine=True)
    at = {"_file": "file", "_block": "block", "_line": "line"}
    lines = located_lines(spark, f"{base}/raw").select(
        F.col("value").alias("there"), *(F.col(c).alias(f"at_{name}") for c, name in at.items())
    )
    left_out = sets["quarantine"]
    same = [F.col(name) == F.col(f"at_{name}") for name in at.values()]
    found = F.coalesce(F.col("there") == F.col("raw"), F.col("there").isNotNull())
    return left_out.join(lines, same, "left").select(
        "status", F.coalesce("raw", F.lit("")).alias("raw"), F.coalesce(found, F.lit(False)).alias("found")
    )


@query
def jsonl_conversations(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation records as JSON lines, decoded, paired and templated."""
    lines = document_records(spark, folder).select(F.to_json(F.struct("*")).alias("value"))
    statused = prep.with_status(prep.pair_from_messages(decode_lines(lines)))
    return prep.training_rows(statused)


@query
def sft_rows(spark: SparkSession, folder: str) -> DataFrame:
    return prep.sft_rows(_training(spark, folder))


@query
def text_only(spark: SparkSession, folder: str) -> DataFrame:
    return prep.text_only(prep.sft_rows(_training(spark, folder)))


@query
def prep_report(spark: SparkSession, folder: str) -> DataFrame:
    return prep.prep_report(_statused(spark, folder), F.col("conv_id"))


@query
def prep_report_text(spark: SparkSession, folder: str) -> DataFrame:
    return prep.prep_report_text(prep.prep_report(_statused(spark, folder), F.col("conv_id")))


@query
def prep_report_gated(spark: SparkSession, folder: str) -> DataFrame:
    return prep.prep_report(_statused(spark, folder, has_python_block), F.col("conv_id"))


@query
def prep_report_syntax_gate(spark: SparkSession, folder: str) -> DataFrame:
    return prep.prep_report(_statused(spark, folder, is_valid_python), F.col("conv_id"))


@query
def first_n_(spark: SparkSession, folder: str) -> DataFrame:
    return first_n(table(spark, folder, "conversations"), 200, ROW)


@query
def training_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Both sets written in one pass and read back."""
    output = scratch_path(spark, "training")
    write_prepared(_statused(spark, folder), output, F.col("conv_id"))
    schema = "text string, prompt string, chosen string, rejected string, kind string"
    return spark.read.schema(schema).option("mode", "FAILFAST").json(output)


@query
def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    output = scratch_path(spark, "sft")
    write_rows(prep.sft_rows(_training(spark, folder)), output)
    return read_jsonl(spark, output, SFT_RECORD)


# Preference pairs


@query
def hash_sample(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select(*ROW)
    return turns.filter(in_sample(_turn_key(), 0.5))


def _corrupted(spark: SparkSession, folder: str, variant: Callable[[str], Column]) -> DataFrame:
    return responses(spark, folder).select(*ROW, variant("response").alias("rejected"))


@query
def corrupt_strip(spark: SparkSession, folder: str) -> DataFrame:
    return _corrupted(spark, folder, corrupt.strip_fences)


@query
def corrupt_js(spark: SparkSession, folder: str) -> DataFrame:
    return _corrupted(spark, folder, corrupt.python_fence_to_js)


@query
def corrupt_xml(spark: SparkSession, folder: str) -> DataFrame:
    return _corrupted(spark, folder, corrupt.html_fence_to_xml)


@query
def corrupt_unclosed(spark: SparkSession, folder: str) -> DataFrame:
    return _corrupted(spark, folder, corrupt.drop_first_closing_fence)


@query
def corrupt_choice(spark: SparkSession, folder: str) -> DataFrame:
    return _corrupted(
        spark, folder, lambda response: corrupt.rejected_variant(response, _turn_key())
    )


@query
def pref_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return prep.preference_rows(_training(spark, folder))


@query
def pref_filter(spark: SparkSession, folder: str) -> DataFrame:
    return informative_pairs(prep.preference_rows(_training(spark, folder)))


@query
def pref_filter_report(spark: SparkSession, folder: str) -> DataFrame:
    return pair_report(prep.preference_rows(_training(spark, folder)))


@query
def pref_load(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs written as JSON lines, then loaded and filtered."""
    output = scratch_path(spark, "dpo")
    write_rows(prep.preference_rows(_training(spark, folder)), output)
    return load_preference_pairs(spark, output)


# Prompts and rollouts


@query
def prompt_fallback(spark: SparkSession, folder: str) -> DataFrame:
    """A table with ``text`` but no ``prompt``."""
    turns = table(spark, folder, "conversations")
    return turns.select(*ROW, prompt_or_text(turns).alias("prompt"))


@query
def eval_requests(spark: SparkSession, folder: str) -> DataFrame:
    rows = _training(spark, folder).withColumn("order", F.md5("text"))
    return evaluation_requests(rows, "order", 50).select("prompt", "request")


@query
def rollout_requests_(spark: SparkSession, folder: str) -> DataFrame:
    users = table(spark, folder, "conversations").filter(F.col("role") == "user")
    prompts = users.select(*ROW, F.col("text").alias("prompt"))
    return rollout_requests(prompts).withColumn("gen", F.col("gen").cast("bigint"))


@query
def group_relative_reward(spark: SparkSession, folder: str) -> DataFrame:
    scored = score_rollouts(responses(spark, folder), ROW)
    return rounded(group_relative(scored, "conv_id", ["turn"]))


@query
def group_relative_by_source(spark: SparkSession, folder: str) -> DataFrame:
    """Few large groups."""
    scored = score_rollouts(document_responses(spark, folder), ["source", "doc_id"])
    return rounded(group_relative(scored, "source", ["doc_id"]))


def _epoch_windows(windows: DataFrame) -> DataFrame:
    return rounded(
        windows.withColumns(
            {name: F.unix_seconds(name) for name in ("window_start", "window_end")}
        )
    )


@query
def reward_window_table(spark: SparkSession, folder: str) -> DataFrame:
    return _epoch_windows(reward_windows(event_time(responses(spark, folder))))


@query
def reward_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The same as a stream: all windows, the open ones too, once all rows have been read."""
    base = scratch_path(spark, "reward-stream")
    windows = reward_windows(rollout_stream(spark, folder))
    start_reward_monitor(windows, f"{base}/windows", f"{base}/state", every=None).awaitTermination()
    return _epoch_windows(read_reward_windows(spark, f"{base}/windows", windows.schema))
