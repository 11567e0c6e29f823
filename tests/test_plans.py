"""Shape of the physical plans: what must not creep in as data grows."""

import re

import pytest

from __spark_entry__ import entry
from tunedata.operators.limits import first_n
from tunedata.operators.prep import pair_from_messages, training_rows, with_status
from tunedata.plans import fixture
from tunedata.plans.catalog import all_queries as queries
from tunedata.plans.oracles import all_oracles as oracle_sql
from tunedata.sources.jsonl import read_jsonl_tolerant

FOLDER = "/root/testdata/sf0.001"
PYTHON = {
    "eval_metrics", "eval_metrics_all_checks", "eval_by_source", "metrics_report", "syntax_rate",
    "syntax_rate_by_source", "python_valid", "python_valid_column", "prep_report_syntax_gate",
    "jsonl_roundtrip", "pref_load", "jsonl_quarantine",
}


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(queries()))
def test_plan(spark, name):
    text = plan(queries()[name](spark, FOLDER))
    assert not re.search(r"CartesianProduct|NestedLoopJoin", text)
    assert bool(re.search(r"MapInArrow|ArrowEvalPython|BatchEvalPython", text)) == (name in PYTHON)
    assert "BatchEvalPython" not in text


def test_every_query_has_its_sql_twin():
    assert set(queries()) == set(oracle_sql())


def test_json_is_decoded_once(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"prompt":"a","response":"b"}\n')
    records = read_jsonl_tolerant(spark, str(tmp_path))
    training = training_rows(with_status(pair_from_messages(records)))
    text = plan(training)
    assert text.count("from_json(") == 1
    assert text.count("filter(") == 2  # one per role
    assert "Exchange" not in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(fixture.responses(spark, FOLDER))
    assert "EqualTo(role,assistant)" in text
    by_source = plan(queries()["eval_by_source"](spark, FOLDER))
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in by_source
    assert by_source.count("FileScan") == 1
    sample = plan(queries()["hash_sample"](spark, FOLDER))
    assert "ReadSchema: struct<conv_id:bigint,turn:bigint>" in sample


def test_aggregates_are_partial_before_the_shuffle(spark):
    text = plan(queries()["eval_by_source"](spark, FOLDER))
    assert re.search(r"HashAggregate.*\n.*Exchange.*\n.*HashAggregate.*partial_", text)
    flat = plan(queries()["conv_to_pair_flat"](spark, FOLDER))
    assert "partial_min" in flat and "partial_max" in flat


def test_plans_do_not_depend_on_table_sizes(spark):
    for name in ("conversations", "documents", "pages"):
        assert "Exchange" not in plan(fixture.table(spark, FOLDER, name))


def test_no_block_text_is_shuffled(spark):
    for name in ("eval_by_source", "syntax_rate_by_source"):
        text = plan(queries()[name](spark, FOLDER))
        assert text.count("Exchange") == 1 and text.count("FileScan") == 1, name
    for name in ("python_valid", "python_valid_column"):
        assert "Exchange" not in plan(queries()[name](spark, FOLDER)), name


def test_first_rows_are_a_filter(spark):
    """What is left after the keys were looked at is one scan with the n-th key pushed into it."""
    text = plan(first_n(fixture.table(spark, FOLDER, "conversations"), 50, ("conv_id", "turn")))
    assert "Exchange" not in text and "Join" not in text and text.count("FileScan") == 1
    assert "LessThanOrEqual(conv_id," in text
    requests = plan(queries()["eval_requests"](spark, FOLDER))
    assert "Join" not in requests and "TakeOrdered" not in requests and requests.count("FileScan") == 1


def test_rewards_share_their_patterns(spark):
    text = plan(queries()["reward_functions"](spark, FOLDER))
    assert len(re.findall(r"regexp_extract_all\(", text)) == 1
    assert text.count(r"\A(?:[^<]++|<(?!(?iu:python)>))") == 1


def test_row_local_queries_do_not_shuffle_by_key(spark):
    for name in ("reward_weighted", "corrupt_choice", "hash_sample", "fence_blocks", "html_valid",
                 "messages_array", "conv_to_pair_nested", "jsonl_conversations", "rollout_requests"):
        text = plan(queries()[name](spark, FOLDER))
        assert "hashpartitioning" not in text and "SinglePartition" not in text, name


def test_entry(spark):
    rows = entry(spark).collect()
    assert len(rows) == 1 and rows[0].n_samples > 0
