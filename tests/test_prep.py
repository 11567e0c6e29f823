"""Preparation: pairs, status, training rows, counters."""

import json

import pytest
from pyspark.sql import functions as F

from tunedata.constants import FENCE_SYSTEM_PROMPT
from tunedata.functions.fences import has_python_block
from tunedata.functions.syntax import is_valid_python
from tunedata.operators import prep
from tunedata.operators.pairs import informative_pairs, pair_report, require_columns
from tunedata.plans.preference import load_preference_pairs
from tunedata.plans.prepare import prepare_datasets
from tunedata.sources.jsonl import RAW_RECORD

S, T = "student", "tutor"

# id, prompt, response, conversation -> prompt, response
RECORDS = [
    ("own pair", " p ", "\tr\n", None, "p", "r"),
    ("first and last", "", None, [(S, " a "), (T, "b"), (S, "c"), (T, " d ")], "a", "d"),
    ("absent prompt", None, "own", [(T, "b"), (S, "c")], "c", "b"),
    ("own prompt wins", "p", "r", [(S, "a"), (T, "b")], "p", "r"),
    ("blank prompt is a prompt", "  ", "r", [(S, "a"), (T, "b")], "", "r"),
    ("no tutor keeps own response", "", " own ", [(S, "a")], "a", "own"),
    ("no student", "", "own", [(T, "b")], "", "b"),
    ("empty conversation", "", "own", [], "", "own"),
    ("other roles only", "", "own", [("system", "a"), (None, "b")], "", "own"),
    ("null content", "", "own", [(S, None), (S, "a"), (T, None)], "", ""),
    ("roles are exact", "", "own", [("Student", "a"), (T, "b")], "", "b"),
    ("nothing", None, None, None, "", ""),
]


def test_pair_from_messages(spark):
    rows = spark.createDataFrame([r[:4] for r in RECORDS], RAW_RECORD)
    found = {r.id: (r.prompt, r.response) for r in prep.pair_from_messages(rows).collect()}
    assert found == {r[0]: r[4:] for r in RECORDS}


def test_pair_from_turns(spark):
    turns = [
        (1, 2, "user", " later "), (1, 1, "user", " first "), (1, 3, "assistant", "x"), (1, 9, "assistant", "last\n"),
        (2, 0, "assistant", "only"), (3, 0, "system", "s"), (4, 0, "user", None), (4, 1, "user", "u"),
        (4, None, "assistant", "untimed"), (None, 0, "user", "no id"),
    ]
    rows = spark.createDataFrame(turns, "conv_id int, turn int, role string, text string")
    found = {r.conv_id: (r.prompt, r.response) for r in prep.pair_from_turns(rows).collect()}
    assert found == {1: ("first", "last"), 2: ("", "only"), 3: ("", ""), 4: ("", ""), None: ("no id", "")}


def test_hot_conversation_reaches_the_reducer_as_one_row_per_task(spark):
    turns = spark.range(0, 60_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"),
        F.col("id").cast("string").alias("text"),
    )
    hot = prep.pair_from_turns(turns).filter("conv_id = 7").first()
    assert (hot.prompt, hot.response) == ("0", "59997")


def test_status_and_gates(spark):
    rows = spark.createDataFrame(
        [
            ("kept", "p", "```python\nx = 1\n```", False),
            ("bad syntax", "p", "```python\nx = (\n```", False),
            ("no fence", "p", "prose", False),
            ("no prompt", "", "```python\nx\n```", False),
            ("no response", "p", None, False),
            ("malformed", None, None, True),
        ],
        "name string, prompt string, response string, malformed boolean",
    )

    def status(**gate):
        return {r.name: r.status for r in prep.with_status(rows, **gate).collect()}

    fixed = {"no prompt": "empty", "no response": "empty", "malformed": "malformed"}
    assert status() == fixed | {"kept": "kept", "bad syntax": "kept", "no fence": "kept"}
    assert status(gate=has_python_block) == fixed | {
        "kept": "kept", "bad syntax": "kept", "no fence": "noncompliant",
    }
    assert status(gate=is_valid_python) == fixed | {
        "kept": "kept", "bad syntax": "noncompliant", "no fence": "noncompliant",
    }
    report = prep.prep_report(prep.with_status(rows, is_valid_python), ratio=1.0).first().asDict()
    assert report == {"sft": 1, "dpo": 1, "skipped": 5, "malformed": 1, "empty": 2, "noncompliant": 2}


def golden_lines():
    code = "def twice(n):\n    return 2 * n"
    records = [
        {"id": "r1", "task_id": 1, "personality": "x", "conversation": [
            {"role": S, "content": "what is this?", "turn": 1},
            {"role": T, "content": code, "turn": 2, "execution": {"success": True, "error_type": None}}],
            "solved": True, "scores": {"total_score": 10, "bucket": "gold"}},
        {"prompt": " Reverse a string ", "response": "```python\ns[::-1]\n```\nok", "label": "python"},
        {"prompt": "A button", "response": "```html\n<b>x</b>\n```\n"},
        {"prompt": "", "response": "nobody asked"},
    ]
    lines = [json.dumps(r, ensure_ascii=False) for r in records]
    return [lines[0], "", lines[1], "{broken", lines[2], "   ", lines[3]], code


@pytest.mark.parametrize("ratio", [0.0, 1.0])
def test_prepare_datasets(spark, tmp_path, ratio):
    lines, code = golden_lines()
    (tmp_path / "in.jsonl").write_text("\n".join(lines))
    result = prepare_datasets(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out"), ratio)

    def chat(prompt):
        return (
            f"<|im_start|>system\n{FENCE_SYSTEM_PROMPT}<|im_end|>\n<|im_start|>user\n{prompt}<|im_end|>\n"
            "<|im_start|>assistant\n"
        )

    expected = {
        (chat("what is this?"), code),
        (chat("Reverse a string"), "```python\ns[::-1]\n```\nok"),
        (chat("A button"), "```html\n<b>x</b>\n```"),
    }
    sft = result["sft"].collect()
    assert {(r.prompt, r.chosen) for r in sft} == expected
    assert all(r.text == f"{r.prompt}{r.chosen}<|im_end|>" for r in sft)
    pairs = result["dpo"].collect()
    assert len(pairs) == 3 * ratio and {(p.prompt, p.chosen) for p in pairs} <= expected
    assert result["stats"] == {
        "sft": 3, "dpo": int(3 * ratio), "skipped": 2, "malformed": 1, "empty": 1, "noncompliant": 0,
    }


def test_prepare_datasets_without_usable_rows(spark, tmp_path):
    (tmp_path / "in.jsonl").write_text("{broken\n{}\n\n")
    result = prepare_datasets(spark, str(tmp_path / "in.jsonl"), str(tmp_path / "out"))
    assert (result["sft"].count(), result["dpo"].count()) == (0, 0)
    assert (result["stats"]["sft"], result["stats"]["skipped"]) == (0, 2)


def test_report_text(spark):
    report = spark.createDataFrame([(3, 1, 2)], "sft int, dpo int, skipped int")
    assert prep.prep_report_text(report).first().report == (
        "Dataset stats:\n  SFT examples  : 3\n  DPO pairs     : 1\n  Skipped       : 2"
    )


def test_text_only(spark):
    assert prep.text_only(spark.createDataFrame([("a", 1)], "text string, x int")).columns == ["text"]
    assert prep.text_only(spark.createDataFrame([(1,)], "x int")).columns == ["x"]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="rejected"):
        require_columns(spark.createDataFrame([("a", "b")], "prompt string, chosen string"))
    with pytest.raises(ValueError, match="chosen"):
        informative_pairs(spark.createDataFrame([("a",)], "prompt string"))


def test_identical_pairs_are_dropped_and_counted(spark, tmp_path):
    rows = [("p", "a", "b"), ("p", "a", "a"), ("q", "", ""), ("q", "a", "A")]
    pairs = spark.createDataFrame(rows, "prompt string, chosen string, rejected string")
    assert sorted(tuple(r) for r in informative_pairs(pairs).collect()) == [("p", "a", "b"), ("q", "a", "A")]
    assert pair_report(pairs).first().asDict() == {"before": 4, "after": 2, "identical": 2}
    pairs.write.json(str(tmp_path / "pairs"))
    assert load_preference_pairs(spark, str(tmp_path / "pairs")).count() == 2


def test_training_rows_do_not_depend_on_partitions(spark):
    rows = spark.range(300).select(
        F.col("id").cast("string").alias("id"),
        F.lit("p").alias("prompt"),
        F.concat(F.lit("```python\n"), F.col("id").cast("string"), F.lit("\n```\nend")).alias("response"),
    )
    results = []
    for partitions in (1, 4, 16):
        training = prep.training_rows(prep.with_status(rows.repartition(partitions)))
        results.append(sorted(tuple(map(str, r)) for r in training.collect()))
    assert results[0] == results[1] == results[2]
    sampled = [r for r in results[0] if r[3] != "None"]
    assert 110 < len(sampled) < 190
