"""Metrics and syntax checks against plain rules; hot groups, odd keys, empty input."""

import datetime
import decimal
import subprocess
import sys

import pytest
import rules
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tunedata.functions.syntax import _parsed, parses
from tunedata.operators.metrics import (
    compute_metrics,
    html_valid_rate,
    metrics_report,
    syntax_rate,
)
from tunedata.operators.syntax import python_validity
from tunedata.plans.evaluate import evaluate_responses

TEXTS = rules.random_texts(1500, seed=11)


@pytest.fixture(scope="module")
def responses(spark):
    # A third of all rows and more falls to the key null.
    rows = [(i, None if i % 5 < 2 else i % 7, t) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "id int, source int, response string").repartition(6).cache()


def close(row, expected):
    actual = row.asDict()
    for name, value in expected.items():
        assert actual[name] == (value if value is None else pytest.approx(value, abs=1e-12)), name


def by_source():
    groups = {}
    for i, t in enumerate(TEXTS):
        groups.setdefault(None if i % 5 < 2 else i % 7, []).append(t)
    return groups


def test_metrics_of_all_responses(responses):
    close(compute_metrics(responses).first(), rules.metrics(TEXTS))


def test_metrics_by_group(responses):
    expected = by_source()
    rows = compute_metrics(responses, keys=["source"]).collect()
    assert len(rows) == len(expected)
    for row in rows:
        close(row, rules.metrics(expected[row.source]))


def test_compliance_mode(responses):
    share = sum(all(rules.checks(t)) for t in TEXTS) / len(TEXTS)
    assert compute_metrics(responses, mode="all_checks").first().format_compliance == share
    with pytest.raises(ValueError, match="mode"):
        compute_metrics(responses, mode="strict")


def test_keys_of_any_type_come_back_unchanged(spark):
    moment = datetime.datetime(2024, 2, 29, 12, 30, 15, 123456)
    keys = [(2**62 + 1, moment, decimal.Decimal("1.10"), [1, None]), (None, None, None, None)]
    rows = spark.createDataFrame(
        [(*k, "<python>x</python>") for k in keys for _ in range(3)],
        "a bigint, b timestamp, c decimal(10,2), d array<int>, response string",
    )
    found = compute_metrics(rows, keys=["a", "b", "c", "d"]).collect()
    assert {(r.a, r.b, r.c, tuple(r.d) if r.d else None) for r in found} == {
        (*k[:3], tuple(k[3]) if k[3] else None) for k in keys
    }
    assert all((r.n_samples, r.python_syntax_rate) == (3, 1.0) for r in found)


def test_no_responses(spark):
    empty = spark.createDataFrame([], "source int, response string")
    row = compute_metrics(empty).first()
    assert row.asDict() == {
        "n_samples": 0, "format_compliance": 0.0, "python_syntax_rate": 0.0, "avg_reward": None,
        "avg_code_score": None, "avg_info_score": None, "avg_len_score": None,
    }
    assert compute_metrics(empty, keys=["source"]).count() == 0
    assert "Avg total reward      : n/a" in metrics_report(compute_metrics(empty)).first().report


def test_results_do_not_depend_on_partitions(spark, responses):
    results = {
        tuple(compute_metrics(responses.repartition(n)).first()) for n in (1, 4, 16)
    }
    assert len(results) == 1


def test_report_rounds_like_python(spark):
    values = [0.125, 0.0025, 0.0035, 0.9995, 1 / 3, 0.0, 1.0, 0.00049999, 0.0625, 2.0005]
    rows = spark.createDataFrame(
        [(i, 10, v, v, v, v, v, v) for i, v in enumerate(values)],
        "id int, n_samples int, format_compliance double, python_syntax_rate double, avg_reward double,"
        "avg_code_score double, avg_info_score double, avg_len_score double",
    )
    reports = {r.id: r.report for r in metrics_report(rows, ["id"]).collect()}
    for i, v in enumerate(values):
        assert reports[i] == (
            f"  Samples evaluated     : 10\n  Format compliance     : {v * 100:.1f}%\n"
            f"  Python syntax rate    : {v * 100:.1f}%\n  Avg total reward      : {v:.3f}\n"
            f"    ↳ code tag presence : {v:.3f}\n    ↳ info tag presence : {v:.3f}\n"
            f"    ↳ info length ok    : {v:.3f}"
        )


def test_record_is_written_and_read_back(responses, tmp_path):
    path = str(tmp_path / "deep" / "eval_results.json")
    written = evaluate_responses(responses, output=path)
    assert written.collect() == compute_metrics(responses).collect()


def test_syntax_rate_counts_blocks_not_responses(spark, responses):
    blocks = [b for t in TEXTS for b in rules.code_tags(t)]
    row = syntax_rate(responses).first()
    assert (row.blocks, row.parsed) == (len(blocks), sum(map(rules.parses, blocks)))
    none = syntax_rate(spark.createDataFrame([("prose",)], "response string")).first()
    assert tuple(none) == (0, 0, 0.0)


def test_syntax_rate_by_group(responses):
    found = syntax_rate(responses, keys=["source"]).collect()
    assert {r.source for r in found} == {k for k, v in by_source().items() if any(map(rules.code_tags, v))}
    for row in found:
        blocks = [b for t in by_source()[row.source] for b in rules.code_tags(t)]
        assert (row.blocks, row.parsed) == (len(blocks), sum(map(rules.parses, blocks)))


def test_html_valid_rate(responses):
    share = sum(map(rules.valid_html, TEXTS)) / len(TEXTS)
    assert html_valid_rate(responses).first().html_valid_rate == pytest.approx(share)
    assert html_valid_rate(responses, keys=["source"]).count() == len(by_source())


def test_python_validity_of_each_row(responses):
    found = {r.id: r.python_valid for r in python_validity(responses, ["id"]).collect()}
    assert found == {i: rules.valid_python(t) for i, t in enumerate(TEXTS)}


def test_python_validity_with_a_hot_block(spark):
    """More than a third of the rows share one block; it is parsed once per batch."""
    hot, bad = "```python\nx = 1\n```", "```python\nx = (\n```"
    rows = spark.range(0, 9000, 1, 4).select(
        "id",
        F.when(F.col("id") % 2 == 0, hot).when(F.col("id") % 3 == 0, hot + bad)
        .when(F.col("id") % 5 == 0, "prose")
        .otherwise(F.concat(F.lit("```python\ny = "), F.col("id").cast("string"), F.lit("\n```")))
        .alias("response"),
    )
    found = python_validity(rows, ["id"]).collect()
    assert len(found) == 9000
    for row in found:
        invalid = row.id % 2 and (row.id % 3 == 0 or row.id % 5 == 0)
        assert row.python_valid == (not invalid)


def test_worker_code_needs_no_installed_package(tmp_path):
    """What Spark sends to a worker must load where this package is not on the path."""
    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(_parsed.func))
    check = f"""
import pickle, pandas
parsed = pickle.load(open({str(tmp_path / "f.pkl")!r}, "rb"))
print(parsed(pandas.Series([["x", "x (", "x"], [], None])).tolist())
"""
    done = subprocess.run(
        [sys.executable, "-c", check], cwd=tmp_path, capture_output=True, text=True, check=True
    )
    assert done.stdout.strip() == "[2, 0, 0]"


@pytest.mark.parametrize(
    "source, valid",
    [
        ("", True), ("\n\n", True), ("x = 1", True), ("  x = 1", False), ("x = (", False),
        ("if x:\npass", False), ("x = '\x00'", False), ("print 'old'", False), ("'\\d'", True),
        ("(" * 5000, False), ("-" * 200_000 + "1", False), ("\ud800", False),
    ],
)
def test_any_failure_to_parse_is_invalid(source, valid):
    assert parses(source) is valid
