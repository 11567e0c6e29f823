"""Prompt tables, requests, first n, group-relative scores and the salted lookup."""

import datetime
import decimal
import re
import statistics

import pytest
from pyspark.sql import functions as F

from tunedata.constants import TAG_SYSTEM_PROMPT
from tunedata.operators.limits import first_n
from tunedata.operators.lookup import attach_by_key
from tunedata.operators.rollouts import (
    evaluation_requests,
    group_relative,
    prompt_table,
    rollout_requests,
    score_rollouts,
)


def test_prompt_table(spark):
    table = prompt_table(spark, 1000)
    assert table.count() == 1000
    assert [r.prompt for r in table.distinct().collect()] == [
        f"<|im_start|>system\n{TAG_SYSTEM_PROMPT}<|im_end|>\n<|im_start|>user\n"
        "Write a random Python script.<|im_end|>\n<|im_start|>assistant\n"
    ]
    assert prompt_table(spark, 0).count() == 0


def test_rollout_requests(spark):
    prompts = spark.createDataFrame([("a",), ("b",)], "prompt string")
    found = sorted(tuple(r) for r in rollout_requests(prompts, 3).collect())
    assert found == [(p, g) for p in "ab" for g in range(3)]
    with pytest.raises(ValueError, match="generations"):
        rollout_requests(prompts, 0)


def test_evaluation_requests(spark):
    user = "<|im_start|>user\n"
    rows = spark.createDataFrame(
        [(3, f"{user} third <|im_end|>", "t"), (1, " first ", "t"), (2, None, "t"), (4, "fourth", "t")],
        "id int, prompt string, text string",
    )
    found = evaluation_requests(rows, "id", 3, "be good").orderBy("id").collect()
    assert [r.prompt for r in found] == [" first ", "", "third"]
    assert found[2].request.startswith("<|im_start|>system\nbe good<|im_end|>\n<|im_start|>user\nthird<")
    texts = evaluation_requests(rows.drop("prompt"), "id", 1).collect()
    assert [r.prompt for r in texts] == ["t"]
    assert [r.prompt for r in evaluation_requests(rows.select("id"), "id", 1).collect()] == [""]


@pytest.mark.parametrize("n", [0, 1, 7, 499, 500, 501])
def test_first_n(spark, n):
    rows = spark.range(500).select(((F.col("id") * 37) % 500).alias("k"), F.col("id").alias("v")).repartition(5)
    found = first_n(rows, n, "k").collect()
    assert sorted(r.k for r in found) == list(range(min(n, 500)))
    assert all((r.v * 37) % 500 == r.k for r in found)


def test_first_n_with_ties_and_repeats(spark):
    """The same rows from any partitioning."""
    rows = [(i % 3, f"v{i // 2}", None if i % 5 == 0 else i % 7) for i in range(100)] + [(0, "same", 1)] * 30
    frame = spark.createDataFrame(rows, "k int, v string, _order0 int")
    for n in (5, 40, 101, 200):
        order = ["k"] if n != 40 else ["_order0", "k"]
        found = {str(sorted(map(str, first_n(frame.repartition(parts), n, order).collect()))) for parts in (1, 4, 16)}
        assert len(found) == 1
        assert first_n(frame, n, "k").count() == min(n, len(rows))
        keys = sorted(r.k for r in first_n(frame, n, "k").collect())
        assert keys == sorted(k for k, _, _ in rows)[:n]


def test_first_n_of_equal_keys(spark):
    """A million rows with one key: the hash decides, and copies are repeated without being gathered."""
    rows = spark.range(1_000_000).selectExpr("1 AS k", "id % 1000 AS v", "'text' AS t")
    found = first_n(rows, 2_500, "k").groupBy("v").count().collect()
    assert sorted(r["count"] for r in found) == [500, 1000, 1000]
    assert {r.v for r in found} == {r.v for r in first_n(rows.repartition(5), 2_500, "k").distinct().collect()}
    same = spark.range(100_000).selectExpr("1 AS k", "'same' AS t")
    assert first_n(same, 70_000, "k").count() == 70_000 and first_n(same, 200_000, "k").count() == 100_000


KEYS = {
    "string": ["b", "", "a", "\u00e9", "'", None],
    "binary": [b"b", b"", b"\x00", None],
    "boolean": [True, False, None],
    "int": [3, -1, 0, None],
    "double": [1.5, -0.1, float("nan"), float("inf"), 1e-300, None],
    "float": [0.1, 2.5, float("nan"), None],
    "decimal(20,3)": [decimal.Decimal("1.250"), decimal.Decimal("-7"), None],
    "date": [datetime.date(2024, 2, 29), datetime.date(1, 1, 1), None],
    "timestamp": [datetime.datetime(2024, 10, 27, 2, 30, 0, 1), datetime.datetime(1969, 7, 20), None],
    "timestamp_ntz": [datetime.datetime(2024, 10, 27, 2, 30, 0, 1), datetime.datetime(1969, 7, 20), None],
}


@pytest.mark.parametrize("kind", KEYS)
def test_first_n_by_any_type_of_key(spark, kind):
    rows = [(value, i) for i, value in enumerate(KEYS[kind] * 2)]
    frame = spark.createDataFrame(rows, f"`a key` {kind}, i int").repartition(3)
    for n in (0, 1, 3, len(rows) - 1, len(rows) + 1):
        wanted = [r[0] for r in frame.select("a key").orderBy("a key").limit(n).collect()]
        found = first_n(frame, n, "a key").orderBy("a key").collect()
        assert str([r[0] for r in found]) == str(wanted) and len({r.i for r in found}) == len(found)
        both = first_n(frame, n, ["a key", "i"]).orderBy("a key", "i").collect()
        assert str(both) == str(frame.orderBy("a key", "i").limit(n).collect())
    with pytest.raises(ValueError, match="atomic"):
        first_n(spark.range(3).selectExpr("array(id) AS a"), 1, "a")


def test_requests_in_the_order_of_their_prompts(spark):
    rows = spark.createDataFrame([(i, f"p{9 - i}") for i in range(9)], "id int, prompt string")
    found = evaluation_requests(rows, "prompt", 3)
    assert found.columns == ["prompt", "request"]
    assert sorted(r.prompt for r in found.collect()) == ["p1", "p2", "p3"]


def relative(rewards, eps=1e-4):
    spread = statistics.stdev(rewards) if len(rewards) > 1 else 0.0
    return [(r - statistics.fmean(rewards)) / (spread + eps) for r in rewards]


def test_group_relative_with_hot_null_and_single_groups(spark):
    def group(i):
        return "hot" if i % 2 else None if i % 3 == 0 else f"g{i % 40}" if i % 8 else f"single{i}"

    rows = [(group(i), i, float((i * i) % 6)) for i in range(3000)]
    frame = spark.createDataFrame(rows, "prompt_id string, gen int, reward double").repartition(5)
    members = {}
    for key, gen, reward in rows:
        members.setdefault(key, []).append((gen, reward))
    expected = {
        gen: score
        for found in members.values()
        for (gen, _), score in zip(found, relative([r for _, r in found]))
    }
    scored = group_relative(frame, "prompt_id", ["gen"], spread=8)
    assert scored.columns == ["prompt_id", "gen", "reward", "advantage"]
    found = {r.gen: r.advantage for r in scored.collect()}
    assert len(found) == 3000
    for gen, score in expected.items():
        assert found[gen] == pytest.approx(score, abs=1e-9)
    tenths = spark.createDataFrame([("a", i, 0.1) for i in range(3)], "prompt_id string, gen int, reward double")
    assert {r.advantage for r in group_relative(tenths, "prompt_id", ["gen"]).collect()} == {0.0}
    equal = spark.createDataFrame([("a", i, 5.0) for i in range(4)], "prompt_id string, gen int, reward double")
    assert {r.advantage for r in group_relative(equal, "prompt_id", ["gen"]).collect()} == {0.0}


def test_hot_key_is_spread_over_tasks(spark):
    """No task of the join gets the whole of a key that holds all rows."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(0, 20_000, 1, 4).select(F.lit("hot").alias("k"), F.col("id").alias("row"))
        lookup = spark.createDataFrame([("hot", 1), ("cold", 2)], "k string, value int")
        joined = attach_by_key(rows, lookup, "k", ["row"])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert sum(r["count"] for r in sizes) == 20_000
        assert max(r["count"] for r in sizes) < 9_000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_keeps_rows_without_a_match(spark):
    rows = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, row int")
    lookup = spark.createDataFrame([("a", 10), (None, 30), ("z", 99)], "k string, value int")
    found = {r.row: r.value for r in attach_by_key(rows, lookup, "k", ["row"]).collect()}
    assert found == {1: 10, 2: None, 3: 30}


def test_group_relative_scans_once(spark, tmp_path):
    """The dealt rows serve moments and result: one scan, three exchanges, no row of texts shuffled."""
    spark.range(2000).selectExpr("id % 3 AS g", "id AS m", "'<info>a</info>' AS response").write.parquet(str(tmp_path / "r"))
    scored = score_rollouts(spark.read.parquet(str(tmp_path / "r")), ["g", "m"])
    found = group_relative(scored, "g", ["m"])
    assert found.filter("advantage <> 0").count() == 0
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and plan.count("ReusedExchange") == 1
    assert len(re.findall(r"\+- Exchange|:- Exchange", plan)) == 3
    assert "SortMergeJoin" not in plan


def test_moments_of_far_off_rewards(spark):
    """A large mean and a small spread: sums of squares would lose it."""
    rows = [("a", i, 1e9 + i % 7) for i in range(500)]
    frame = spark.createDataFrame(rows, "g string, m int, reward double").repartition(4)
    expected = relative([r for _, _, r in rows])
    for row in group_relative(frame, "g", ["m"], spread=16).collect():
        assert row.advantage == pytest.approx(expected[row.m], abs=1e-6)
    empty = spark.createDataFrame([("a", 1, None), ("b", 1, None), ("b", 2, 1.0)], "g string, m int, reward double")
    assert {(r.g, r.m): r.advantage for r in group_relative(empty, "g", ["m"]).collect()} == {
        ("a", 1): None, ("b", 1): None, ("b", 2): 0.0
    }


def test_score_rollouts_leaves_the_texts_behind(spark):
    rows = spark.createDataFrame([(1, "<info>a</info>"), (2, "")], "id int, response string")
    scored = score_rollouts(rows, ["id"])
    assert scored.columns == ["id", "reward"]
    assert {(r.id, r.reward) for r in scored.collect()} == {(1, 2.0), (2, 0.0)}
