"""Column functions against the plain rules on random texts and edge cases."""

import sys
import time

import pytest
import rules
from pyspark.sql import functions as F

from tunedata.constants import FENCE_SYSTEM_PROMPT, WHITESPACE, WHITESPACE_CLASS
from tunedata.functions import chat, corrupt, fences, reward, sampling, syntax, tags, text
from tunedata.functions.reward import breakdown_text, explain_reward, reward_function, with_rewards

TEXTS = rules.random_texts(3000) + ["", " ", "<info></info>", "<python></python>", "```python\n```"]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "id int, t string").repartition(4)
    return rows.cache()


def values(texts, column):
    return [row[1] for row in sorted(texts.select("id", column.alias("v")).collect())]


RULES = [
    (text.strip, str.strip),
    (text.is_blank, lambda t: not t.strip()),
    (lambda c: text.has_tokens(c, 1, 1), lambda t: len(t.split()) == 1),
    (lambda c: text.has_tokens(c, 2, 5), lambda t: 2 <= len(t.split()) <= 5),
    (lambda c: text.has_tokens(c, 0, 3), lambda t: len(t.split()) <= 3),
    (lambda c: text.has_tokens(c, -1, 0), lambda t: len(t.split()) == 0),
    (lambda c: text.has_tokens(c, 3, 2), lambda t: False),
    (fences.has_python_block, lambda t: bool(rules.python_fences(t))),
    (fences.has_html_block, lambda t: bool(rules.html_fences(t))),
    (fences.python_blocks, rules.python_fences),
    (fences.html_blocks, rules.html_fences),
    (fences.is_valid_html, rules.valid_html),
    (fences.has_opening_tag, rules.opens_tag),
    (syntax.is_valid_python, rules.valid_python),
    (tags.has_code_block, lambda t: bool(rules.code_tags(t))),
    (tags.has_info_block, lambda t: bool(rules.info_tags(t))),
    (tags.code_blocks, rules.code_tags),
    (tags.info_blocks, rules.info_tags),
    (tags.info_length_ok, lambda t: rules.checks(t)[2]),
    (reward.compute_reward, rules.reward),
    (reward.is_compliant, lambda t: rules.reward(t) == 3),
    (lambda c: reward.is_compliant(c, "all_checks"), lambda t: all(rules.checks(t))),
    (reward.explain_reward, lambda t: (*rules.checks(t), float(sum(rules.checks(t))))),
    (corrupt.strip_fences, rules.VARIANTS[0]),
    (corrupt.python_fence_to_js, rules.VARIANTS[1]),
    (corrupt.html_fence_to_xml, rules.VARIANTS[2]),
    (corrupt.drop_first_closing_fence, rules.VARIANTS[3]),
]


@pytest.mark.parametrize("column, rule", RULES, ids=lambda value: value.__name__)
def test_column_follows_rule(texts, column, rule):
    actual, expected = values(texts, column("t")), [rule(t) for t in TEXTS]
    wrong = [(t, a, e) for t, a, e in zip(TEXTS, actual, expected) if a != e]
    assert not wrong, f"{len(wrong)} differ, such as {wrong[0]!r}"


def test_random_texts_reach_every_outcome():
    for rule in (rules.valid_python, rules.valid_html, lambda t: rules.checks(t)[2]):
        assert {True, False} == {rule(t) for t in TEXTS}
    assert {0, 2, 3, 4, 5} == {rules.reward(t) for t in TEXTS}


def test_whitespace_set_is_pythons():
    spaces = {chr(code) for code in range(sys.maxunicode + 1) if chr(code).isspace()}
    assert set(WHITESPACE) == spaces and len(WHITESPACE) == len(spaces)


def test_whitespace_class_is_pythons(spark):
    points = [c for c in range(1, 0x10000) if not 0xD800 <= c < 0xE000]
    rows = spark.createDataFrame([(c, chr(c)) for c in points], "code int, t string")
    found = rows.filter(F.col("t").rlike(rf"\A{WHITESPACE_CLASS}\z")).select("code").collect()
    assert {chr(row.code) for row in found} == set(WHITESPACE)


def test_known_reward_samples(spark):
    info = "here is an answer that is long enough to reach the ten tokens asked for"
    samples = [
        (f"<info>{info}</info>\n<python>\ndef f(a):\n    return a\n</python>", (True, True, True, 3.0), 5.0, False),
        ("<python>\ndef f(a):\n    return a\n</python>", (True, False, False, 1.0), 2.0, False),
        (f"<info> {info} </info>", (False, True, True, 2.0), 3.0, True),
        ("<info> brief </info>\n<python>\npass\n</python>", (True, True, False, 2.0), 4.0, False),
        ("Just prose.", (False, False, False, 0.0), 0.0, False),
    ]
    rows = spark.createDataFrame([(i, s[0]) for i, s in enumerate(samples)], "id int, response string")
    scored = reward.with_breakdown(rows).orderBy("id").collect()
    for row, (_, explained, weighted, literal) in zip(scored, samples):
        assert (row.has_code, row.has_info, row.info_len, row.reward_total) == explained
        assert (row.reward, row.compliant) == (weighted, literal)


def test_info_length_bounds_are_inclusive(spark):
    lengths = [0, 1, 9, 10, 11, 499, 500, 501, 5000]
    rows = [(n, "<info>" + " w" * (n // 2) + "</info><info>" + "w\x1c" * (n - n // 2) + "</info>") for n in lengths]
    frame = spark.createDataFrame(rows, "n int, t string").select("n", tags.info_length_ok("t").alias("ok"))
    assert {row.n for row in frame.collect() if row.ok} == {10, 11, 499, 500}


def test_many_tokens_need_no_deep_stack(spark):
    rows = spark.createDataFrame([(n, "wo \n" * n) for n in (199_999, 200_000, 300_000, 300_001)], "n int, t string")
    found = rows.filter(text.has_tokens("t", 200_000, 300_000)).select("n").collect()
    assert {row.n for row in found} == {200_000, 300_000}


def test_null_text_counts_as_empty(spark):
    row = spark.createDataFrame([(None,)], "t string").select(
        reward.compute_reward("t").alias("r"),
        fences.has_python_block("t").alias("f"),
        fences.is_valid_html("t").alias("h"),
        syntax.is_valid_python("t").alias("p"),
        tags.info_length_ok("t").alias("l"),
    ).first()
    assert tuple(row) == (0.0, False, False, False, False)


def test_with_reward_keeps_other_columns(spark):
    rows = spark.createDataFrame([("<info>a</info>", True, 1)], "answer string, has_code boolean, x int")
    assert reward.with_reward(rows, "answer").first().asDict() == {
        "answer": "<info>a</info>", "has_code": True, "x": 1, "reward": 2.0,
    }


@pytest.mark.parametrize(
    "column",
    [
        tags.has_code_block,
        tags.info_length_ok,
        tags.code_blocks,
        fences.python_blocks,
        fences.has_opening_tag,
        text.strip,
        corrupt.drop_first_closing_fence,
    ],
)
def test_degenerate_texts_take_one_pass(spark, column):
    """Repeated openers without a closer make a plain lazy pattern quadratic (many minutes here)."""
    unit = ["<info>", "<python>", "<a", "<", "</", "<info></", " ", "```\npython "]
    rows = spark.createDataFrame([("x" + u * (1_500_000 // len(u)) + "x",) for u in unit], "t string")
    start = time.time()
    rows.select(column("t").alias("v")).write.format("noop").mode("overwrite").save()
    assert time.time() - start < 30


def test_chat_template_and_recovery(spark):
    row = spark.createDataFrame([("ask",)], "p string").select(
        chat.chat_prompt("p", "be good").alias("chat"),
        chat.sft_text(chat.chat_prompt("p", "be good"), F.lit("reply")).alias("text"),
        chat.messages("p", "be good").alias("messages"),
    ).first()
    assert row.chat == (
        "<|im_start|>system\nbe good<|im_end|>\n<|im_start|>user\nask<|im_end|>\n<|im_start|>assistant\n"
    )
    assert row.text == row.chat + "reply<|im_end|>"
    assert [tuple(m) for m in row.messages] == [("system", "be good"), ("user", "ask")]
    assert "\n" not in FENCE_SYSTEM_PROMPT and r"```python\n...\n```" in FENCE_SYSTEM_PROMPT


def test_bare_prompt(spark):
    user = "<|im_start|>user\n"
    cases = {
        " plain ": " plain ",
        f"s{user} a <|im_end|>rest": "a",
        f"{user}first<|im_end|>{user} last\n": "last",
        f"{user}open": "open",
        "<|im_start|>user no line end<|im_end|>": "<|im_start|>user no line end<|im_end|>",
    }
    rows = spark.createDataFrame([(c,) for c in cases], "t string")
    found = rows.select("t", chat.bare_prompt("t").alias("p")).collect()
    assert {row.t: row.p for row in found} == cases


def test_variant_choice_uses_all_variants_evenly(spark):
    rows = spark.range(4000).select(sampling.pick("id", 4).alias("n")).groupBy("n").count().collect()
    assert {row.n for row in rows} == {0, 1, 2, 3}
    assert all(850 < row["count"] < 1150 for row in rows)


def test_sample_share_and_independence(spark):
    rows = spark.range(20000).select(
        sampling.in_sample("id", 0.3).alias("s"), sampling.pick("id", 2).alias("n")
    )
    counts = {(r.s, r.n): r["count"] for r in rows.groupBy("s", "n").count().collect()}
    sampled = counts[True, 0] + counts[True, 1]
    assert 5700 < sampled < 6300
    assert abs(counts[True, 0] - counts[True, 1]) < 300
    nothing = spark.range(100).filter(sampling.in_sample("id", 0.0)).count()
    everything = spark.range(100).filter(sampling.in_sample("id", 1.0)).count()
    assert (nothing, everything) == (0, 100)


def test_sample_depends_on_key_and_seed_only(spark):
    few = {r.id for r in spark.range(50).filter(sampling.in_sample("id", 0.5)).collect()}
    many = {r.id for r in spark.range(500).repartition(7).filter(sampling.in_sample("id", 0.5)).collect()}
    other = {r.id for r in spark.range(50).filter(sampling.in_sample("id", 0.5, seed=1)).collect()}
    assert few == {i for i in many if i < 50}
    assert few != other


def test_registered_rewards_and_text_form(spark):
    long = " ".join(["w"] * 12)
    texts = ["", "<python>x</python>", f"<info>{long}</info>", f"<info>{long}</info><python>x</python>", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, response string")

    def length(checks):
        return F.when(checks.response != "", F.length(checks.response))

    weights = {"format": 2.0, "checks": 1, "all_checks": 0.5, "compliant": 1.0, "length": (0.25, length), "blocks": lambda c: F.size(c.info_blocks)}
    scored = with_rewards(rows, weights)
    assert scored.columns == ["i", "response", *(f"reward_{n}" for n in weights), "reward"]
    for row in scored.collect():
        plain = [2.0 * row.reward_format, row.reward_checks, 0.5 * row.reward_all_checks, row.reward_compliant]
        text = texts[row.i] or ""
        assert row.reward == sum(plain) + 0.25 * len(text) + row.reward_blocks
        assert row.reward_length == (len(text) or None) and row.reward_blocks == text.count("<info>")
        assert row.reward_compliant == float(row.reward_format == 3)
    with pytest.raises(ValueError, match="no reward 'formt'; there are all_checks, checks"):
        with_rewards(rows, {"formt": 1.0})
    with pytest.raises(ValueError):
        with_rewards(rows, {})
    with pytest.raises(ValueError, match="already"):
        reward_function("format")(length)
    shown = {r.i: r.t for r in rows.select("i", breakdown_text(explain_reward("response")).alias("t")).collect()}
    assert shown[0] == "RewardBreakdown(has_code=False, has_info=False, info_len=False, total=0.0)"
    assert shown[3] == "RewardBreakdown(has_code=True, has_info=True, info_len=True, total=3.0)"
