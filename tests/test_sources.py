"""JSON-lines scan, sinks and the one-pass write."""

import json

import pytest
from pyspark.sql import functions as F

from tunedata.plans.preference import load_preference_pairs
from tunedata.plans.prepare import prepare_datasets
from tunedata.sources.jsonl import (
    SFT_RECORD,
    decode_lines,
    located_lines,
    read_jsonl,
    read_jsonl_tolerant,
    read_quarantine,
    read_training_set,
)
from tunedata.sources.sinks import write_metrics, write_rows, write_training_sets

GOOD = {
    '{"prompt": "a", "response": "b"}': ("a", "b"),
    '  {"response": "b"}\t': (None, "b"),
    '\xa0{"prompt": "non-breaking blanks"}\u3000': ("non-breaking blanks", None),
    '{"prompt": "x", "prompt": "y"}': ("y", None),
    '{"prompt": null, "response": "é\\n\\u00e9"}': (None, "é\né"),
    "{}": (None, None),
    '{"other": [1, {"deep": true}]}': (None, None),
    '{"prompt": "[", "response": "]"}': ("[", "]"),
}
BAD = [
    "{'prompt': 'single quotes'}",
    '{"prompt": "a"} junk',
    '{"prompt": "a"} {"prompt": "b"}',
    '{"prompt": "a"}, {"prompt": "b"}',
    '{"prompt": "a"',
    '{"prompt": a}',
    '[{"prompt": "a"}]',
    '"text"',
    "5",
    "null",
    "]",
    "],[",
    "plain text",
    '{"prompt": "tab\there"}',
]
BLANK = ["", "   ", "\t", "\xa0\u3000"]


def test_tolerant_scan_tags_bad_lines(spark):
    lines = [(i, line) for i, line in enumerate([*GOOD, *BAD, *BLANK])]
    decoded = decode_lines(spark.createDataFrame(lines, "line int, value string"))
    rows = {row.line: row for row in decoded.collect()}
    assert set(rows) == set(range(len(GOOD) + len(BAD)))
    for number, expected in enumerate(GOOD.values()):
        row = rows[number]
        assert not row.malformed and (row.prompt, row.response) == expected, lines[number]
    for number in range(len(GOOD), len(GOOD) + len(BAD)):
        assert rows[number].malformed, lines[number]


def test_fixture_lines_are_what_the_json_module_says():
    for line in GOOD:
        assert isinstance(json.loads(line.strip()), dict)
    for line in BAD:
        try:
            assert not isinstance(json.loads(line), dict)
        except json.JSONDecodeError:
            pass


def test_scan_of_files_with_all_line_ends(spark, tmp_path):
    body = b'{"prompt":"1"}\n{"prompt":"2"}\r\n\r\n{"prompt":"3"}\r{"prompt"\n{"prompt":"4"}'
    (tmp_path / "part-0.jsonl").write_bytes(body)
    (tmp_path / "part-1.jsonl").write_bytes(b'{"prompt":"5"}\n')
    decoded = read_jsonl_tolerant(spark, str(tmp_path))
    assert sorted(r.prompt for r in decoded.filter(~F.col("malformed")).collect()) == list("12345")
    assert decoded.filter("malformed").count() == 1


def test_strict_scan_fails_on_a_bad_line(spark, tmp_path):
    (tmp_path / "rows.jsonl").write_text('{"text":"a"}\n{"text"\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_jsonl(spark, str(tmp_path), SFT_RECORD).collect()


@pytest.mark.parametrize("line", BAD)
def test_strict_scan_is_as_strict_as_the_tolerant_one(spark, tmp_path, line):
    (tmp_path / "rows.jsonl").write_text('{"prompt":"a"}\n' + line + "\n")
    with pytest.raises(Exception, match="Malformed"):
        read_jsonl(spark, str(tmp_path), SFT_RECORD).collect()


def test_strict_scan_names_file_and_line(spark, tmp_path):
    lines = ['{"text":"a"}', "", "  "] + ['{"text":"b"}'] * 30
    (tmp_path / "a.jsonl").write_text("\n".join(lines))
    (tmp_path / "b.jsonl").write_text("\n".join([*lines, '{"text"', *lines]))
    with pytest.raises(Exception, match=r"Malformed JSON at line 34 of file:.*b\.jsonl"):
        read_jsonl(spark, str(tmp_path), SFT_RECORD).collect()
    with pytest.raises(Exception, match=r"required field prompt is missing at line 1 of file:.*a\.jsonl"):
        read_jsonl(spark, str(tmp_path / "a.jsonl"), SFT_RECORD, ["prompt"]).collect()


@pytest.mark.parametrize("records", [3, 10_000])
def test_places_of_lines(spark, tmp_path, records):
    """Every line is found at its place, in several blocks of a file and several files of a task."""
    rows = [f'{{"n": {i}, "pad": "{"x" * (i % 90)}"}}' if i % 7 else "" for i in range(2000)]
    for name in ("a", "b", "c"):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{row}\n" for row in rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    try:
        found = located_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(found) == 6000 and len({r._block for r in found}) > 3
    for row in found:
        body = (tmp_path / row._file.rsplit("/", 1)[1]).read_bytes()
        # A block's lines are those that start after its first byte.
        first = 0 if row._block == 0 else body.index(b"\n", row._block) + 1
        lines = body[first:].split(b"\n")
        assert lines[row._line - 1].decode() == row.value


def test_places_cost_nothing_where_they_are_not_used(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id":"1","prompt":"a","response":"b"}\n')
    rows = read_jsonl_tolerant(spark, str(tmp_path), places=True)
    text = rows.select("prompt")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in text and "ArrowEvalPython" in rows._jdf.queryExecution().executedPlan().toString()


def test_json_kinds_of_prompts(spark):
    """A value that Python holds for false is no prompt; its look-alike text is one."""
    kinds = ["null", "false", "0", "0.0", "-0.0", "0e5", "[]", "{}", '""', "true", "7", "-1.5", '["a"]', '{"a":1}']
    kinds += ['"false"', '"0"', '"[]"', '"null"', '" "', '"\\u00e9\\n"', "[0]", "1e400"]
    lines = [(i, f'{{"prompt": {kind}, "response": {kind}}}') for i, kind in enumerate(kinds)]
    lines.append((99, '{"other": 1}'))
    rows = {r.line: r for r in decode_lines(spark.createDataFrame(lines, "line int, value string")).collect()}
    for i, kind in enumerate(kinds):
        value = json.loads(kind)
        shown = value if isinstance(value, str) else "" if not value else None
        got = rows[i].prompt or ""
        assert not rows[i].malformed and got == (rows[i].response or ""), kind
        if shown is not None:
            assert got == shown, kind
        elif kind != "1e400":
            assert json.loads(got) == value, kind
        else:
            assert got
    assert rows[99].prompt is None and not rows[99].malformed


def test_quarantine(spark, tmp_path):
    lines = ['{"prompt":"p","response":"r"}', "", "{bad", '{"prompt":"","response":"r"}', '{"prompt":"q","response":"no"}']
    (tmp_path / "raw.jsonl").write_text("\n".join(lines))
    kept = lambda response: response != "no"
    sets = prepare_datasets(spark, str(tmp_path / "raw.jsonl"), str(tmp_path / "out"), gate=kept, quarantine=True)
    rows = sorted((r.line, r.status, r.raw, r.block, r.file.rsplit("/", 1)[1]) for r in sets["quarantine"].collect())
    assert rows == [
        (3, "malformed", "{bad", 0, "raw.jsonl"),
        (4, "empty", None, 0, "raw.jsonl"),
        (5, "noncompliant", None, 0, "raw.jsonl"),
    ]
    assert sets["sft"].count() == 1 and sets["stats"]["skipped"] == 3
    assert "quarantine" not in prepare_datasets(spark, str(tmp_path / "raw.jsonl"), str(tmp_path / "out2"))
    assert read_quarantine(spark, str(tmp_path / "out2")).count() == 0


def test_equal_records_are_drawn_apart(spark, tmp_path):
    (tmp_path / "raw.jsonl").write_text('{"prompt":"p","response":"r"}\n' * 1000)
    counts = [
        prepare_datasets(spark, str(tmp_path / "raw.jsonl"), str(tmp_path / f"out{i}"), seed=seed)["stats"]["dpo"]
        for i, seed in enumerate((42, 42, 7))
    ]
    assert counts[0] == counts[1] and all(440 < c < 560 for c in counts)


def test_half_written_training_sets_are_refused(spark, tmp_path):
    rows = spark.createDataFrame([("t", "p", "c", None)], "text string, prompt string, chosen string, rejected string")
    out = str(tmp_path / "out")
    manifest = write_training_sets(rows, out)
    assert {k: v["rows"] for k, v in manifest["sets"].items()} == {"sft": 1, "dpo": 0, "quarantine": 0}
    assert read_training_set(spark, out, "sft").count() == 1 and read_training_set(spark, out, "dpo").count() == 0
    broken = rows.withColumn("chosen", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        write_training_sets(broken, out)
    (tmp_path / "out" / "kind=sft").mkdir(parents=True, exist_ok=True)
    (tmp_path / "out" / "kind=sft" / "part-0.json").write_text('{"text":"t","prompt":"p","chosen":"c"}\n')
    with pytest.raises(ValueError, match="not written to the end"):
        read_training_set(spark, out, "sft")


def test_required_fields(spark, tmp_path):
    (tmp_path / "pairs.jsonl").write_text('{"prompt":"a","chosen":"b","rejected":"c"}\n{"prompt":"a","chosen":"b"}\n')
    with pytest.raises(Exception, match="rejected"):
        load_preference_pairs(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_rows_survive_the_round_trip(spark, tmp_path, fmt):
    texts = ['quote " and \\ slash/', "line\nend\r", "tab\t\x00null", "é \U0001f600 \u2028", ""]
    rows = spark.createDataFrame([(t, t, t) for t in texts], "text string, prompt string, chosen string")
    path = str(tmp_path / "new" / "rows")
    write_rows(rows, path, fmt)
    back = read_jsonl(spark, path, SFT_RECORD) if fmt == "json" else spark.read.parquet(path)
    assert sorted(r.text for r in back.collect()) == sorted(texts)


def test_metrics_sink_overwrites(spark, tmp_path):
    path = str(tmp_path / "a" / "b" / "metrics.json")
    for n in (1, 2):
        write_metrics(spark.range(1).select(F.lit(n).alias("n_samples")), path)
    assert [row.n_samples for row in spark.read.json(path).collect()] == [2]


def test_training_sets_are_written_in_one_pass(spark, tmp_path):
    rows = [("t1", "p1", "c1", "r1"), ("t2", "p2", "c2", None), ("t3", "p3", "c3", "")]
    training = spark.createDataFrame(rows, "text string, prompt string, chosen string, rejected string")
    write_training_sets(training.repartition(2), str(tmp_path / "out"))
    files = {kind: sorted((tmp_path / "out" / f"kind={kind}").glob("*.json")) for kind in ("sft", "dpo")}
    lines = {k: sorted(line for f in v for line in f.read_text().splitlines()) for k, v in files.items()}
    assert [json.loads(line) for line in lines["sft"]] == [
        {"text": t, "prompt": p, "chosen": c} for t, p, c, _ in rows
    ]
    assert [json.loads(line) for line in lines["dpo"]] == [
        {"prompt": p, "chosen": c, "rejected": r} for _, p, c, r in rows if r is not None
    ]
