"""The commands, chained over files."""

import json

import pytest

from tunedata.__main__ import main


def test_prepare_evaluate_and_pairs(spark, tmp_path, capsys):
    raw = [{"prompt": f"q{i}", "response": f"```python\nx = {i}\n```\n<info>{i}</info>"} for i in range(40)]
    (tmp_path / "raw.jsonl").write_text("\n".join(map(json.dumps, raw)) + "\n{bad\n")
    data = str(tmp_path / "data")
    main(["prepare", "--input", str(tmp_path / "raw.jsonl"), "--output", data, "--dpo-ratio", "1"])
    assert "sft: 40" in capsys.readouterr().out
    main(["pairs", "--data", data, "--output", str(tmp_path / "pairs")])
    kept = spark.read.json(str(tmp_path / "pairs"))
    assert 0 < kept.count() < 40 and kept.filter("chosen = rejected").count() == 0
    main(["requests", "--data", data, "--n-samples", "7", "--output", str(tmp_path / "requests")])
    requests = spark.read.json(str(tmp_path / "requests"))
    assert requests.count() == 7 and all(r.prompt.startswith("q") for r in requests.collect())
    (tmp_path / "responses.jsonl").write_text("\n".join(map(json.dumps, raw)))
    capsys.readouterr()
    main(["evaluate", "--responses", str(tmp_path / "responses.jsonl"), "--output", str(tmp_path / "m")])
    assert "Samples evaluated     : 40" in capsys.readouterr().out
    assert spark.read.json(str(tmp_path / "m")).first().avg_info_score == 1.0


def test_plain_files_and_mistakes(spark, tmp_path, capsys):
    pairs = [{"prompt": f"p{i}", "chosen": "a", "rejected": "a" if i < 3 else "b"} for i in range(8)]
    (tmp_path / "dpo").mkdir()
    for path in (tmp_path / "dpo_train.jsonl", tmp_path / "dpo" / "part.jsonl"):
        path.write_text("\n".join(map(json.dumps, pairs)))
    for path in ("dpo_train.jsonl", "dpo"):
        main(["pairs", "--data", str(tmp_path / path)])
        assert [x.strip() for x in capsys.readouterr().out.splitlines()[3].split("|")[1:4]] == ["8", "5", "3"]
    (tmp_path / "sft_train.jsonl").write_text('{"text": "only text"}\n{"prompt": "p", "text": "t"}\n')
    main(["requests", "--data", str(tmp_path / "sft_train.jsonl"), "--output", str(tmp_path / "r")])
    assert {r.prompt for r in spark.read.json(str(tmp_path / "r")).collect()} == {"only text", "p"}
    (tmp_path / "bad.jsonl").write_text('{"prompt": "p", "chosen": "a"}\n')
    with pytest.raises(Exception, match="rejected"):
        main(["pairs", "--data", str(tmp_path / "bad.jsonl")])
    (tmp_path / "responses.jsonl").write_text('{"response": "x"}\n')
    with pytest.raises(Exception, match="reponse"):
        main(["evaluate", "--responses", str(tmp_path / "responses.jsonl"), "--column", "reponse"])


def test_gates_corruptions_and_quarantine(spark, tmp_path, capsys):
    """A response must pass every gate; pairs are damaged in the chosen way only."""
    raw = [{"id": str(i), "prompt": "q", "response": f"```python\nx = {'(' if i % 2 else i}\n```\n"} for i in range(30)]
    raw += [{"id": "h", "prompt": "q", "response": "no fence"}]
    (tmp_path / "raw.jsonl").write_text("\n".join(map(json.dumps, raw)) + "\n{bad\n")
    data = tmp_path / "data"
    main(["prepare", "--input", str(tmp_path / "raw.jsonl"), "--output", str(data), "--dpo-ratio", "1",
          "--gate", "python", "valid-python", "--corrupt", "js", "--quarantine"])
    shown = dict(line.strip().split(": ") for line in capsys.readouterr().out.splitlines())
    assert shown == {"sft": "15", "dpo": "15", "skipped": "17", "malformed": "1", "empty": "0", "noncompliant": "16"}
    pairs = spark.read.json(str(data / "kind=dpo")).collect()
    assert {r.rejected == r.chosen.replace("```python", "```js") for r in pairs} == {True}
    assert spark.read.json(str(data / "kind=quarantine")).count() == 17
    with pytest.raises(SystemExit):
        main(["prepare", "--input", "x", "--gate", "unknown"])
