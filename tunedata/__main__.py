"""Command line: ``python -m tunedata COMMAND``; the session takes its settings from spark-defaults.

    python -m tunedata prepare  --input raw/ --output data/ [--dpo-ratio 0.5] [--seed 42]
                                [--gate python html] [--corrupt strip js] [--quarantine]
    python -m tunedata requests --data data/ --order hash --output requests/ [--n-samples 200]
    python -m tunedata evaluate --responses responses/ [--keys source] [--output metrics/]
    python -m tunedata pairs    --data data/

Tables are read as Parquet if the path ends in .parquet, else as JSON lines.
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunedata.constants import EVAL_SAMPLES, PAIR_RATIO, SEED
from tunedata.functions import corrupt
from tunedata.functions.fences import has_html_block, has_python_block, is_valid_html
from tunedata.functions.reward import COMPLIANCE_MODES
from tunedata.functions.syntax import is_valid_python
from tunedata.operators.metrics import metrics_report
from tunedata.operators.pairs import informative_pairs, pair_report
from tunedata.operators.prep import Gate, accept_all
from tunedata.operators.rollouts import evaluation_requests
from tunedata.plans.evaluate import evaluate_responses
from tunedata.plans.prepare import prepare_datasets
from tunedata.sources.jsonl import read_jsonl, read_training_set
from tunedata.sources.sinks import write_rows


GATES = {
    "python": has_python_block,
    "html": has_html_block,
    "valid-python": is_valid_python,
    "valid-html": is_valid_html,
}
CORRUPTIONS = {
    "strip": corrupt.strip_fences,
    "js": corrupt.python_fence_to_js,
    "xml": corrupt.html_fence_to_xml,
    "unclosed": corrupt.drop_first_closing_fence,
}


def _gate(names: list[str]) -> Gate:
    """All named checks together; without any, every response passes."""
    if not names:
        return accept_all
    return lambda response: reduce(Column.__and__, (GATES[name](response) for name in names))


def _table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    if path.rstrip("/").endswith(".parquet"):
        return spark.read.parquet(path)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in columns])
    return read_jsonl(spark, path, schema, columns[-1:])


def _prepare(spark: SparkSession, args: argparse.Namespace) -> None:
    variants = [CORRUPTIONS[name] for name in args.corrupt or CORRUPTIONS]
    result = prepare_datasets(
        spark, args.input, args.output, args.dpo_ratio, args.seed, _gate(args.gate), variants=variants,
        quarantine=args.quarantine,
    )
    for name, count in result["stats"].items():
        print(f"{name:>14}: {count}")


def _requests(spark: SparkSession, args: argparse.Namespace) -> None:
    rows = read_training_set(spark, args.data, "sft")
    rows = rows.withColumn("prompt", F.coalesce("prompt", "text")).withColumn("hash", F.md5("text"))
    write_rows(evaluation_requests(rows, args.order, args.n_samples), args.output)


def _evaluate(spark: SparkSession, args: argparse.Namespace) -> None:
    responses = _table(spark, args.responses, [*args.keys, args.column])
    metrics = evaluate_responses(responses, args.column, args.keys, args.mode, args.output)
    metrics_report(metrics, args.keys).show(truncate=False, vertical=bool(args.keys))


def _pairs(spark: SparkSession, args: argparse.Namespace) -> None:
    pairs = read_training_set(spark, args.data, "dpo")
    pair_report(pairs).show()
    if args.output:
        write_rows(informative_pairs(pairs), args.output)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tunedata", description=__doc__.splitlines()[0])
    commands = parser.add_subparsers(required=True)

    prepare = commands.add_parser("prepare", help="JSON lines to SFT rows and preference pairs")
    prepare.add_argument("--input", required=True)
    prepare.add_argument("--output", default="data")
    prepare.add_argument("--dpo-ratio", type=float, default=PAIR_RATIO)
    prepare.add_argument("--seed", type=int, default=SEED)
    prepare.add_argument("--gate", nargs="+", choices=GATES, default=[], help="checks a response must pass")
    prepare.add_argument("--corrupt", nargs="+", choices=CORRUPTIONS, help="ways to damage a response; default all")
    prepare.add_argument("--quarantine", action="store_true", help="also write the lines left out, with their place")
    prepare.set_defaults(run=_prepare)

    requests = commands.add_parser("requests", help="first rows as generation requests")
    requests.add_argument("--data", required=True)
    requests.add_argument("--order", nargs="+", default=["hash"])
    requests.add_argument("--n-samples", type=int, default=EVAL_SAMPLES)
    requests.add_argument("--output", required=True)
    requests.set_defaults(run=_requests)

    evaluate = commands.add_parser("evaluate", help="metrics of a table of responses")
    evaluate.add_argument("--responses", required=True)
    evaluate.add_argument("--column", default="response")
    evaluate.add_argument("--keys", nargs="*", default=[])
    evaluate.add_argument("--mode", choices=COMPLIANCE_MODES, default="literal")
    evaluate.add_argument("--output")
    evaluate.set_defaults(run=_evaluate)

    pairs = commands.add_parser("pairs", help="count identical pairs; write the others")
    pairs.add_argument("--data", required=True)
    pairs.add_argument("--output")
    pairs.set_defaults(run=_pairs)
    return parser


def main(arguments: list[str] | None = None) -> None:
    args = _arguments().parse_args(arguments)
    args.run(SparkSession.builder.appName("tunedata").getOrCreate(), args)


if __name__ == "__main__":
    main()
