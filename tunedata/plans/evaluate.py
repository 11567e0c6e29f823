"""Evaluation of a table of responses: metrics, report and JSON record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tunedata.operators.metrics import compute_metrics
from tunedata.sources.sinks import write_metrics


def evaluate_responses(
    responses: DataFrame,
    response: str = "response",
    keys: Sequence[str] = (),
    mode: str = "literal",
    output: str | None = None,
) -> DataFrame:
    """Evaluation record of the responses; with ``output`` it is written and read back.

    Reading back spares a second pass over the responses when the result is shown or compared.
    """
    metrics = compute_metrics(responses, response, keys, mode)
    if output is None:
        return metrics
    write_metrics(metrics, output)
    return responses.sparkSession.read.schema(metrics.schema).json(output)
