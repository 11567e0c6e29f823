"""Evaluation metrics of a table of responses."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunedata.constants import METRIC_REPORT
from tunedata.functions.fences import is_valid_html
from tunedata.functions.reward import compliant
from tunedata.functions.syntax import parsed_count
from tunedata.functions.tags import blocks_length_ok, code_blocks, info_blocks
from tunedata.operators.syntax import Extractor

RATES = ("format_compliance", "python_syntax_rate")


def compute_metrics(
    responses: DataFrame, response: str = "response", keys: Sequence[str] = (), mode: str = "literal"
) -> DataFrame:
    """Evaluation record: one row, or one row per group of ``keys``.

    One scan and one aggregation: a response becomes a few integers where it lies, and their sums are
    shuffled. Without responses the rates are 0 and the means null. All values are quotients of
    exact integer sums, so the order of summation cannot show.
    """
    code, info = F.col("_codes"), F.col("_infos")
    checks = F.col("_code"), F.col("_info"), F.col("_length")
    checked = (
        responses.select(
            *keys, code_blocks(response).alias("_codes"), info_blocks(response).alias("_infos")
        )
        .select(
            *keys,
            (F.size(code) > 0).alias("_code"),
            (F.size(info) > 0).alias("_info"),
            blocks_length_ok(info).alias("_length"),
            F.greatest(F.size(code), F.lit(0)).alias("_blocks"),
            parsed_count(code).alias("_parsed"),
        )
        .withColumn("_compliant", compliant(*checks, mode))
    )
    return checked.groupBy(*keys).agg(
        F.expr("count(*) AS n_samples"),
        F.expr("coalesce(try_divide(count_if(_compliant), count(*)), 0D) AS format_compliance"),
        F.expr(f"coalesce({_SYNTAX_RATE}, 0D) AS python_syntax_rate"),
        F.expr("try_divide(count_if(_code) + count_if(_info) + count_if(_length), count(*)) AS avg_reward"),
        F.expr("try_divide(count_if(_code), count(*)) AS avg_code_score"),
        F.expr("try_divide(count_if(_info), count(*)) AS avg_info_score"),
        F.expr("try_divide(count_if(_length), count(*)) AS avg_len_score"),
    )


_SYNTAX_RATE = "try_divide(sum(_parsed), sum(_blocks))"


def syntax_rate(
    responses: DataFrame,
    response: str = "response",
    keys: Sequence[str] = (),
    extract: Extractor = code_blocks,
) -> DataFrame:
    """``keys, blocks, parsed, python_syntax_rate``, over blocks, not responses.

    Groups of ``keys`` without a block have no row.
    """
    counted = (
        responses.select(*keys, extract(response).alias("_found"))
        .select(*keys, F.size("_found").alias("_blocks"), parsed_count(F.col("_found")).alias("_parsed"))
        .filter("_blocks > 0")
    )
    return counted.groupBy(*keys).agg(
        F.expr("coalesce(sum(_blocks), 0) AS blocks"),
        F.expr("coalesce(sum(_parsed), 0) AS parsed"),
        F.expr(f"coalesce({_SYNTAX_RATE}, 0D) AS python_syntax_rate"),
    )


def html_valid_rate(
    responses: DataFrame, response: str = "response", keys: Sequence[str] = ()
) -> DataFrame:
    """``keys, n_samples, html_valid_rate``: share of responses whose html fences are all valid."""
    valid = responses.select(*keys, is_valid_html(response).alias("_valid"))
    return valid.groupBy(*keys).agg(
        F.expr("count(*) AS n_samples"),
        F.expr("coalesce(try_divide(count_if(_valid), count(*)), 0D) AS html_valid_rate"),
    )


def metrics_report(metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, report``: the record as text.

    ``format_number`` rounds the exact binary value half-even, as Python's ``%.1f`` does.
    """

    def decimal(col: Column, pattern: str) -> Column:
        return F.call_function("format_number", col, F.lit(pattern))

    def value(name: str) -> Column:
        if name == "n_samples":
            return F.col(name).cast("string")
        if name in RATES:
            return F.concat(decimal(F.col(name) * 100, "0.0"), F.lit("%"))
        return F.coalesce(decimal(F.col(name), "0.000"), F.lit("n/a"))

    lines = [F.concat(F.lit(label), value(name)) for label, name in METRIC_REPORT]
    return metrics.select(*keys, F.concat_ws("\n", *lines).alias("report"))
