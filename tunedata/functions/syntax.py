"""The Python parser as a leaf: the only code of this package that runs in Python workers."""

from __future__ import annotations

import ast
import sys
import warnings

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunedata.functions.fences import python_blocks

# Workers receive these functions by value: the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def parses(source: str) -> bool:
    """Whether Python accepts the text. Any failure to parse counts as no."""
    try:
        ast.parse(source)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return False
    return True


@F.pandas_udf(T.IntegerType())
def _parsed(blocks: pd.Series) -> pd.Series:
    """How many blocks of each row parse; copies within a batch are parsed once."""
    verdicts: dict[str, bool] = {}

    def valid(block: str) -> bool:
        if block not in verdicts:
            verdicts[block] = parses(block)
        return verdicts[block]

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return blocks.map(lambda found: 0 if found is None else sum(map(valid, found))).astype("int32")


def parsed_count(blocks: Column) -> Column:
    """How many strings of an array Python accepts.

    Only the array crosses to the worker, the row stays in the JVM, and nothing is shuffled. Batches
    are bounded by ``spark.sql.execution.arrow.maxRecordsPerBatch`` and ``maxBytesPerBatch``.
    """
    return _parsed(blocks)


def is_valid_python(col: Column | str) -> Column:
    """At least one python fence, and every one of them parses."""
    blocks = python_blocks(col)
    return (F.size(blocks) > 0) & (parsed_count(blocks) == F.size(blocks))
