"""Run registered queries against their SQL twins: python tests/oracle_check.py [folder] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def comparable(frame: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows in a fixed order."""
    frame = frame[sorted(frame.columns)]
    order = frame.astype(str).sort_values(list(frame.columns)).index
    return frame.loc[order].reset_index(drop=True)


def difference(spark, connection, name: str, folder: str) -> str | None:
    """None if both sides agree in columns, types and values, else what differs."""
    actual = comparable(contract.queries()[name](spark, folder).toPandas())
    expected = comparable(connection.execute(contract.oracle_sql()[name]).df())
    if list(actual.columns) != list(expected.columns):
        return f"columns {list(actual.columns)} / {list(expected.columns)}"
    if len(actual) != len(expected):
        return f"rows {len(actual)} / {len(expected)}"
    if [str(t) for t in actual.dtypes] != [str(t) for t in expected.dtypes]:
        return f"types {dict(actual.dtypes)} / {dict(expected.dtypes)}"
    for column in actual.columns:
        left, right = actual[column], expected[column]
        unequal = ~((left == right) | (left.isna() & right.isna()))
        if unequal.any():
            row = unequal.idxmax()
            return f"{int(unequal.sum())} values of {column}: {left[row]!r} / {right[row]!r}"
    return None


if __name__ == "__main__":
    from tunedata.session import local_session

    where = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(contract.queries())
    session, duck = local_session(), database(where)
    session.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            result = difference(session, duck, name, where) if name in contract.oracle_sql() else "no SQL"
        except Exception as error:  # noqa: BLE001
            result = f"{type(error).__name__}: {str(error)[:600]}"
        bad += result is not None
        print(f"{'ok  ' if result is None else 'DIFF'} {name} {time.time() - start:.2f}s {result or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
