"""Run registered queries against their SQL on one folder of test tables.

    python -m tests.compare /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd


def sql_connection(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{directory}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _rows(frame: pd.DataFrame) -> list[tuple]:
    """Rows as text in a fixed order, columns by name."""
    frame = frame[sorted(frame.columns)]
    columns = []
    for name in frame.columns:
        values = frame[name]
        if pd.api.types.is_datetime64_any_dtype(values):
            values = values.dt.date
        missing = values.isna().any()  # whole numbers beside NULL come as floats from one side, or as objects
        columns.append([
            "NULL" if pd.isna(v) else repr(float(v)) if isinstance(v, float) or (missing and isinstance(v, int)) else str(v)
            for v in values.tolist()
        ])
    return sorted(zip(*columns)) if columns else []


def difference(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"{len(spark_frame)} rows != {len(sql_frame)}"
    left, right = _rows(spark_frame), _rows(sql_frame)
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def main(directory: str, only: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as registry
    from tests.conftest import make_session

    spark, con, failed = make_session(), sql_connection(directory), 0
    sql = registry.oracle_sql()
    for name, query in registry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            found = query(spark, directory).toPandas()
            took = time.time() - start
            problem = "no SQL" if name not in sql else difference(found, con.sql(sql[name]).df())
        except Exception as error:  # report and go on with the next query
            took, problem = time.time() - start, f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28s} {took:6.2f}s spark, {time.time() - start - took:5.2f}s sql  {problem or 'ok'}", flush=True)
    spark.stop()
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
