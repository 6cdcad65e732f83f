"""Run registered queries next to their SQL and compare schema, rows and values.

``python tests/compare.py [sf] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import tempfile
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.10g}")
    return value


def _kind(type_name: str) -> str:
    name = type_name.lower()
    if "int" in name or name == "long":
        return "integer"
    if name in ("double", "float"):
        return "double"
    if name in ("string", "varchar"):
        return "string"
    return name


def spark_rows(df):
    names = sorted(df.columns)
    types = dict(df.dtypes)
    rows = [tuple(_plain(r[n]) for n in names) for r in df.collect()]
    return names, [_kind(types[n]) for n in names], rows


def sql_rows(connection, sql: str):
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    order = sorted(range(len(described)), key=lambda i: described[i][0])
    rows = [tuple(_plain(r[i]) for i in order) for r in connection.execute(sql).fetchall()]
    return [described[i][0] for i in order], [_kind(described[i][1]) for i in order], rows


def _order(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def difference(spark_result, sql_result) -> str | None:
    if spark_result[0] != sql_result[0]:
        return f"columns {spark_result[0]} != {sql_result[0]}"
    if spark_result[1] != sql_result[1]:
        return f"types {spark_result[1]} != {sql_result[1]} of {spark_result[0]}"
    if len(spark_result[2]) != len(sql_result[2]):
        return f"{len(spark_result[2])} rows != {len(sql_result[2])}"
    for ours, theirs in zip(sorted(spark_result[2], key=_order), sorted(sql_result[2], key=_order)):
        if ours != theirs:
            return f"{ours} != {theirs}"
    return None


def main() -> int:
    import __spark_entry__ as registered
    from tidemark.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    wanted = sys.argv[2:]
    spark = build_session(
        "compare",
        "local[8]",
        8,
        {"spark.driver.memory": "16g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="compare-"), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sql = registered.oracle_sql()
    failed = 0
    for name, run in registered.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.time()
        try:
            got = spark_rows(run(spark, sf_dir))
            spent = time.time() - started
            started = time.time()
            problem = difference(got, sql_rows(connection, sql[name])) if name in sql else None
            verdict = problem or ("ok" if name in sql else "no sql")
        except Exception as error:  # a failing query must not hide the others
            spent, got, verdict = time.time() - started, (0, 0, []), f"ERROR {str(error)[:900]}"
        failed += verdict not in ("ok", "no sql")
        print(
            f"{name:26s} {len(got[2]):7d} rows  spark {spent:6.2f}s  sql {time.time() - started:6.2f}s  {verdict}",
            flush=True,
        )
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
