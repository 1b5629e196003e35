"""Run registered queries against their SQL twins and compare all rows."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def normal_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, connection, sf_dir: str, query, sql: str) -> str | None:
    """None if the results are equal, else what differs."""
    got = query(spark, sf_dir)
    got_rows = normal_rows(got.columns, got.collect())
    cursor = connection.execute(sql)
    columns = [d[0] for d in cursor.description]
    want_rows = normal_rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(got.columns):
        return f"columns {sorted(got.columns)} != {sorted(columns)}"
    if len(got_rows) != len(want_rows):
        return f"{len(got_rows)} rows, expected {len(want_rows)}"
    for a, b in zip(got_rows, want_rows):
        if a != b:
            return f"{sorted(columns)}: {a} != {b}"
    if any(type(x) is not type(y) for a, b in zip(got_rows, want_rows) for x, y in zip(a, b)):
        return "types differ"
    return None


def main(sf_dir: str, names: list[str]) -> None:
    import __spark_entry__ as contract
    from strataload.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    sql = contract.oracle_sql()
    for name, query in contract.queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            outcome = compare(spark, connection, sf_dir, query, sql[name]) or "ok"
        except Exception as error:  # report and go on with the next query
            outcome = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:32} {time.time() - start:6.1f}s  {outcome}", flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
