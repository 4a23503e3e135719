"""Run named queries on Spark and their SQL on DuckDB and compare the rows."""

from __future__ import annotations

import math
import os
import sys

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _key(row):
    return tuple((value is None, str(value)) for value in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(row[name] for name in names) for row in df.collect()), key=_key)


def duck_rows(connection, sql):
    result = connection.execute(sql)
    columns = [item[0] for item in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = [tuple(row[i] for i in order) for row in result.fetchall()]
    return [columns[i] for i in order], sorted(rows, key=_key)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b):
        return True
    return type(a) is type(b) and a == b


def difference(df, connection, sql) -> str | None:
    """None when names and rows are equal, else what differs first."""
    names, left = spark_rows(df)
    other_names, right = duck_rows(connection, sql)
    if names != other_names:
        return f"columns {names} != {other_names}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if not all(map(same, a, b)):
            return f"{dict(zip(names, a))} != {dict(zip(names, b))}"
    return None


def main() -> None:
    import time

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from punctual.session import build_session

    folder = os.environ.get("COMPARE_DIR", "/root/testdata/sf0.01")
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection, oracles = duck(folder), oracle_sql()
    wanted = sys.argv[1:] or list(queries())
    for name in wanted:
        started = time.time()
        try:
            df = queries()[name](spark, folder)
            if name in oracles:
                found = difference(df, connection, oracles[name])
                text = "ok" if found is None else f"DIFFERS {found}"
            else:
                text = f"rows only: {len(df.collect())}"
        except Exception as error:  # report and go on with the next query
            text = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:28s} {time.time() - started:6.1f}s  {text}", flush=True)


if __name__ == "__main__":
    main()
