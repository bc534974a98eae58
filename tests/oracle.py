"""Comparing a query with its SQL twin in DuckDB."""

from __future__ import annotations

import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def sorted_rows(rows: list[tuple], columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, con, folder: str, fn, sql: str) -> str | None:
    """Nothing if both agree, else what differs."""
    df = fn(spark, folder)
    columns = df.columns
    got = sorted_rows([tuple(r) for r in df.collect()], columns)
    cursor = con.execute(sql)
    wanted_columns = [c[0] for c in cursor.description]
    wanted = sorted_rows(cursor.fetchall(), wanted_columns)
    if sorted(columns) != sorted(wanted_columns):
        return f"columns {sorted(columns)} and {sorted(wanted_columns)}"
    if len(got) != len(wanted):
        return f"{len(got)} rows, {len(wanted)} expected"
    for a, b in zip(got, wanted):
        if a != b:
            return f"{a} instead of {b}"
    kinds = {(type(x), type(y)) for a, b in zip(got, wanted) for x, y in zip(a, b) if type(x) is not type(y)}
    return f"types {kinds}" if kinds else None


def main() -> None:
    """``python -m tests.oracle FOLDER [NAME ...]``"""
    import sys

    from blockloom import build_session
    from blockloom.queries import ORACLES, QUERIES

    folder, names = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__ui__showConsoleProgress="false", spark__driver__memory="8g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    for name, fn in QUERIES.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, fn, ORACLES[name]) if name in ORACLES else f"rows {fn(spark, folder).count()}"
        except Exception as error:  # report and go on with the others
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}"[:1800], flush=True)


if __name__ == "__main__":
    main()
