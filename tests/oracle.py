"""Compare a Spark result with DuckDB's answer to the query's SQL, as bags of rows."""

from collections import Counter
from pathlib import Path

import duckdb


def duckdb_rows(sql, sf_dir):
    db = duckdb.connect()
    for table in Path(sf_dir).glob("*.parquet"):
        db.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    result = db.execute(sql)
    return [column[0] for column in result.description], result.fetchall()


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def assert_same(df, sql, sf_dir):
    columns, expected = duckdb_rows(sql, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    got = as_bag(df.columns, [tuple(row) for row in df.collect()])
    want = as_bag(columns, expected)
    assert got == want, (f"only in Spark: {list((got - want).items())[:3]}", f"only in SQL: {list((want - got).items())[:3]}")
