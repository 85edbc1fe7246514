"""Compares a Spark result with a DuckDB result, whatever the order of rows and columns."""

import os

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.split(".")[0]
        path = os.path.join(sf_dir, file)
        if os.path.isdir(path):
            path = os.path.join(path, "*.parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _value(value):
    if value is None or isinstance(value, (bool, str)):
        return value
    return float(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def assert_same(df, con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(names)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    want = rows_of(names, result.fetchall())
    assert len(got) == len(want)
    assert got == want
