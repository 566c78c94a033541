"""Runs a query's DuckDB SQL over the same Parquet tables and compares rows, whatever their order."""

import glob
import os

import duckdb


def oracle(sql: str, sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        src = path + "/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{src}')")
    cur = con.execute(sql)
    return [d[0] for d in cur.description], cur.fetchall()


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def same(df, sql: str, sf_dir: str) -> None:
    names, want = oracle(sql, sf_dir)
    got = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(names)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    assert len(a) == len(b)
    assert a == b
