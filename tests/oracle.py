"""Comparison of a query's rows with DuckDB's, regardless of order."""

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([names[i] for i in order]), sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def same(df, con, sql):
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    want = rows([d[0] for d in found.description], found.fetchall())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    different = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    assert not different, different[:3]
