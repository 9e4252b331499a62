"""Order-free comparison of a Spark result and a DuckDB result."""

import datetime
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(v)
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    return v


def _normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: [(x is not None, str(x)) for x in r])


def same(df, con, sql):
    """None if equal, otherwise what differs."""
    got_columns, got = _normal(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want_columns, want = _normal(names, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} / {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"values {dict(zip(got_columns, a))} / {dict(zip(got_columns, b))}"
    return None
