"""Run a query and its SQL over the same tables and compare every value."""

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def duck(folder):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(out, key=lambda r: tuple((v is None, str(type(v)), v) for v in r))


def compare(df, con, sql):
    """None when equal, else a short description."""
    left_names, left = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    right_names, right = rows_of([d[0] for d in cur.description], cur.fetchall())
    if left_names != right_names:
        return f"columns {left_names} / {right_names}"
    if len(left) != len(right):
        return f"rows {len(left)} / {len(right)}"
    for a, b in zip(left, right):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{left_names}: {a} / {b}"
    return None
