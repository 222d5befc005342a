"""Compare a Spark result with its SQL twin, row by row, order aside."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES.split():
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)) if v is None else "", str(v)) for v in row)


def _cell(v):
    if isinstance(v, float) and v == 0:
        return 0.0
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return v
    return v


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_cell(r[n]) for n in names) for r in df.collect()), key=_key)


def duck_rows(con, sql):
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    names = sorted(cols)
    pos = [cols.index(n) for n in names]
    return names, sorted((tuple(_cell(r[i]) for i in pos) for r in cur.fetchall()), key=_key)


def differences(left, right, limit=3):
    """Names, counts, then values: equal to the bit, but for the last place of a double."""
    (ln, lr), (rn, rr) = left, right
    if ln != rn:
        return [f"columns {ln} against {rn}"]
    if len(lr) != len(rr):
        return [f"rows {len(lr)} against {len(rr)}"]
    out = []
    for a, b in zip(lr, rr):
        for n, x, y in zip(ln, a, b):
            if type(x) is not type(y) or (x != y and not (isinstance(x, float) and math.isnan(x) and math.isnan(y))):
                out.append(f"{n}: {x!r} against {y!r} in {dict(zip(ln, a))} / {dict(zip(rn, b))}")
                break
        if len(out) >= limit:
            break
    return out
