"""Run registered queries against their SQL form in DuckDB and compare all values."""

from __future__ import annotations

import datetime
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def value(x):
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 9)
    if isinstance(x, datetime.datetime) and x.tzinfo is not None:
        return x.astimezone(datetime.timezone.utc).replace(tzinfo=None)
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(value(r[i]) for i in order) for r in data]
    return sorted(columns), sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


SAME_TYPE = {
    "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP", "date": "DATE",
}


def check(spark, con, sf_dir, name, function, sql):
    df = function(spark, sf_dir)
    got = rows(df.columns, df.collect())
    rel = con.execute(sql)
    types = {d[0]: str(d[1]) for d in rel.description}
    odd = [
        (c, t, types.get(c)) for c, t in df.dtypes if types.get(c) != SAME_TYPE.get(t)
    ]
    if odd:
        print("     type note", name, odd, flush=True)
    want = rows([d[0] for d in rel.description], rel.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}"
    for g, w in zip(got[1], want[1]):
        if g != w:
            bad = [(c, a, b) for c, a, b in zip(got[0], g, w) if a != b]
            c, a, b = bad[0]
            if isinstance(a, str) and isinstance(b, str):
                at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
                return f"differs in {c} at {at}: {a[max(0, at - 60):at + 60]!r} != {b[max(0, at - 60):at + 60]!r}"
            return f"differs: {str(bad)[:700]}"
    return None


if __name__ == "__main__":
    import os

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sys.path.insert(0, root)
    import __spark_entry__ as entry
    from newsloom.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="12g", spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("OFF")
    con, oracle = duck(sf_dir), entry.oracle_sql()
    bad = 0
    for name, function in entry.queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            if name in oracle:
                problem = check(spark, con, sf_dir, name, function, oracle[name])
            else:
                problem, n = None, function(spark, sf_dir).count()
                name += f" (rows only: {n})"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        bad += problem is not None
        print(f"{'FAIL' if problem else 'ok':4} {time.time() - start:6.1f}s {name} {problem or ''}", flush=True)
    print("failed:", bad)
