"""Run queries against their SQL oracles: ``python tests/oracle.py [sf_dir] [query ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


SPARK_TYPE = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "DATE": "date",
}


def types_differ(con, sql: str, df) -> list[str]:
    want = {r[0]: SPARK_TYPE.get(r[1], r[1]) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    return [f"{n} {t} != {want.get(n)}" for n, t in df.dtypes if want.get(n) != t]


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return v + 0.0
        return v

    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr), sorted(columns)


def compare(spark, con, name: str, sf_dir: str) -> str:
    from __spark_entry__ import oracle_sql, queries

    began = time.time()
    df = queries()[name](spark, sf_dir)
    rows = [tuple(r) for r in df.collect()]
    took = time.time() - began
    sql = oracle_sql().get(name)
    if sql is None:
        return f"rows-only {len(rows)} {took:.1f}s"
    differ = types_differ(con, sql, df)
    if differ:
        return f"TYPES {differ}"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    got, got_names = normal(rows, df.columns)
    want, want_names = normal(cur.fetchall(), columns)
    if got_names != want_names:
        return f"COLUMNS {got_names} != {want_names}"
    if len(got) != len(want):
        return f"ROWS {len(got)} != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"VALUES {a} != {b}"
    return f"ok {len(got)} rows {took:.1f}s"


if __name__ == "__main__":
    from __spark_entry__ import queries
    from barloom.session import build_session

    args = sys.argv[1:]
    sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    session = build_session(
        master="local[8]", spark__sql__shuffle__partitions=8, spark__driver__memory="8g", spark__ui__showConsoleProgress="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    for query in args or queries():
        try:
            print(query, compare(session, con, query, sf), flush=True)
        except Exception as e:  # report and go on with the next query
            print(query, "FAILED", str(e)[:600].replace("\n", " "), flush=True)
