"""Run queries next to their SQL on one scale and compare values.

usage: python tools/check.py [sf_dir] [--sql] [name or prefix* ...]   (--sql: only queries that have SQL)
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


TIMES = {"spark": 0.0}


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else float(repr(v))
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql) -> str:
    t = time.time()
    rows = [tuple(r) for r in spark_df.collect()]
    TIMES["spark"] = time.time() - t
    a = rows_of(spark_df.columns, rows)
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    b = rows_of(names, cur.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return f"COLUMNS {sorted(spark_df.columns)} != {sorted(names)}"
    if len(a) != len(b):
        return f"ROWS {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"ok {len(a)}" if not bad else f"VALUES {len(bad)} of {len(a)}: {bad[0]}"


def main(argv: list[str]) -> int:
    from tabloom.plans.catalogue import QUERIES, SQL
    from tabloom.session import local_session

    sf = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = [a for a in argv[1:] if a != "--sql"]
    only_sql = "--sql" in argv
    spark = local_session()
    spark.sparkContext.setLogLevel("OFF")
    con = connect(sf)
    failed = 0
    for name, fn in QUERIES.items():
        if wanted and not any(name == w or name.startswith(w.rstrip("*")) and w.endswith("*") for w in wanted):
            continue
        if only_sql and name not in SQL:
            continue
        t = time.time()
        try:
            df = fn(spark, sf)
            build = time.time() - t
            note = compare(df, con, SQL[name]) if name in SQL else f"ok {len(df.collect())} rows, no SQL"
        except Exception as err:  # report and go on with the next query
            note = f"ERROR {type(err).__name__}: {str(err)[:600]}"
        note += f"   [build {build:.1f}s run {TIMES['spark']:.1f}s]"
        failed += not note.startswith("ok")
        print(f"{name:28s} {time.time() - t:6.1f}s {note[:900]}", flush=True)
    print(f"failed: {failed}")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
