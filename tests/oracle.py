"""Compare registered queries with their SQL twins in DuckDB.

    python -m tests.oracle [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os
import sys
import time
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def kind(type_name: str) -> str:
    """Coarse type families, to compare schemas across the two engines."""
    t = type_name.lower().split("(")[0]
    families = {
        "bigint": "int64", "long": "int64", "int": "int32", "integer": "int32",
        "string": "text", "varchar": "text", "timestamp_ntz": "timestamp",
    }
    return families.get(t, t)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    ran = con.execute(sql)
    names = [d[0] for d in ran.description]
    types = [str(d[1]) for d in ran.description]
    expected = rows_of(names, ran.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    mine = {f.name: kind(f.dataType.simpleString()) for f in df.schema.fields}
    theirs = {n: kind(t) for n, t in zip(names, types)}
    if mine != theirs:
        return "types " + str({n: (mine[n], theirs[n]) for n in mine if mine[n] != theirs[n]})
    if got != expected:
        more, less = got - expected, expected - got
        return (
            f"rows {sum(got.values())} against {sum(expected.values())}; "
            f"only here {list(more.items())[:2]}; only there {list(less.items())[:2]}"
        )
    return None


def main(argv):
    from sitebooks.catalog import ORACLE, QUERIES
    from sitebooks.runtime import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session("local[8]", spark_ui_enabled="false", spark_sql_shuffle_partitions="8",
                          spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            found = compare(df, con, ORACLE[name]) if name in ORACLE else f"-- {df.count()} rows, no SQL"
        except Exception as error:  # report and go on
            found = f"{type(error).__name__}: {str(error)[:700]}"
        if found and not found.startswith("--"):
            bad += 1
        print(f"{'ok  ' if not found else found[:2] if found.startswith('--') else 'BAD '} "
              f"{name} {time.time() - start:.1f}s {found or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
