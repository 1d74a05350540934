"""Runs registered queries against their SQL: python -m tests.oracle_run SF_DIR [name ...]."""

from __future__ import annotations

import math
import sys
import time

import duckdb

import __spark_entry__ as entry
from readsift import build_session
from readsift.fixtures import TABLES


def session():
    spark = build_session(
        "local[8]",
        conf={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def norm(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name):
    """None if both sides agree, else what differs."""
    df = entry.queries()[name](spark, sf_dir)
    got_cols = df.columns
    got = rows_of(got_cols, [tuple(r) for r in df.collect()])
    res = con.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = rows_of(cols, res.fetchall())
    if sorted(cols) != sorted(got_cols):
        return f"columns {sorted(got_cols)} != {sorted(cols)}"
    if got != want:
        only_got = [r for r in got if r not in set(want)][:3]
        only_want = [r for r in want if r not in set(got)][:3]
        return f"{len(got)} rows != {len(want)}: {sorted(cols)} {only_got} {only_want}"
    types = {d[0]: str(d[1]) for d in res.description}
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    names = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}
    odd = {c: (kinds[c], t) for c, t in types.items() if names.get(t) != kinds[c]}
    return f"types {odd}" if odd else None


def main():
    sf_dir, *names = sys.argv[1:]
    spark, con = session(), connect(sf_dir)
    bad = 0
    for name in names or entry.queries():
        start = time.time()
        try:
            problem = compare(spark, con, sf_dir, name)
        except Exception as e:  # report and go on
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        print(f"{name:26s} {time.time() - start:6.1f}s  {problem or 'ok'}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
