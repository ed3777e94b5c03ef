"""Runs named queries against their check statements: ``python tools/compare.py SF_DIR [name-prefix ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from stakeline.plans import registry  # noqa: E402
from stakeline.session import build_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name, sf_dir, build, sql):
    """None when equal, else a short description of the first difference."""
    frame = build(spark, sf_dir)
    got = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return "no statement", len(got)
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    want = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}", len(got)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; only here {[r for r in got if r not in set(want)][:2]}; only there {[r for r in want if r not in set(got)][:2]}", len(got)
    for a, b in zip(got, want):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{dict(zip(sorted(names), a))} != {dict(zip(sorted(names), b))}", len(got)
    return None, len(got)


def main() -> int:
    sf_dir, prefixes = sys.argv[1], tuple(sys.argv[2:])
    spark = build_session("compare", "local[8]", spark_sql_shuffle_partitions="8", spark_ui_enabled="false",
                          spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    statements = registry.oracle_sql()
    for name, build in registry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        t0 = time.time()
        try:
            problem, rows = compare(spark, con, name, sf_dir, build, statements.get(name))
        except Exception as error:  # report and go on
            problem, rows = f"{type(error).__name__}: {str(error)[:700]}", -1
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'BAD '} {time.time() - t0:6.2f}s {rows:7d} {name}"
              + ("" if name in statements else " (no statement)") + ("" if problem is None else f"\n      {problem}"), flush=True)
    print(f"{bad} problems")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
