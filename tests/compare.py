"""Run queries against DuckDB on the same files: ``python -m tests.compare [sf] [names...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

DATA = "/root/testdata"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def connect(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(_cell(v) for v in value) + "]"
    return "null" if value is None else str(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def _kinds(columns, rows):
    """Python types per column; int and float must not be mixed up between the engines."""
    return {c: sorted({type(r[i]).__name__ for r in rows if r[i] is not None})
            for i, c in enumerate(columns)}


def differences(frame, sql: str, con) -> list[str]:
    got = [tuple(r) for r in frame.collect()]
    cursor = con.execute(sql)
    names, want = [d[0] for d in cursor.description], cursor.fetchall()
    out = []
    if sorted(frame.columns) != sorted(names):
        return [f"columns {sorted(frame.columns)} != {sorted(names)}"]
    if len(got) != len(want):
        out.append(f"rows {len(got)} != {len(want)}")
    if _kinds(frame.columns, got) != _kinds(names, want):
        a, b = _kinds(frame.columns, got), _kinds(names, want)
        out.append(f"types {({c: (a[c], b[c]) for c in a if a[c] != b[c]})}")
    a, b = _rows(frame.columns, got), _rows(names, want)
    if a != b:
        left, right = sorted(set(a) - set(b))[:2], sorted(set(b) - set(a))[:2]
        out.append(f"values {left} != {right}")
    return out


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = argv[0] if argv else "0.001"
    folder = f"{DATA}/sf{sf}"
    spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(folder), 0
    wanted = argv[1:] or list(entry.queries())
    for name in wanted:
        start = time.time()
        try:
            frame = entry.queries()[name](spark, folder)
            sql = entry.oracle_sql().get(name)
            if sql is None:
                problems, note = ([] if frame.count() else ["no rows"]), "rows only"
            else:
                problems, note = differences(frame, sql, con), ""
        except Exception as error:  # report and go on to the next query
            problems, note = [f"{type(error).__name__}: {str(error)[:600]}"], ""
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s {note}",
              *problems, sep="\n     " if problems else " ", flush=True)
    print(f"{len(wanted) - bad} of {len(wanted)} match at sf{sf}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
