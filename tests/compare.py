"""Run registered queries next to their SQL twins and compare the rows.

    python tests/compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import collections
import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, int):
        return ("int", value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(canonical(v) for v in value)
    return value


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(canonical(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir) -> tuple[bool, str]:
    df = fn(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    if sql is None:
        return len(got) > 0, f"{len(got)} rows, no SQL twin"
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return False, f"columns {sorted(df.columns)} vs {sorted(names)}"
    a, b = bag(df.columns, got), bag(names, want)
    if a != b:
        only_a, only_b = list((a - b).items())[:3], list((b - a).items())[:3]
        return False, f"{len(got)} vs {len(want)} rows; spark only {only_a}; sql only {only_b}"
    return len(got) > 0, f"{len(got)} rows"


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from runlens.session import build_session

    sf_dir, names = argv[0], argv[1:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            ok, note = compare(spark, con, name, queries[name], oracles.get(name), sf_dir)
        except Exception as exc:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:24s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
