"""Compare registered queries with their SQL in DuckDB; run by hand or from the tests."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


def compare(spark, con, sf_dir, query, sql):
    """Empty string when both sides agree, else what differs."""
    df = query(spark, sf_dir)
    got = [tuple(r) for r in df.collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = rows_of(df.columns, got), rows_of(names, want)
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. spark={bad[0][0]} sql={bad[0][1]}"
    kinds_a = [{type(v) for v in c if v is not None} for c in zip(*a)] if a else []
    kinds_b = [{type(v) for v in c if v is not None} for c in zip(*b)] if b else []
    if kinds_a != kinds_b:
        return f"types {kinds_a} != {kinds_b}"
    return ""


def main(sf_dir: str, wanted: list[str]) -> int:
    import __spark_entry__ as entry

    from riskloom.session import local_session

    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    failures = 0
    oracles = entry.oracle_sql()
    for name, fn in entry.queries().items():
        if wanted and name not in wanted:
            continue
        started = time.perf_counter()
        try:
            if name in oracles:
                note = compare(spark, con, sf_dir, fn, oracles[name])
            else:
                n = len(fn(spark, sf_dir).collect())
                note = "" if n else "no rows"
        except Exception as e:
            note = f"{type(e).__name__}: {str(e)[:600]}"
        failures += bool(note)
        print(f"{name:24s} {time.perf_counter() - started:6.2f}s {'sql ' if name in oracles else 'rows'} {note or 'ok'}", flush=True)
    missing = set(oracles) - set(entry.queries())
    print("failures:", failures, "oracles without query:", missing)
    return failures


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]))
