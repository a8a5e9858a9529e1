"""Compare registered queries with their oracle SQL. Also runs as a script:

    python tests/oracle.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _sorted_rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is not None, str(v)) for v in r))


def compare(spark, con, sf_dir: str, run, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = run(spark, sf_dir)
    mine = _sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    theirs = _sorted_rows(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{sorted(names)}: {a} != {b}"
    if not mine:
        return "no rows on either side"
    return None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from marketlake.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = local_session(), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    keys = argv[1:] or list(queries)
    bad = 0
    for key in keys:
        start = time.time()
        try:
            if key in oracles:
                diff = compare(spark, con, sf_dir, queries[key], oracles[key])
            else:
                diff = None if queries[key](spark, sf_dir).count() else "no rows"
        except Exception as exc:  # keep going: the summary lists every failure
            diff = f"{type(exc).__name__}: {str(exc)[:400]}"
        bad += diff is not None
        print(f"{'ok  ' if diff is None else 'FAIL'} {key} {time.time() - start:.1f}s {diff or ''}",
              flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
