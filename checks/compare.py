"""Run every query in Spark and its SQL in DuckDB and compare whole results.

    python -m checks.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter

import duckdb

from .oracles import oracle_sql
from .queries import queries

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def open_oracle(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _norm(value):
    return None if isinstance(value, float) and math.isnan(value) else value


def difference(spark, con, sf_dir: str, name: str) -> str:
    """Empty if the two results hold the same rows, else what differs."""
    df = queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    result = con.execute(oracle_sql()[name])
    theirs = [c[0] for c in result.description]
    if sorted(theirs) != columns:
        return f"columns: only Spark {set(columns) - set(theirs)}, only SQL {set(theirs) - set(columns)}"
    at = [theirs.index(c) for c in columns]
    expected = Counter(tuple(_norm(r[i]) for i in at) for r in result.fetchall())
    got = Counter(tuple(_norm(v) for v in r) for r in df.select(*columns).collect())
    if got == expected:
        return ""
    extra, lacking = got - expected, expected - got
    sample = f"\n  Spark {next(iter(extra), None)}\n  SQL   {next(iter(lacking), None)}"
    return f"rows {sum(got.values())}/{sum(expected.values())}, {sum(extra.values())} differ{sample}"


def main(argv: list[str]) -> int:
    from .session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con, bad = local_session(), open_oracle(sf_dir), 0
    for name in argv[1:] or queries():
        start = time.time()
        try:
            note = difference(spark, con, sf_dir, name) if name in oracle_sql() else "no SQL"
        except Exception as e:  # report and go on with the other queries
            note = f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(note)
        print(f"{'ok ' if not note else 'BAD'} {name} {time.time() - start:.1f}s {note}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
