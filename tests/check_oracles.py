"""Compare every registered query with its SQL counterpart: ``python tests/check_oracles.py [name …]``."""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tests.sessions import local_session  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, (bytes, bytearray)):
        return bytes(value).hex()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = entry.queries()[name](spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return bool(got), f"{len(got)} rows, no SQL"
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got == want:
        return True, f"{len(got)} rows"
    for g, w in zip(got, want):
        if g != w:
            return False, f"{len(got)} vs {len(want)} rows, first difference\n  spark {g!r:.1500}\n  sql   {w!r:.1500}"
    return False, f"{len(got)} vs {len(want)} rows"


def main() -> int:
    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark, con = local_session(), connect(sf_dir)
    failed = []
    for name in sys.argv[1:] or entry.queries():
        start = time.time()
        try:
            ok, message = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, message = False, f"{type(e).__name__}: {str(e)[:1500]}"
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {message}", flush=True)
        failed += [] if ok else [name]
    print("failed:", failed)
    return len(failed)


if __name__ == "__main__":
    sys.exit(main())
