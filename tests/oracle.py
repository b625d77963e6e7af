"""Compare registered queries with their check SQL on DuckDB.

``python tests/oracle.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from groundsheet.plans import ORACLE, QUERIES  # noqa: E402
from groundsheet.plans.derived import TABLES  # noqa: E402


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool) or v is None:
        return repr(v)
    if isinstance(v, int):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return f"decimal {v}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(spark, con, name: str, sf_dir: str) -> tuple[bool, str]:
    df = QUERIES[name](spark, sf_dir)
    mine = _rows(df.columns, [tuple(r) for r in df.collect()])
    if name not in ORACLE:
        return bool(mine), f"{len(mine)} rows, no check SQL"
    cur = con.execute(ORACLE[name])
    columns = [d[0] for d in cur.description]
    theirs = _rows(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} against {sorted(columns)}"
    if mine != theirs:
        only = [r for r in mine if r not in set(theirs)][:3]
        other = [r for r in theirs if r not in set(mine)][:3]
        return False, f"{len(mine)} rows against {len(theirs)}; {sorted(columns)} {only} / {other}"
    return True, f"{len(mine)} rows"


def main() -> int:
    from groundsheet.session import local_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:] or list(QUERIES)
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            ok, note = compare(spark, con, name, sf_dir)
        except Exception as e:  # noqa: BLE001
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:34s} {time.time() - t0:6.2f}s {note[:900]}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(main())
