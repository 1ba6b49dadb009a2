"""Compare registered queries with their SQL in DuckDB: ``python tools/check.py [sf] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from contrail.plans.adapters import BASE_TABLES  # noqa: E402
from contrail.plans.catalog import QUERIES  # noqa: E402
from contrail.session import build_session  # noqa: E402


def rows_of(table, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(r[i] for i in order) for r in table), key=lambda t: tuple((v is None, str(v)) for v in t)
    )


def connect(folder: str):
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def main(argv):
    sf = argv[0] if argv else "0.001"
    folder = f"/root/testdata/sf{sf}"
    names = argv[1:] or list(QUERIES)
    names = [q for q in QUERIES if any(q == n or q.startswith(n + "_") for n in names)] if argv[1:] else names
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                 "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        q = QUERIES[name]
        start = time.time()
        try:
            df = q.run(spark, folder)
            mine = rows_of([tuple(r) for r in df.collect()], df.columns)
            took = time.time() - start
            if q.sql is None:
                print(f"rows  {name:38s} {len(mine[1]):7d} rows {took:6.2f}s", flush=True)
                continue
            cur = con.execute(q.oracle())
            theirs = rows_of(cur.fetchall(), [d[0] for d in cur.description])
            same = mine == theirs
            print(f"{'ok   ' if same else 'DIFF '} {name:38s} {len(mine[1]):7d} rows {took:6.2f}s", flush=True)
            if not same:
                bad += 1
                print("   columns", mine[0], theirs[0], "rows", len(mine[1]), len(theirs[1]))
                shown = 0
                for a, b in zip(mine[1], theirs[1]):
                    if a != b:
                        print("   spark ", a, "\n   duckdb", b)
                        shown += 1
                        if shown == 3:
                            break
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"FAIL  {name}: {type(e).__name__} {str(e)[:1500]}", flush=True)
    print("bad:", bad, "of", len(names))
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
