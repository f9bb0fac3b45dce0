"""Compare chosen queries with their SQL: ``python tests/run_oracle.py [sf_dir] [key ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from telemetra.session import build_session  # noqa: E402
from tests.oracle import connect, duck_rows, schema_mismatch, spark_rows  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("oracle", "local[8]", settings={"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    bad = 0
    for key, run in entry.queries().items():
        if wanted and not any(key == w or (w.endswith("*") and key.startswith(w[:-1])) for w in wanted):
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            got = spark_rows(df)
            took = time.time() - started
            sql = oracles.get(key)
            if sql is None:
                print(f"rows  {key:34s} {len(got[1]):8d} rows {took:6.2f}s", flush=True)
                continue
            started = time.time()
            want = duck_rows(con, sql)
            duck_took = time.time() - started
            types = schema_mismatch(con, sql, df)
            ok = got == want and not types and len(got[1]) > 0
            bad += not ok
            print(f"{'ok   ' if ok else 'DIFF '} {key:34s} {len(got[1]):8d} rows {took:6.2f}s duck {duck_took:5.2f}s {types or ''}", flush=True)
            if got != want:
                left, right = set(got[1]), set(want[1])
                print("   columns", got[0], want[0], len(got[1]), len(want[1]))
                print("   only spark", sorted(left - right)[:2])
                print("   only duck ", sorted(right - left)[:2])
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            bad += 1
            print(f"FAIL  {key}: {type(error).__name__} {str(error)[:700]}", flush=True)
    print("bad:", bad)
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
