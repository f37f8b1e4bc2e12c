"""Runs queries against their SQL: ``python tests/check_queries.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import connect, differences  # noqa: E402

from ridgeline.runtime import build_session  # noqa: E402
import __spark_entry__ as driver  # noqa: E402

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": os.environ.get("PARTITIONS", "8"), "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("OFF")
    con, bad = connect(sf_dir), 0
    for name in names:
        started = time.perf_counter()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLES:
                problems = differences(df, con, ORACLES[name])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as e:  # noqa: BLE001 - report and go on
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {time.perf_counter() - started:6.2f}s {name} {problems or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(main())
