"""Compare every job with its SQL: ``python tools/check_oracle.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from tidelog.plans.compare import oracle_connection, same_rows  # noqa: E402
from tidelog.plans.jobs import JOBS  # noqa: E402
from tidelog.plans.sql import ORACLE  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(JOBS)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = oracle_connection(sf_dir)
    failed = []
    for name in names:
        started = time.time()
        try:
            problem = same_rows(JOBS[name](spark, sf_dir), connection, ORACLE.get(name))
        except Exception:
            problem = traceback.format_exc()[-1500:]
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - started:.2f}s {problem or ''}", flush=True)
        if problem:
            failed.append(name)
    print("failed:", failed)
    spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
