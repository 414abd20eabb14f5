"""Run queries against their SQL: python tests/check_all.py [sf_dir] [name ...]

CHECK_LARGE=1 plans as for large data: no broadcast by size, every partition
kept.
"""

import os
import sys
import time
from pathlib import Path

sys.path[:0] = [str(Path(__file__).parents[1]), str(Path(__file__).parent)]

from oracle import connect, difference  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

LARGE = {
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
}

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.environ.get("CHECK_LARGE"):
        for key, value in LARGE.items():
            spark.conf.set(key, value)
    con, sqls, bad = connect(sf_dir), contract.oracle_sql(), 0
    for name, run in contract.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = difference(df, con, sqls[name]) if name in sqls else None
            rows = "" if name in sqls else f"rows {len(df.collect())}"
        except Exception as error:  # report and go on
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", ""
        bad += problem is not None
        mark = "FAIL" if problem else ("ok  " if name in sqls else "rows")
        print(f"{mark} {name:28s} {time.time() - start:6.2f}s {rows} {problem or ''}", flush=True)
    print("failed:", bad)
    sys.exit(bool(bad))
