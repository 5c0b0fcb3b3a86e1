"""Check queries from the command line: ``python tests/check.py [folder] [key ...]``."""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from oracle import compare, connect  # noqa: E402


def main() -> int:
    import __spark_entry__ as entry

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    failed = 0
    for key, run in queries.items():
        if keys and key not in keys:
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            if key in oracles:
                problems = compare(df, con, oracles[key])
            else:
                problems = [] if df.count() else ["no rows"]
        except Exception as e:  # report and go on with the next query
            problems = [f"{type(e).__name__}: {str(e)[:600]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {time.time() - start:6.2f}s {key} {problems or ''}", flush=True)
    print(f"{failed} failed of {len(keys) or len(queries)}")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
