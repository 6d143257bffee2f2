"""Compare every query with its twin: ``python -m tests.check_all [sf_dir] [names]``."""

import sys
import time

from pricetide.session import build_session
from tests.compare import connect, differences

if __name__ == "__main__":
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    from __spark_entry__ import oracle_sql, queries

    spark = build_session(
        "check", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, twins = connect(sf_dir), oracle_sql()
    for name, run in queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            frame = run(spark, sf_dir)
            if name in twins:
                result = differences(frame, con, twins[name]) or f"ok {frame.count()}"
            else:
                result = f"rows only {frame.count()}"
        except Exception as error:  # report and go on with the next query
            result = f"FAILED {type(error).__name__}: {str(error)[:1500]}"
        print(f"{name:36s} {time.time() - start:6.2f}s  {result}", flush=True)
