"""Run registered queries beside their SQL: python check.py [sf dir] [key ...]."""

from __future__ import annotations

import sys
import time

from suite import ALL_CASES
from tests.oracle import connect, difference
from tidemark.session import build_session


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark = build_session(
        "check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for key, case in ALL_CASES.items():
        if args and not any(a in key for a in args):
            continue
        started = time.time()
        try:
            df = case.run(spark, sf_dir)
            rows = len(df.collect()) if case.sql is None else None
            problem = difference(df, connection, case.sql) if case.sql else None
        except Exception as error:  # report and go on with the next key
            rows, problem = None, f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        note = problem or ("ok" if rows is None else f"{rows} rows, no SQL")
        print(f"{key:32s} {time.time() - started:6.2f}s {note}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(main())
