"""Command-line comparison: ``python tests/run_compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as spark_entry  # noqa: E402
from stratalake.session import get_session  # noqa: E402
from tests.compare import connect, difference  # noqa: E402


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    queries, oracle = spark_entry.queries(), spark_entry.oracle_sql()
    names = sys.argv[2:] or list(queries)
    spark = get_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name in names:
        begin = time.time()
        try:
            problem = difference(queries[name](spark, sf_dir).toPandas(), con.execute(oracle[name]).df())
        except Exception as error:  # report and go on
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - begin:.2f}s {problem or ''}", flush=True)
    print("without SQL:", sorted(set(queries) - set(oracle)), "failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
