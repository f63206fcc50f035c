"""Command line: python tests/check.py [sf] [name ...] - compare queries with their SQL twins."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import DATA, compare, open_duckdb  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from talkweave.session import get_session  # noqa: E402


def main(sf="sf0.001", *names):
    spark = get_session(
        master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, bad = open_duckdb(sf), oracle_sql(), []
    wanted = {k: v for k, v in queries().items() if not names or any(k.startswith(n) for n in names)}
    for name, fn in wanted.items():
        start = time.time()
        try:
            if name in sql:
                problem = compare(name, fn, sql[name], spark, con, sf)
            else:
                n = fn(spark, str(DATA / sf)).count()
                problem = None if n else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{name}: {type(e).__name__} {str(e)[:900]}"
        print(f"{'ok  ' if not problem else 'BAD '} {name} {time.time() - start:.2f}s {problem or ''}", flush=True)
        if problem:
            bad.append(name)
    print(f"{len(wanted) - len(bad)}/{len(wanted)} equal; bad: {bad}")


if __name__ == "__main__":
    main(*sys.argv[1:])
