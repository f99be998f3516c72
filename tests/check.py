"""``python tests/check.py [-d folder] [name..]``: compare queries with their SQL, with timings."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from docspark.session import build_session  # noqa: E402
from tests import oracle  # noqa: E402


def main():
    args = sys.argv[1:]
    folder = "/root/testdata/sf0.01"
    if args[:1] == ["-d"]:
        folder, args = args[1], args[2:]
    spark = build_session("local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                         "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(folder)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args or any(n == a or (a.endswith("*") and n.startswith(a[:-1]))
                                                    for a in args)]
    bad = 0
    for name in names:
        start = time.time()
        spent = 0.0
        try:
            df = queries[name](spark, folder)
            got = oracle.spark_rows(df)
            spent = time.time() - start
            if name in oracles:
                diff = oracle.difference(got, con, oracles[name])
                state = "ok" if diff is None else "DIFF " + diff[:600]
            else:
                state = f"rows-only {len(got[1])}"
        except Exception as e:  # a check goes on
            state = "ERROR " + str(e)[:600]
        bad += state.startswith(("DIFF", "ERROR"))
        print(f"{name:28s} {spent:6.2f}s {time.time() - start - spent:6.2f}s {state}", flush=True)
    print(f"{len(names)} queries, {bad} bad")


if __name__ == "__main__":
    main()
