"""Run registered queries against their SQL: python tests/check_queries.py [folder] [name ...]"""

import sys
import time
import os

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, connect  # noqa: E402

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from lossloom.session import build_session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
                                                  "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, failed = connect(folder), oracle_sql(), 0
    for name, run in queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(spark, folder)
            problems = compare(df, con, oracles[name]) if name in oracles else ([] if df.count() else ["no rows"])
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:900]}"]
        failed += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.2f}s {'' if name in oracles else '(rows)'}", flush=True)
        for p in problems:
            print("      ", p)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
