"""Compare every named query with its SQL: python tests/check_all.py [sf_dir] [name ...]"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, connect  # noqa: E402

from touchline.plans import QUERIES  # noqa: E402
from touchline.session import build_session  # noqa: E402


def main(sf_dir: str, names: list[str]) -> int:
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                                                  "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = connect(sf_dir), 0
    for name in names or list(QUERIES):
        q, start = QUERIES[name], time.perf_counter()
        try:
            if q.sql is None:
                n = len(q(spark, sf_dir).collect())
                verdict = f"rows {n}" if n else "EMPTY"
            else:
                verdict = compare(q, spark, sf_dir, con) or "equal"
        except Exception as e:  # noqa: BLE001
            verdict = "ERROR " + (str(e)[:1500] if names else str(e)[:300].replace("\n", " "))
            if names:
                traceback.print_exc()
        ok = verdict == "equal" or verdict.startswith("rows ") and "!=" not in verdict
        bad += not ok
        print(f"{'ok ' if ok else 'BAD'} {name:32s} {time.perf_counter() - start:6.2f}s {verdict[:600]}", flush=True)
    print("bad:", bad)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001", sys.argv[2:]) else 0)
