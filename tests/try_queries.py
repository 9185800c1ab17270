"""Run queries by name (all by default) against their SQL: python tests/try_queries.py [sf] [name...]"""

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import compare  # noqa: E402
from revflow.session import build_session  # noqa: E402
from revflow.workload import ORACLE, QUERIES  # noqa: E402

if __name__ == "__main__":
    sf, names = sys.argv[1], sys.argv[2:] or list(QUERIES)
    folder = tempfile.mkdtemp(prefix="run-")
    spark = build_session(
        "try", "local[8]",
        spark__sql__warehouse__dir=f"{folder}/warehouse", spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            diff = compare.difference(
                QUERIES[name](spark, f"/root/testdata/{sf}"), ORACLE[name], f"/root/testdata/{sf}"
            )
        except Exception as e:  # report and go on with the next query
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} {time.time() - start:.1f}s {diff or ''}", flush=True)
    print(f"{len(names) - bad} of {len(names)} agree")
