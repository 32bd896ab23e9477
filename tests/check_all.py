"""Compare every registered query with its SQL twin: python tests/check_all.py [sf dir] [name …]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from pairloom.session import local_session  # noqa: E402
from tests.oracle import compare, connect  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = local_session("check", 8), connect(sf)
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        sql = entry.oracle_sql().get(name)
        t = time.time()
        try:
            problem = compare(spark, con, sf, fn, sql) if sql else f"no SQL, {fn(spark, sf).count()} rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:900]}"
        bad += bool(problem)
        print(f"{'ok ' if not problem else 'BAD'} {name} {time.time() - t:.2f}s {problem}", flush=True)
    print("problems:", bad)
