"""Run every registered query and print how it compares. Usage: check_all.py [folder] [name ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from claimlens.session import local_session  # noqa: E402

folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:] or list(entry.queries())
spark = local_session("check", cpus=8)
con = oracle.connect(folder)
bad = 0
for name in names:
    start = time.time()
    try:
        df = entry.queries()[name](spark, folder)
        sql = entry.oracle_sql().get(name)
        if sql is None:
            n = len(df.collect())
            print(f"rows  {name} {n} {time.time() - start:.1f}s", flush=True)
            continue
        problems = oracle.compare(df, sql, con)
    except Exception as error:  # noqa: BLE001
        problems = [f"{type(error).__name__}: {str(error)[:600]}"]
    bad += bool(problems)
    print(("ok    " if not problems else "WRONG ") + f"{name} {time.time() - start:.1f}s " + " | ".join(problems), flush=True)
print(f"{len(names)} queries, {bad} wrong")
