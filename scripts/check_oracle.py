"""Run registered queries in Spark and their oracle SQL in DuckDB; report matches.

usage: python scripts/check_oracle.py [sf_dir] [name-substring ...]
"""
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeops.plans import registry  # noqa: E402
from lakeops.plans.compare import compare, duck_connect  # noqa: E402
from lakeops.session import local_session  # noqa: E402

args = sys.argv[1:]
sf = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
registry.load_all()
spark = local_session()
con = duck_connect(sf)
bad = []
for name, fn in registry.QUERIES.items():
    if args and not any(a in name for a in args):
        continue
    t = time.time()
    try:
        df = fn(spark, sf)
        if name in registry.ORACLE:
            r = compare(df, con, registry.ORACLE[name])
        else:
            r = {"ok": None, "spark_rows": df.count(), "oracle_rows": None}
    except Exception as e:  # report and continue
        r = {"ok": False, "reason": f"{type(e).__name__}: {str(e)[:600]}", "spark_rows": None, "oracle_rows": None}
    print(f"{name:40s} {str(r['ok']):5s} {r['spark_rows']} {r['oracle_rows']} {time.time()-t:.1f}s"
          + ("" if r["ok"] is not False else f"\n    {r}"), flush=True)
    if r["ok"] is False:
        bad.append(name)
print("FAILED:", bad)
