"""Check every logical driver view: Spark mapping vs its DuckDB SQL twin."""
import sys

from lakeops.plans.compare import compare, duck_connect
from lakeops.plans.oracle_views import VIEWS, with_views
from lakeops.session import local_session
from lakeops.sources.driver import DriverTables

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
spark = local_session()
T = DriverTables(spark, sf)
con = duck_connect(sf)
bad = 0
for name in VIEWS:
    if name == "titles_all":
        continue
    r = compare(getattr(T, name), con, with_views(f"SELECT * FROM {name}", name))
    print(name, r["ok"], r["spark_rows"], r["oracle_rows"], "" if r["ok"] else r)
    bad += not r["ok"]
sys.exit(1 if bad else 0)
