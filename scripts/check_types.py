"""Compare column types of every registered query with its DuckDB oracle (sf0.001)."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakeops.plans import registry  # noqa: E402
from lakeops.plans.compare import duck_connect  # noqa: E402
from lakeops.session import local_session  # noqa: E402

MAP = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "date": "DATE",
       "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def spark_type(t: str) -> str:
    if t.startswith("decimal"):
        return t.upper().replace(" ", "")
    return MAP.get(t, t)


sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
registry.load_all()
spark = local_session()
con = duck_connect(sf)
bad = 0
for name, sql in registry.ORACLE.items():
    df = registry.QUERIES[name](spark, sf)
    st = {f.name: spark_type(f.dataType.simpleString()) for f in df.schema.fields}
    d = con.execute(f"DESCRIBE {sql}").fetchall()
    dt = {r[0]: r[1].replace(" ", "") for r in d}
    diff = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
    if diff:
        bad += 1
        print(name, diff, flush=True)
print("queries with type differences:", bad)
