"""Compare Spark output types with DuckDB result types for every SQL twin."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ragloom.plans.registry import load_all  # noqa: E402
from ragloom.session import local_session  # noqa: E402
from ragloom.sources.tables import TABLES  # noqa: E402

SF = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
MAP = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
       "date": "DATE", "timestamp": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT"}
spark = local_session(4, 4)
con = duckdb.connect()
con.execute("SET TimeZone='UTC'")
for t in TABLES:
    con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
bad = 0
for name, r in load_all().items():
    if not r.sql:
        continue
    sdf = r.fn(spark, SF)
    st = {f.name: MAP.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = con.sql(r.sql)
    dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    diffs = {c: (st.get(c), dt.get(c)) for c in set(st) | set(dt) if st.get(c) != dt.get(c)}
    if diffs:
        bad += 1
        print(f"{name}: {diffs}")
print("queries with type differences:", bad)
spark.stop()
