"""Run every registered query against its DuckDB SQL (local gate).

usage: python tests/run_oracle.py [sf_dir] [name-substring ...]
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tests.oracle import compare, duck  # noqa: E402
from tidemark.session import local_session  # noqa: E402
import __spark_entry__ as E  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
pats = sys.argv[2:]
spark = local_session()
con = duck(sf)
qs, sqls = E.queries(), E.oracle_sql()
bad = 0
for name, fn in qs.items():
    if pats and not any(p in name for p in pats):
        continue
    t = time.time()
    df = fn(spark, sf)
    if name in sqls:
        r = compare(df, sqls[name], con)
    else:
        r = {"rows_spark": df.count(), "ok": None, "rows_only": True}
    r["sec"] = round(time.time() - t, 2)
    bad += r["ok"] is False
    print(name, json.dumps(r, default=str), flush=True)
print("FAILED" if bad else "ALL OK", bad)
