"""Run registered queries against their DuckDB oracle: python tests/run_oracle.py [names...]"""
import sys
import time
import traceback

sys.path.insert(0, ".")
from penmark.session import build_session  # noqa: E402
from penmark.plans.catalog import ORACLE, QUERIES, load_all  # noqa: E402
from tests.oracle import compare, duck  # noqa: E402

sf = "/root/testdata/sf0.01"
load_all()
names = sys.argv[1:] or list(QUERIES)
spark = build_session("local[8]", shuffle_partitions=8)
con = duck(sf)
bad = 0
for n in names:
    t = time.time()
    try:
        df = QUERIES[n](spark, sf)
        if n in ORACLE:
            ok, msg = compare(df, ORACLE[n], con)
        else:
            ok, msg = True, f"rows-only: {df.count()} rows"
    except Exception as e:  # noqa: BLE001
        ok, msg = False, "".join(traceback.format_exception_only(e))[-1500:]
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {n:32s} {time.time()-t:6.1f}s {msg}", flush=True)
print(f"{len(names)-bad}/{len(names)} ok")
