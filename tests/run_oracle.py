"""Run every registered query against its oracle: python tests/run_oracle.py [sf_dir] [name...]"""

import json
import sys
import time

sys.path.insert(0, ".")
sys.path.insert(0, "tests")

import __spark_entry__ as E  # noqa: E402
from oracle_harness import compare, duck  # noqa: E402

from segmenta.session import get_spark  # noqa: E402

d = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
names = sys.argv[2:]
spark = get_spark("oracle", cpus=8)
con = duck(d)
Q, S = E.queries(), E.oracle_sql()
bad = 0
for name, fn in Q.items():
    if names and name not in names:
        continue
    t = time.time()
    if name not in S:
        try:
            n = fn(spark, d).count()
            print(f"ROWS-ONLY {name}: {n} rows ({time.time()-t:.1f}s)")
        except Exception as e:
            bad += 1
            print(f"ERROR {name}: {type(e).__name__}: {str(e)[:400]}")
        continue
    try:
        r = compare(spark, d, name, fn, S[name], con)
    except Exception as e:
        bad += 1
        print(f"ERROR {name}: {type(e).__name__}: {str(e)[:600]}")
        continue
    ok = r["hash_match"] and r["rows"][0] == r["rows"][1]
    bad += not ok
    print(f"{'OK ' if ok else 'BAD'} {name}: rows={r['rows']} ({time.time()-t:.1f}s)")
    if not ok:
        print(json.dumps({k: v for k, v in r.items() if k != 'name'}, default=str)[:2500])
print("failures:", bad)
