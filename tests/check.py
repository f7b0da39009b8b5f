"""python tests/check.py <sf> [query ...]: compare queries with their SQL and time them."""

import sys
import time
import traceback

sys.path[:0] = ["/root/repo", "/root/repo/tests"]

import compare  # noqa: E402
from duebook.session import local_session  # noqa: E402
from duebook.plans import ORACLES, QUERIES  # noqa: E402

sf_dir = f"/root/testdata/sf{sys.argv[1]}"
names = sys.argv[2:] or list(QUERIES)
spark = local_session(8)
con = compare.connect(sf_dir)
bad = 0
for name in names:
    t = time.time()
    try:
        mine = compare.spark_rows(QUERIES[name](spark, sf_dir))
        t1 = time.time() - t
        if name not in ORACLES:
            print(f"rows-only {name}: {len(mine[1])} rows {t1:.1f}s sample {mine[1][:2]}", flush=True)
            continue
        t = time.time()
        theirs = compare.duck_rows(con, ORACLES[name])
        diff = compare.differences(mine, theirs)
        if diff:
            bad += 1
            print(f"DIFF {name} {t1:.1f}s: {diff}", flush=True)
        else:
            print(f"ok {name}: {len(mine[1])} rows, spark {t1:.1f}s, sql {time.time() - t:.1f}s {str(mine[1][len(mine[1])//2])[:150] if mine[1] else 'EMPTY'}", flush=True)
    except Exception as e:
        bad += 1
        print(f"FAIL {name}: {str(e)[:900]}", flush=True)
        if "-v" in sys.argv:
            traceback.print_exc()
print("bad:", bad)
