"""Command-line comparison of all (or the named) queries: python -m tests.check_queries [sf] [name...]"""

import sys
import time
import traceback

from sluice.plans import all_queries
from sluice.session import local_session
from tests import compare


def main(args):
    folder = f"/root/testdata/sf{args[0] if args else '0.01'}"
    names = args[1:]
    spark = local_session("check", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = compare.duck(folder)
    bad = 0
    for name, q in all_queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = q.run(spark, folder)
            cols, rows = compare.spark_rows(df)
            spent = time.time() - start
            if q.sql is None:
                print(f"rows {name}: {len(rows)} rows {spent:.1f}s", flush=True)
                continue
            dcols, drows = compare.duck_rows(con, q.sql)
            gaps = compare.type_gaps(df, con, q.sql)
            if cols == dcols and rows == drows and not gaps:
                print(f"ok   {name}: {len(rows)} rows {spent:.1f}s", flush=True)
            else:
                bad += 1
                print(f"DIFF {name}: {cols} vs {dcols}; {len(rows)} vs {len(drows)}; types {gaps}", flush=True)
                only_s, only_d = list(set(rows) - set(drows))[:3], list(set(drows) - set(rows))[:3]
                print("  spark only", str(only_s)[:1500])
                print("  duck only ", str(only_d)[:1500])
        except Exception:
            bad += 1
            print(f"FAIL {name}: {traceback.format_exc()[-1800:]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1:])
