"""Run every query key against its oracle: python tests/run_oracle.py [sf_dir] [key ...]"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from compare import compare, duck  # noqa: E402
from cohortlens.session import local_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark = local_session(8, 8)
    con = duck(sf)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k, fn in qs.items():
        if only and k not in only:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf)
            if k in sqls:
                probs, ns, nd = compare(df, con, sqls[k])
            else:
                ns, nd, probs = df.count(), None, []
        except Exception as e:  # noqa: BLE001
            probs, ns, nd = [f"ERROR {type(e).__name__}: {str(e)[:400]}"], None, None
        status = "OK " if not probs else "BAD"
        if k not in sqls and not probs:
            status = "ROW"
        bad += bool(probs)
        print(f"{status} {k:32s} spark={ns} duck={nd} {time.time()-t0:.1f}s {' | '.join(probs)}", flush=True)
    print(f"{bad} failing of {len([k for k in qs if not only or k in only])}")


if __name__ == "__main__":
    main()
