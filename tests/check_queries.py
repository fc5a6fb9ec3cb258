"""Compare registered queries with their SQL: ``python tests/check_queries.py [folder] [name ...]``."""

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from __spark_entry__ import oracle_sql, queries  # noqa: E402
from oracle import compare, connect  # noqa: E402
from millrace.session import build_session  # noqa: E402

if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), oracle_sql(), 0
    for name, fn in queries().items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        t = time.time()
        try:
            got = fn(spark, folder).toPandas()
            spent = time.time() - t
            t = time.time()
            if name in sqls:
                diff = compare(got, con.execute(sqls[name]).fetchdf())
                note = "same" if diff is None else f"DIFFERENT {diff}"
                bad += diff is not None
            else:
                note = "rows only"
            print(f"{name:34s} {len(got):8d} rows {spent:6.2f}s sql {time.time() - t:5.2f}s {note}", flush=True)
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:34s} FAILED {type(e).__name__}: {str(e)[:600]}", flush=True)
    print("bad:", bad)
    sys.exit(bad > 0)
