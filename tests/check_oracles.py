"""Compare registered queries with their SQL: python tests/check_oracles.py [sf] [name ...]."""

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from draftlake.registry import ORACLES, QUERIES  # noqa: E402
from draftlake.session import local_session  # noqa: E402
from oracle import compare, connect  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    names = sys.argv[2:] or list(QUERIES)
    names = [n for a in names for n in (QUERIES if a == "all" else [a])]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for n in names:
        try:
            problem, rows, ts, td = compare(spark, con, sf_dir, n)
        except Exception as e:  # report and go on with the next query
            problem, rows, ts, td = f"{type(e).__name__}: {str(e)[:600]}", -1, 0.0, 0.0
        bad += problem is not None
        mark = "OK  " if problem is None else "FAIL"
        print(f"{mark} {n} rows={rows} spark={ts:.2f}s duckdb={td:.2f}s{'' if n in ORACLES else ' (no SQL)'} {problem or ''}",
              flush=True)
    print(f"{len(names) - bad} of {len(names)} fine")
    sys.exit(1 if bad else 0)
