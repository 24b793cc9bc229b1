"""Compare every registered query with its SQL: python tests/check_all.py [folder] [name part ...]"""

import os
import sys
import time
import traceback

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

import oracle  # noqa: E402
from tallygrid.catalog import load  # noqa: E402
from tallygrid.session import local_session  # noqa: E402


def main(folder="/root/testdata/sf0.01", *parts):
    queries, sql = load()
    spark = local_session(cores=8)
    con = oracle.connect(folder)
    bad = 0
    for name, build in queries.items():
        if parts and not any(name.startswith(p) for p in parts):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            note = oracle.difference(df, con, sql[name]) if name in sql else f"rows only: {len(df.collect())}"
            verdict = "ok" if note is None else ("--" if name not in sql else "BAD")
        except Exception as error:  # noqa: BLE001
            note, verdict = "".join(traceback.format_exception_only(error))[:1500], "ERR"
        bad += verdict in ("BAD", "ERR")
        print(f"{verdict:4}{name:45}{time.time() - start:7.2f}s  {note or ''}", flush=True)
    print("problems:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
