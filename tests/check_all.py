"""Run registered queries against their SQL: python tests/check_all.py FOLDER [NAME PREFIXES...]"""

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import compare, duck  # noqa: E402

from herdframe.catalog import REGISTRY, oracle_text, run  # noqa: E402
from herdframe.session import local_session  # noqa: E402


def main():
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark, con = local_session(8), duck(folder)
    bad = 0
    for name, (_, sql) in REGISTRY.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = run(name, spark, folder)
            if sql is None:
                message = None
                note = f"rows {len(df.collect())}"
            else:
                message, note = compare(df, con, oracle_text(sql)), ""
        except Exception as e:
            text = str(e).strip().split("\n")
            message, note = f"{type(e).__name__}: {' '.join(text[:3])[:400]}", ""
            if os.environ.get("TRACE"):
                traceback.print_exc()
        took = time.time() - start
        bad += message is not None
        print(f"{'ok  ' if message is None else 'FAIL'} {took:6.2f}s {name} {note}{message or ''}", flush=True)
    print("failures:", bad)


main()
