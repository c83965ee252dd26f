"""python tests/check_all.py [folder] [name ...]: time every report and compare it with its SQL."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from oracle import connect, differences  # noqa: E402

from purseflow import plans  # noqa: E402,F401
from purseflow.plans.registry import CHECKS, REPORTS  # noqa: E402
from purseflow.session import build_session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    names = sys.argv[2:] or list(REPORTS)
    spark = build_session("check", "local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            df = REPORTS[name](spark, folder)
            if name in CHECKS:
                found = differences(df, con, CHECKS[name])
                note = "ok" if not found else "; ".join(found)
            else:
                found, note = [], f"{len(df.collect())} rows, no SQL"
        except Exception as exc:  # report and go on
            found, note = [exc], f"{type(exc).__name__}: {str(exc)[:900]}"
        failed += bool(found)
        print(f"{'FAIL' if found else 'pass'} {name} {time.time() - start:.2f}s {note}", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
