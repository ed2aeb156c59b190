"""Compare every bound query with its SQL: python tests/check_all.py [folder] [name ...]"""

import sys
import time
import traceback
from pathlib import Path

sys.path[:0] = [str(Path(__file__).resolve().parents[1]), str(Path(__file__).resolve().parent)]

from oracle import connect, differences  # noqa: E402

from goldseam.plans.bound import ORACLES, QUERIES  # noqa: E402
from goldseam.session import build_session  # noqa: E402


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    failed = 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                found = differences(spark, con, name, QUERIES[name], ORACLES[name], folder)
            else:
                found = [] if QUERIES[name](spark, folder).toArrow().num_rows else ["no rows at all"]
        except Exception:
            found = [traceback.format_exc(limit=-2)[:900]]
        failed += bool(found)
        print(f"{'BAD ' if found else 'ok  '} {name} {time.time() - start:.2f}s", *found, sep="\n     " if found else " ", flush=True)
    print(f"{len(names) - failed} of {len(names)} agree")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main()))
