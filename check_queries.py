"""Compare registered queries with their SQL: ``python check_queries.py [sf_dir] [name-part ...]``."""

from __future__ import annotations

import sys
import time
import traceback

sys.path.insert(0, "tests")

import oracle  # noqa: E402

from voltaria import queries  # noqa: E402
from voltaria.session import build_session  # noqa: E402


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    queries.load_all()
    spark = build_session("check", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle.connect(sf_dir)
    bad = 0
    for name, run in queries.QUERIES.items():
        if argv[1:] and not any(part in name for part in argv[1:]):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            sql = queries.ORACLES.get(name)
            found = oracle.compare(df, con, sql) if sql else ([] if df.collect() else ["no rows"])
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:600]}"]
            if "-v" in argv:
                traceback.print_exc()
        bad += bool(found)
        mark = "ok  " if not found else "FAIL"
        print(f"{mark} {name:34s} {time.time() - start:6.2f}s {'' if name in queries.ORACLES else '(rows only)'}", *found, sep="\n     " if found else " ", flush=True)
    print("failed:", bad)
    return bad


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
