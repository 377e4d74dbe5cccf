"""Run every registered query against its oracle: ``python tests/run_oracles.py [sf_dir] [name...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventloom.plans.oracles import ORACLES  # noqa: E402
from eventloom.plans.queries import QUERIES  # noqa: E402
from eventloom.session import build_session  # noqa: E402
from tests.oracle import connect, differences  # noqa: E402


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    if os.environ.get("PLAIN"):  # a session with Spark's own defaults
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
    else:
        spark = build_session("oracles", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            diff = differences(df, con, ORACLES[name]) if name in ORACLES else [] if df.count() else ["no rows"]
        except Exception as exc:  # report and go on
            diff = [f"{type(exc).__name__}: {str(exc)[:600]}"]
        kind = "oracle" if name in ORACLES else "rows"
        print(f"{'ok  ' if not diff else 'FAIL'} {name:32s} {kind:6s} {time.time() - start:6.2f}s", flush=True)
        if diff:
            bad += 1
            print(f"   {len(diff)} differences: {diff[0]}", flush=True)
    print(f"{len(names) - bad} of {len(names)} ok")


if __name__ == "__main__":
    main()
