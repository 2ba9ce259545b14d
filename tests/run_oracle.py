"""Command line: python tests/run_oracle.py [sf_dir] [key ...]"""

import sys
import traceback
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from oracle import compare, duck  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from lossgrid.plans.registry import load_all  # noqa: E402

if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf)
    tally = {}
    for key, q in load_all().items():
        if wanted and not any(key == w or (w.endswith("*") and key.startswith(w[:-1])) for w in wanted):
            continue
        try:
            status, note = compare(spark, con, q, sf)
        except Exception as e:  # report and go on
            status, note = "ERROR", (str(e).strip().splitlines() or [repr(e)])[0][:400]
            if wanted:
                traceback.print_exc()
        tally[status] = tally.get(status, 0) + 1
        print(f"{status:6}{key:32}{note}", flush=True)
    print(tally)
