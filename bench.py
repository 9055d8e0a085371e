"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local cores. Every query is run once to warm up and once timed; the
result is consumed on the executors, the derivation of the tables from the given ones included.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyframe.operators.checks import run_everywhere  # noqa: E402
from tallyframe.plans.library import query  # noqa: E402
from tallyframe.plans.session import tune  # noqa: E402

HEADLINES = ["tpch.q1", "tpch.q3", "tpch.q5", "tpch.q6", "tpch.q9", "tpch.q18", "tpch.q21", "tpcds.q3", "tpcds.q4", "tpcds.q14a", "tpcds.q23a", "tpcds.q28", "tpcds.q39a",
             "tpcds.q49", "tpcds.q51", "tpcds.q64", "tpcds.q67", "tpcds.q72", "tpcds.q78", "tpcds.q95", "impala.q79", "big.q3C", "join.single_key.full", "agg.num_groups", "log.smoothed_median",
             "udf.group_apply"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = tune(SparkSession.builder.master(f"local[{cpus}]").appName("bench").config("spark.sql.shuffle.partitions", cpus).config("spark.driver.memory", "16g")
                 .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for key in os.environ.get("BENCH_QUERIES", ",".join(HEADLINES)).split(","):
        for _ in range(2):
            start = time.perf_counter()
            run_everywhere(query(key).run(spark, folder))
            seconds[key] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
