"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores.
Each query runs twice to warm up and then three times; the median counts.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
WARM_UPS = 2
RUNS = 3


def drain(frame):
    """Compute every column of every row and keep nothing."""
    frame.write.format("noop").mode("overwrite").save()


def headline(spark):
    from rowloom import random_matrix, relative_error, rows_to_coo, truncated_svd
    from rowloom.plans import matrices as M
    from rowloom.plans.queries import all_queries

    registered = all_queries()

    def svd(rows, method="auto"):
        found = truncated_svd(rows, 5, method)
        found.S.collect()
        relative_error(rows, found.V).collect()

    queries = {
        "random_2000x1000": lambda: drain(random_matrix(spark, 2000, 1000)),
        "svd_random_2000x1000": lambda: svd(random_matrix(spark, 2000, 1000)),
        "svd_embeddings": lambda: svd(M.embeddings(spark, SF_DIR)),
        "svd_embeddings_tsqr": lambda: svd(M.embeddings(spark, SF_DIR), "tsqr"),
        "svd_lines": lambda: truncated_svd(M.lines(spark, SF_DIR), 4).S.collect(),
        "svd_u_lines": lambda: drain(truncated_svd(M.lines(spark, SF_DIR), 4).U),
        "cells_of_lines": lambda: rows_to_coo(M.lines(spark, SF_DIR)).agg(F.sum("x")).collect(),
    }
    for name in (
        "gramian",
        "gramian_lines",
        "frobenius_sq_lines",
        "coo_to_rows",
        "blocks_roundtrip",
        "transpose_rows",
        "zero_fill",
        "select_rows",
        "matmul",
        "matmul_blocks",
        "project_rows",
        "matrix_diff",
        "layout_assign_mc_mr",
        "put_get_orders",
        "put_get_vc_star",
        "put_get_mc_mr",
        "read_libsvm_matrix",
    ):
        queries[name] = lambda query=registered[name]: drain(query(spark, SF_DIR))
    return queries


def main():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, run in headline(spark).items():
        for _ in range(WARM_UPS):
            run()
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    spark.stop()
    result = {
        "metric": "headline queries, sum of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": int(CPUS),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
