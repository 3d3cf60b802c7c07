"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data (default sf0.1), BENCH_CPUS the cores. The `build_*` entries time the
tables the other queries read, from the raw files to written Parquet, and `stored_merge` two merges
into a deployment's bucketed silver; each of the others is the
second of two runs, with its whole result computed and discarded.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry import deployed, tables  # noqa: E402
from registry.queries import QUERIES  # noqa: E402
from sluicebox.session import build_session  # noqa: E402

HEADLINE = [
    "good_bad_split", "error_reason_counts", "full_validation", "uniqueness_rows", "dedup_latest",
    "upsert_merge", "file_checksum", "quarantine_payload", "audit_run", "dim_customers",
    "dim_products", "daily_sales", "product_performance", "store_performance",
    "customer_analytics", "category_insights", "regional_sales", "dq_completeness",
    "dq_orphan_customers", "remediation_run", "alert_throttle", "daily_growth",
    "top_products", "customer_details", "quality_score",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app="bench", master=f"local[{cpus}]", spark__driver__memory="16g",
        spark__sql__shuffle__partitions=cpus, spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    # the JVM's start is not part of any query
    spark.range(1000000).selectExpr("sum(id)").collect()
    seconds = {
        f"build_{name}": timed(lambda n=name: tables.table(spark, sf_dir, n)) for name in tables.BUILDERS
    }
    seconds["stored_merge"] = timed(lambda: deployed.merged(spark, sf_dir))
    for name in HEADLINE:
        run = lambda q=QUERIES[name]: q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        run()
        seconds[name] = timed(run)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")), "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
