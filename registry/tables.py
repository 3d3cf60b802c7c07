"""Silver, quarantine and gold tables of the registered queries, written once per application."""

from __future__ import annotations

import re
import threading

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluicebox import schemas, specs
from sluicebox.operators import gold, quarantine, silver, upsert, validation
from sluicebox.session import shared_dir
from sluicebox.sources import orders
from sluicebox.sources.tables import TableStore

NOW = "2002-01-01 00:00:00"
AS_OF_DATE = "2002-01-01"
# sales to a bucket of a stored silver table: a merge sorts a bucket in one task
ROWS_PER_BUCKET = 1_000_000
FEWEST_BUCKETS = 2

_lock = threading.RLock()


def now():
    return F.lit(NOW).cast("timestamp_ntz")


def as_of_date():
    return F.lit(AS_OF_DATE).cast("date")


def midnight(day: str):
    return F.col(day).cast("timestamp_ntz")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "bronze.sales")


def silver_rows(bronze_sales: DataFrame) -> DataFrame:
    """Good rows in silver's shape, before the merge; each run's date is its ingest date."""
    good = validation.good_rows(bronze_sales, specs.SALES).drop(
        "record_id", "run_id", "real_customer_id", "real_quantity"
    )
    return silver.shape_silver(good, F.col("ingest_date"), midnight("ingest_date"))


def latest_silver(bronze_sales: DataFrame, *within: str) -> DataFrame:
    """The latest row of each transaction; `within` names columns that all rows of a transaction share."""
    rows = silver_rows(bronze_sales)
    latest = upsert.latest_per_key(rows, [*within, "transaction_id"], [F.col("arrival").desc()])
    return latest.select(*schemas.SILVER_SALES.names)


def silver_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales come out of the join with their orders by order key, which rows of a transaction share: as they
    are, no wide row is shuffled again to find the latest; the stored copy has lost that order."""
    return latest_silver(orders.bronze_sales(spark, sf_dir, "l_orderkey"), "l_orderkey")


def quarantine_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every bad row, in the states remediation meets.

    Fixed rules on supplier and line number give: payloads an analyst corrected, broken JSON,
    earlier retries, records already remediated, and old records closed without a status.
    """
    bad = validation.bad_rows(bronze(spark, sf_dir), specs.SALES)
    supplier, line = F.col("arrival.l_suppkey"), F.col("record_id") % 8
    corrected, broken = supplier % 3 == 0, supplier % 11 == 5
    done, legacy = supplier % 13 == 1, supplier % 17 == 2
    bad = bad.withColumns({
        "customer_id": F.when(corrected, F.col("real_customer_id")).otherwise(F.col("customer_id")),
        "quantity": F.when(corrected, F.col("real_quantity")).otherwise(F.col("quantity")),
    })
    rows = quarantine.quarantine_rows(
        bad.withColumns({"_c": corrected, "_b": broken, "_d": done, "_l": legacy, "_r": line % 5}),
        specs.SALES.columns.names, F.col("record_id"), F.col("run_id"), midnight("ingest_date"),
        keep=["_c", "_b", "_d", "_l", "_r"],
    )
    hours = lambda n: F.col("failed_at") + F.expr(f"INTERVAL {n} HOURS")
    return rows.withColumns({
        "payload": F.when(F.col("_b"), F.concat(F.lit("{"), "payload")).otherwise(F.col("payload")),
        "corrected_by": F.when(F.col("_d"), F.lit("remediation_dag")).when(F.col("_c"), F.lit("analyst")),
        "corrected_at": F.when(F.col("_c"), hours(1)),
        "replayed": F.col("_d") | F.col("_l"),
        "replayed_at": F.when(F.col("_d"), hours(2)),
        "remediation_status": F.when(F.col("_d"), F.lit("remediated")).otherwise(F.lit("pending")),
        "retry_count": F.col("_r").cast("int"),
    }).select(*schemas.QUARANTINE.names)


def _over_silver(build):
    return lambda spark, sf_dir: build(table(spark, sf_dir, "silver.sales"))


BUILDERS = {
    "bronze.sales": orders.bronze_sales,
    "silver.sales": silver_sales,
    "quarantine.sales_failed": quarantine_sales,
    "silver.customers": _over_silver(lambda s: gold.dim_customers(s, as_of_date())),
    "silver.products": _over_silver(gold.dim_products),
    "gold.daily_sales": _over_silver(gold.daily_sales),
    "gold.product_performance": _over_silver(gold.product_performance),
    "gold.store_performance": _over_silver(gold.store_performance),
    "gold.customer_analytics": _over_silver(lambda s: gold.customer_analytics(s, TIERS)),
    "gold.category_insights": _over_silver(gold.category_insights),
}

# the star's customers spend far more than the default bounds, so the bounds are scaled
TIERS = (("Platinum", 1000000), ("Gold", 600000), ("Silver", 300000))


def store(spark: SparkSession, sf_dir: str) -> TableStore:
    slug = re.sub(r"\W+", "_", sf_dir).strip("_")
    return TableStore(spark, f"{shared_dir(spark)}/sluicebox/{spark.sparkContext.applicationId}/{slug}")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A written table, built from the given tables when the application first needs it."""
    tables = store(spark, sf_dir)
    with _lock:
        if not tables.exists(name):
            tables.write(name, BUILDERS[name](spark, sf_dir))
    return tables.read(name)


def buckets(spark: SparkSession, sf_dir: str) -> int:
    """Buckets of a stored silver table, by the number of order lines, which Parquet footers hold."""
    return max(FEWEST_BUCKETS, -(-orders.table(spark, sf_dir, "lineitem").count() // ROWS_PER_BUCKET))


class Lazy(dict):
    """Tables by name, each written on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = table(self.spark, self.sf_dir, name)
        return self[name]
