"""Names, schemas and storage layout of the tables a deployment keeps in its store."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sluicebox import schemas
from sluicebox.operators.shaping import conform
from sluicebox.sources.tables import KeyedTable, TableStore

SALES, CUSTOMERS, PRODUCTS = "silver.sales", "silver.customers", "silver.products"
QUARANTINE, LEDGER = "quarantine.sales_failed", "metadata.ingestion_metadata"
BASELINES, AUDIT = "metadata.quality_baselines", "audit.ingestion_runs"
SEVERITY = "audit.run_severity"
# what merges changed since gold was last brought up to date, by the columns that gold groups by
CHANGES = "metadata.silver_changes"
GROUPS = ("sale_date", "customer_id", "product_id", "store_location", "category")

SCHEMAS = {
    SALES: schemas.SILVER_SALES,
    CUSTOMERS: schemas.SILVER_CUSTOMERS,
    PRODUCTS: schemas.SILVER_PRODUCTS,
    "gold.daily_sales": schemas.GOLD_DAILY_SALES,
    "gold.product_performance": schemas.GOLD_PRODUCT_PERFORMANCE,
    "gold.store_performance": schemas.GOLD_STORE_PERFORMANCE,
    "gold.customer_analytics": schemas.GOLD_CUSTOMER_ANALYTICS,
    "gold.category_insights": schemas.GOLD_CATEGORY_INSIGHTS,
    QUARANTINE: schemas.QUARANTINE,
    LEDGER: schemas.LEDGER,
    BASELINES: schemas.QUALITY_BASELINES,
    AUDIT: schemas.AUDIT_RUNS,
    SEVERITY: schemas.RUN_SEVERITY,
}


# folder of the records a remediation run may still change; those it closed lie in a folder of the run
OPEN = "open"
CLOSED_BY = "_closed_by"


class Layers:
    """The medallion's tables in one store. Silver sales are bucketed by their key and month; quarantined
    records lie by the run that closed them; the others are small beside them and replaced whole or
    appended to."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 8):
        self.spark = spark
        self.store = TableStore(spark, root)
        self.sales = KeyedTable(self.store, SALES, SCHEMAS[SALES], ["transaction_id"], "sale_date", buckets)

    def read(self, name: str) -> DataFrame:
        if name == SALES:
            return self.sales.read()
        return self.records() if name == QUARANTINE else self.store.read(name, SCHEMAS[name])

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        return self.store.replace(name, df, SCHEMAS[name])

    def append(self, name: str, df: DataFrame) -> None:
        rows = conform(df, SCHEMAS[name])
        if name == QUARANTINE:
            self.store.append(name, rows.withColumn(CLOSED_BY, F.lit(OPEN)), [CLOSED_BY])
        else:
            self.store.append(name, rows)

    def records(self, where: Column | None = None) -> DataFrame:
        """Quarantined records, of the folders that `where` names (by `_closed_by`)."""
        schema = T.StructType([*SCHEMAS[QUARANTINE], T.StructField(CLOSED_BY, T.StringType())])
        found = self.store.read(QUARANTINE, schema)
        return (found if where is None else found.where(where)).select(*SCHEMAS[QUARANTINE].names)

    def settle(self, records: DataFrame, run_id: str) -> None:
        """Records that were open: those still pending stay, the others go to the run's folder. No file
        that an earlier run closed is read or written."""
        left = F.col("remediation_status") == "pending"
        placed = conform(records, SCHEMAS[QUARANTINE]).withColumn(CLOSED_BY, F.when(left, F.lit(OPEN)).otherwise(F.lit(run_id)))
        done = records.where(left).isEmpty()
        self.store.write_partitions(QUARANTINE, placed, [CLOSED_BY])
        if done:
            # a folder that gets no rows is not replaced
            self.store.delete(f"{self.store.location(QUARANTINE)}/{CLOSED_BY}={OPEN}")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.read(name) for name in SCHEMAS}
