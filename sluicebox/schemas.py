"""Declared schemas of every bronze, silver, gold and bookkeeping table.

Counts and quantity totals are bigint and money totals decimal(20,2): at 100 TB a single
store's revenue passes what an int or a decimal(15,2) can hold.
"""

from __future__ import annotations

from pyspark.sql import types as T

TEXT, DAY, TIME, FLAG = T.StringType(), T.DateType(), T.TimestampNTZType(), T.BooleanType()
INT, LONG = T.IntegerType(), T.LongType()
MONEY, SHARE, TOTAL, METRIC = T.DecimalType(10, 2), T.DecimalType(5, 2), T.DecimalType(20, 2), T.DecimalType(15, 2)


def schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# The columns a bronze sales file must have, with the types silver stores them in.
# `ingest_date` comes from the path partition, not from the file.
BRONZE_SALES = schema(
    transaction_id=TEXT, sale_date=DAY, sale_hour=INT, customer_id=TEXT, customer_name=TEXT,
    product_id=TEXT, product_name=TEXT, category=TEXT, sub_category=TEXT, quantity=INT,
    unit_price=MONEY, discount_percentage=SHARE, discount_amount=MONEY, gross_amount=MONEY,
    net_amount=MONEY, profit_margin=SHARE, payment_method=TEXT, payment_category=TEXT,
    store_location=TEXT, region=TEXT, is_weekend=INT, is_holiday=INT, ingest_date=DAY,
)

SILVER_SALES = schema(
    transaction_id=TEXT, sale_date=DAY, sale_hour=INT, customer_id=TEXT, customer_name=TEXT,
    product_id=TEXT, product_name=TEXT, category=TEXT, sub_category=TEXT, quantity=INT,
    unit_price=MONEY, discount_percentage=SHARE, discount_amount=MONEY, gross_amount=MONEY,
    net_amount=MONEY, profit_margin=SHARE, payment_method=TEXT, payment_category=TEXT,
    store_location=TEXT, region=TEXT, is_weekend=FLAG, is_holiday=FLAG, ingest_date=DAY,
    source_file=TEXT, processed_at=TIME,
)

SILVER_CUSTOMERS = schema(
    customer_id=TEXT, customer_name=TEXT, first_purchase_date=DAY, total_purchases=LONG,
    total_revenue=TOTAL, average_order_value=MONEY, customer_segment=TEXT, last_purchase_date=DAY,
    days_since_last_purchase=INT,
)

SILVER_PRODUCTS = schema(
    product_id=TEXT, product_name=TEXT, category=TEXT, sub_category=TEXT, min_unit_price=MONEY,
    max_unit_price=MONEY, avg_unit_price=MONEY, total_quantity_sold=LONG, total_revenue=TOTAL,
)

GOLD_DAILY_SALES = schema(
    sale_date=DAY, total_transactions=LONG, total_quantity_sold=LONG, gross_revenue=TOTAL,
    total_discounts=TOTAL, net_revenue=TOTAL, average_order_value=MONEY, unique_customers=LONG,
    unique_products=LONG, top_category=TEXT,
)

GOLD_PRODUCT_PERFORMANCE = schema(
    product_id=TEXT, product_name=TEXT, category=TEXT, total_quantity_sold=LONG,
    total_revenue=TOTAL, average_unit_price=MONEY, total_discount_given=TOTAL,
    number_of_transactions=LONG, average_quantity_per_transaction=MONEY,
)

GOLD_STORE_PERFORMANCE = schema(
    store_location=TEXT, region=TEXT, total_transactions=LONG, total_revenue=TOTAL,
    average_order_value=MONEY, total_customers_served=LONG, top_selling_category=TEXT,
)

GOLD_CUSTOMER_ANALYTICS = schema(
    customer_id=TEXT, customer_name=TEXT, total_purchases=LONG, total_revenue=TOTAL,
    average_order_value=MONEY, favorite_category=TEXT, favorite_payment_method=TEXT,
    most_visited_store=TEXT, customer_tier=TEXT,
)

GOLD_CATEGORY_INSIGHTS = schema(
    category=TEXT, total_products_sold=LONG, total_revenue=TOTAL,
    average_discount_percentage=SHARE, number_of_transactions=LONG, average_order_value=MONEY,
)

QUARANTINE = schema(
    id=LONG, payload=TEXT, error_reason=TEXT, failed_at=TIME, ingestion_run_id=TEXT,
    source_file=TEXT, corrected_by=TEXT, corrected_at=TIME, replayed=FLAG, replayed_at=TIME,
    remediation_status=TEXT, retry_count=INT,
)

LEDGER = schema(
    file_path=TEXT, dataset_name=TEXT, checksum=TEXT, ingest_date=DAY, status=TEXT,
    record_count=LONG, processed_at=TIME, run_id=TEXT, error_message=TEXT, created_at=TIME,
)

QUALITY_BASELINES = schema(
    table_name=TEXT, metric_name=TEXT, metric_value=METRIC, recorded_at=TIME,
)

AUDIT_RUNS = schema(
    ingestion_run_id=TEXT, started_at=TIME, finished_at=TIME, files_scanned=T.ArrayType(TEXT),
    rows_read=LONG, rows_written_silver=LONG, rows_quarantined=LONG, status=TEXT, operator=TEXT,
)

RUN_SEVERITY = schema(
    ingestion_run_id=TEXT, status_text=TEXT, severity=TEXT, quarantine_rate=T.DoubleType(), finished_at=TIME,
)
