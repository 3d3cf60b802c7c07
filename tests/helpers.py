from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from sluicebox import schemas

NOW = datetime(2024, 6, 1, 12)


def sale(**changes):
    row = {
        "transaction_id": "T1", "sale_date": date(2024, 5, 1), "sale_hour": 10, "customer_id": "C1",
        "customer_name": "Jane", "product_id": "P1", "product_name": "Phone", "category": "A",
        "sub_category": "B", "quantity": 2, "unit_price": Decimal("10.00"),
        "discount_percentage": Decimal("10.00"), "discount_amount": Decimal("1.00"),
        "gross_amount": Decimal("20.00"), "net_amount": Decimal("19.00"), "profit_margin": Decimal("5.00"),
        "payment_method": "Cash", "payment_category": "Offline", "store_location": "X", "region": "West",
        "is_weekend": 0, "is_holiday": 0, "ingest_date": date(2024, 5, 2),
    }
    return {**row, **changes}


def frame(spark, rows, schema=schemas.BRONZE_SALES):
    return spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)


def silver_frame(spark, rows):
    full = [{"source_file": "f", "processed_at": NOW, **r, "is_weekend": bool(r["is_weekend"]),
             "is_holiday": bool(r["is_holiday"])} for r in rows]
    return frame(spark, full, schemas.SILVER_SALES)


def ntz(value=NOW):
    return F.lit(value).cast("timestamp_ntz")
