"""From validated bronze rows to silver rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluicebox import schemas
from sluicebox.functions import amounts
from sluicebox.operators.shaping import conform


def shape_silver(good: DataFrame, run_date: Column, processed_at: Column) -> DataFrame:
    """Flags become booleans, the ingest date is the run's date; column order is silver's."""
    extra = [c for c in good.columns if c not in schemas.SILVER_SALES.names]
    shaped = good.withColumns({
        "is_weekend": F.col("is_weekend").cast("boolean"),
        "is_holiday": F.col("is_holiday").cast("boolean"),
        "ingest_date": run_date,
        "processed_at": processed_at,
    })
    base = conform(shaped, schemas.SILVER_SALES)
    return base if not extra else shaped.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.SILVER_SALES], *extra
    )


def derive_amounts(df: DataFrame) -> DataFrame:
    """Gross, discount and net amounts, payment category and weekend flag of raw sales.

    The discount here is that of one unit, whatever the quantity.
    """
    price, share = F.col("unit_price"), F.col("discount_percentage")
    return df.withColumns({
        "discount_amount": amounts.money(price * share / F.lit(100).cast("decimal(3,0)")),
        "gross_amount": amounts.money(price * F.col("quantity").cast("decimal(10,0)")),
        "payment_category": amounts.payment_category(F.col("payment_method")),
        "is_weekend": amounts.is_weekend(F.col("sale_date")).cast("int"),
    }).withColumn("net_amount", amounts.money(F.col("gross_amount") - F.col("discount_amount")))
