"""Small sales files for tests; values follow from row numbers."""

from pyspark.sql import functions as F

MONEY = "decimal(10,2)"


def sales(spark, rows, mode="clean", seed=1):
    n = F.col("n")
    price, quantity = (n % 90 + 10).cast(MONEY), (n * seed % 9 + 1).cast("int")
    spoiled = (n <= rows // 5) if mode == "mixed" else F.lit(False)
    gross = (price * quantity).cast(MONEY)
    return spark.range(1, rows + 1).withColumnRenamed("id", "n").select(
        F.concat(F.lit("TXN"), F.lpad(n.cast("string"), 8, "0")).alias("transaction_id"),
        F.date_add(F.lit("2024-03-01").cast("date"), (n % 20).cast("int")).alias("sale_date"), (n % 24).cast("int").alias("sale_hour"),
        F.when(~spoiled, F.concat(F.lit("CUST"), n % 50)).alias("customer_id"), F.concat(F.lit("Buyer "), n % 50).alias("customer_name"),
        F.concat(F.lit("PROD"), n % 30).alias("product_id"), F.concat(F.lit("Thing "), n % 30).alias("product_name"),
        F.concat(F.lit("Kind "), n % 4).alias("category"), F.concat(F.lit("Sort "), n % 7).alias("sub_category"),
        F.when(spoiled, F.lit(-5)).otherwise(quantity).alias("quantity"), price.alias("unit_price"), F.lit(0).cast(MONEY).alias("discount_percentage"),
        F.lit(0).cast(MONEY).alias("discount_amount"), gross.alias("gross_amount"), gross.alias("net_amount"), F.lit(5).cast(MONEY).alias("profit_margin"),
        F.lit("Cash").alias("payment_method"), F.lit("Offline").alias("payment_category"), F.concat(F.lit("Shop "), n % 3).alias("store_location"),
        F.lit("Middle").alias("region"), F.lit(0).alias("is_weekend"), F.lit(0).alias("is_holiday"),
    )


def invalid_sales(spark, rows, variant):
    good = sales(spark, rows)
    if variant == "missing_required_columns":
        return good.select("transaction_id", "sale_date", "quantity", "unit_price")
    texts = ("sale_date", "sale_hour", "quantity", "unit_price", "is_weekend", "is_holiday")
    return good.withColumns({c: F.col(c).cast("string") for c in texts}).withColumn("transaction_id", F.lit(7).cast("bigint"))
