"""Sales in the bronze shape, derived from an order-and-lineitem star schema.

The star holds clean facts, so a fixed rule on the order key makes some of them dirty and gives the
validation operators work: order keys ending in 0 lose their customer and those one above a
multiple of 20 get the quantity -999. Amounts use the true quantity. Every row is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with customer, part, nation and region.

    Orders meet their customers first: that shuffles orders instead of the far larger lineitem. Lines meet
    their parts before their orders, so that only their few own columns are shuffled by part, and what
    comes out lies by order key.
    Spark broadcasts the side tables while their size allows and splits skewed keys at run time.
    """
    t = lambda name: table(spark, sf_dir, name)
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    buyers = t("customer").join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    orders = t("orders").join(buyers, F.col("o_custkey") == F.col("c_custkey"))
    # a price becomes a decimal once a part, not once a line
    parts = t("part").withColumn("_price", F.col("p_retailprice").cast("decimal(10,2)"))
    lines = t("lineitem").join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def bronze_sales(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """The 23 bronze columns plus `source_file`, `record_id`, `run_id`, `arrival` (the order in
    which rows of one transaction arrived) and the true customer and quantity; columns of the order
    lines named in `keep` are carried along."""
    lines = order_lines(spark, sf_dir)
    key, qty = F.col("l_orderkey"), F.col("l_quantity").cast("int")
    ingest = F.col("l_shipdate").cast("date")
    price = F.col("_price")
    gross = (price * qty.cast("decimal(10,0)")).cast("decimal(10,2)")
    discount = F.round(gross * F.col("l_discount").cast("decimal(4,2)"), 2).cast("decimal(10,2)")
    day = F.col("o_orderdate").cast("date")
    online = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "3-MEDIUM")
    return lines.select(
        F.concat(F.lit("TXN-"), key, F.lit("-"), F.col("l_linenumber")).alias("transaction_id"),
        day.alias("sale_date"),
        (key % 24).cast("int").alias("sale_hour"),
        F.when(key % 10 != 0, F.concat(F.lit("CUST"), F.col("c_custkey"))).alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("PROD"), F.col("p_partkey")).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("sub_category"),
        F.when(key % 20 == 1, F.lit(-999)).otherwise(qty).alias("quantity"),
        price.alias("unit_price"),
        (F.col("l_discount") * 100).cast("decimal(5,2)").alias("discount_percentage"),
        discount.alias("discount_amount"),
        gross.alias("gross_amount"),
        (gross - discount).cast("decimal(10,2)").alias("net_amount"),
        (F.col("l_tax") * 100).cast("decimal(5,2)").alias("profit_margin"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(online, F.lit("Online")).otherwise(F.lit("Offline")).alias("payment_category"),
        F.col("n_name").alias("store_location"),
        F.col("r_name").alias("region"),
        F.dayofweek(day).isin(1, 7).cast("int").alias("is_weekend"),
        F.lit(0).alias("is_holiday"),
        ingest.alias("ingest_date"),
        F.concat(
            F.lit("sales/ingest_date="), ingest.cast("string"),
            F.lit("/sales_"), F.col("r_name"), F.lit(".parquet"),
        ).alias("source_file"),
        (key * 8 + F.col("l_linenumber")).alias("record_id"),
        run_id_of(ingest).alias("run_id"),
        F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice").alias("arrival"),
        F.concat(F.lit("CUST"), F.col("c_custkey")).alias("real_customer_id"),
        qty.alias("real_quantity"),
        *keep,
    )


def run_id_of(ingest: Column) -> Column:
    """One ingestion run per ingest date, with a UUID-shaped id."""
    h = F.md5(ingest.cast("string").cast("binary"))
    return F.concat_ws("-", h.substr(1, 8), h.substr(9, 4), h.substr(13, 4), h.substr(17, 4), h.substr(21, 12))
