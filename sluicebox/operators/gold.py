"""Silver dimensions and gold aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sluicebox import schemas, specs
from sluicebox.functions.amounts import mean, tier
from sluicebox.operators.shaping import conform


def grouped(
    df: DataFrame, keys: Sequence[str], labels: Sequence[str], measures: Mapping[str, Column],
    merges: Mapping[str, Column],
) -> DataFrame:
    """Aggregate with descriptive text columns kept as their maximum.

    A maximum over text makes Spark sort all rows; as grouping columns the texts let the rows go
    through a hash aggregate, and only its small result is sorted. `measures` are computed per
    key and label combination, `merges` combine them per key.
    """
    first = df.groupBy(*keys, *labels).agg(*[m.alias(n) for n, m in measures.items()])
    return first.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in labels], *[m.alias(n) for n, m in merges.items()]
    )


def leaders(df: DataFrame, key: str, attributes: Mapping[str, str], weight: Column) -> DataFrame:
    """Per key the heaviest value of each attribute: `attributes` maps output name to column.

    One scan: the grouping sets (key, attribute) share a pass and a shuffle, and only one row
    per key and value reaches the second step. Equal weights go to the first name, NULL last.
    """
    columns = list(dict.fromkeys(attributes.values()))
    counted = df.groupingSets([[key, c] for c in columns], key, *columns).agg(
        weight.alias("_weight"), F.grouping_id().alias("_set")
    )
    # bit i of the set number, from the right, is 1 where column i is summed over
    every = 2 ** len(columns) - 1
    set_of = {c: every - 2 ** (len(columns) - 1 - i) for i, c in enumerate(columns)}

    def best(column: str) -> Column:
        inside = F.col("_set") == set_of[column]
        rank = F.struct(-F.col("_weight"), F.col(column).isNull(), F.col(column))
        return F.min(F.when(inside, rank))

    chosen = counted.groupBy(key).agg(*[best(c).alias(f"_{n}") for n, c in attributes.items()])
    # the third field of the winning struct is the value itself
    return chosen.select(key, *[
        F.col(f"_{n}")[chosen.schema[f"_{n}"].dataType.names[2]].alias(n) for n in attributes
    ])


def dim_customers(sales: DataFrame, as_of: Column, tiers=specs.SPEND_TIERS) -> DataFrame:
    per = grouped(
        sales.where(F.col("customer_id").isNotNull()), ["customer_id"], ["customer_name"],
        {"n": F.count(F.lit(1)), "net": F.sum("net_amount"),
         "first": F.min("sale_date"), "last": F.max("sale_date")},
        customer_merges(),
    )
    return shaped_customers(per, as_of, tiers)


def customer_merges() -> dict[str, Column]:
    """How the measures of parts of a customer combine."""
    return {"n": F.sum("n"), "net": F.sum("net"), "first": F.min("first"), "last": F.max("last")}


def shaped_customers(per: DataFrame, as_of: Column, tiers) -> DataFrame:
    return conform(per.select(
        "customer_id", "customer_name",
        F.col("first").alias("first_purchase_date"),
        F.col("n").alias("total_purchases"),
        F.col("net").alias("total_revenue"),
        mean(F.col("net"), F.col("n")).alias("average_order_value"),
        tier(F.col("net"), tiers).alias("customer_segment"),
        F.col("last").alias("last_purchase_date"),
        F.datediff(as_of, F.col("last")).alias("days_since_last_purchase"),
    ), schemas.SILVER_CUSTOMERS)


def dim_products(sales: DataFrame) -> DataFrame:
    per = grouped(
        sales.where(F.col("product_id").isNotNull()), ["product_id"],
        ["product_name", "category", "sub_category"],
        {"priced": F.count("unit_price"), "price": F.sum("unit_price"), "low": F.min("unit_price"),
         "high": F.max("unit_price"), "qty": F.sum("quantity"), "net": F.sum("net_amount")},
        {"priced": F.sum("priced"), "price": F.sum("price"), "low": F.min("low"), "high": F.max("high"),
         "qty": F.sum("qty"), "net": F.sum("net")},
    )
    return shaped_products(per)


def shaped_products(per: DataFrame) -> DataFrame:
    return conform(per.select(
        "product_id", "product_name", "category", "sub_category",
        F.col("low").alias("min_unit_price"), F.col("high").alias("max_unit_price"),
        mean(F.col("price"), F.col("priced")).alias("avg_unit_price"),
        F.col("qty").alias("total_quantity_sold"), F.col("net").alias("total_revenue"),
    ), schemas.SILVER_PRODUCTS)


def daily_sales(sales: DataFrame) -> DataFrame:
    """Totals and top categories come from one row per day and category, the products and customers from
    pairs of two columns; no wide row is shuffled for a distinct count."""
    sums = ("quantity", "gross_amount", "discount_amount", "net_amount")
    categories = sales.groupBy("sale_date", "category").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(c) for c in sums]
    )
    per = categories.groupBy("sale_date").agg(
        F.sum("n").alias("total_transactions"),
        F.sum("quantity").alias("total_quantity_sold"),
        F.sum("gross_amount").alias("gross_revenue"),
        F.sum("discount_amount").alias("total_discounts"),
        F.sum("net_amount").alias("net_revenue"),
    ).withColumn("average_order_value", mean(F.col("net_revenue"), F.col("total_transactions")))
    products = sales.select("sale_date", "product_id").distinct().groupBy(F.col("sale_date").alias("_day")).agg(
        F.count("product_id").alias("unique_products")
    )
    customers = sales.select("sale_date", "customer_id").distinct().groupBy("sale_date").agg(
        F.count("customer_id").alias("unique_customers")
    )
    best = leaders(categories, "sale_date", {"top_category": "category"}, F.sum("net_amount"))
    # sales without a day count their products too
    per = per.join(products, F.col("sale_date").eqNullSafe(F.col("_day")), "left").drop("_day")
    return conform(per.join(customers, "sale_date", "left").join(best, "sale_date", "left"), schemas.GOLD_DAILY_SALES)


def product_performance(sales: DataFrame) -> DataFrame:
    per = grouped(
        sales, ["product_id"], ["product_name", "category"],
        {"n": F.count(F.lit(1)), "priced": F.count("unit_price"), "price": F.sum("unit_price"),
         "qty": F.sum("quantity"), "net": F.sum("net_amount"), "off": F.sum("discount_amount")},
        {"n": F.sum("n"), "priced": F.sum("priced"), "price": F.sum("price"),
         "qty": F.sum("qty"), "net": F.sum("net"), "off": F.sum("off")},
    )
    return shaped_performance(per)


def shaped_performance(per: DataFrame) -> DataFrame:
    return conform(per.select(
        "product_id", "product_name", "category",
        F.col("qty").alias("total_quantity_sold"), F.col("net").alias("total_revenue"),
        mean(F.col("price"), F.col("priced")).alias("average_unit_price"),
        F.col("off").alias("total_discount_given"),
        F.col("n").alias("number_of_transactions"),
        mean(F.col("qty"), F.col("n")).alias("average_quantity_per_transaction"),
    ), schemas.GOLD_PRODUCT_PERFORMANCE)


def store_performance(sales: DataFrame) -> DataFrame:
    per = _per_store(sales)
    best = leaders(sales, "store_location", {"top_selling_category": "category"}, F.sum("net_amount"))
    return shaped_stores(per, best)


def shaped_stores(per: DataFrame, best: DataFrame) -> DataFrame:
    return conform(per.join(best, "store_location", "left"), schemas.GOLD_STORE_PERFORMANCE)


def _per_store(sales: DataFrame) -> DataFrame:
    """Counting customers and taking the top region both work on one row per store, region and
    customer, so one shuffle of those serves them and the totals."""
    return stores_of(sales.groupBy("store_location", "region", "customer_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("net_amount").alias("net")
    ))


def stores_of(base: DataFrame) -> DataFrame:
    """Stores from rows of a store, region and customer, of which there may be several."""
    pairs = base.groupBy("store_location", "customer_id").agg(
        F.max("region").alias("region"), F.sum("n").alias("n"), F.sum("net").alias("net")
    )
    return pairs.groupBy("store_location").agg(
        F.max("region").alias("region"),
        F.sum("n").alias("total_transactions"),
        F.sum("net").alias("total_revenue"),
        F.count("customer_id").alias("total_customers_served"),
    ).withColumn("average_order_value", mean(F.col("total_revenue"), F.col("total_transactions")))


def customer_analytics(sales: DataFrame, tiers=specs.SPEND_TIERS) -> DataFrame:
    known = sales.where(F.col("customer_id").isNotNull())
    per = grouped(
        known, ["customer_id"], ["customer_name"],
        {"n": F.count(F.lit(1)), "net": F.sum("net_amount")},
        {"n": F.sum("n"), "net": F.sum("net")},
    )
    best = leaders(known, "customer_id", {
        "favorite_category": "category",
        "favorite_payment_method": "payment_method",
        "most_visited_store": "store_location",
    }, F.count(F.lit(1)))
    return shaped_analytics(per, best, tiers)


def shaped_analytics(per: DataFrame, best: DataFrame, tiers) -> DataFrame:
    return conform(per.join(best, "customer_id", "left").select(
        "customer_id", "customer_name",
        F.col("n").alias("total_purchases"), F.col("net").alias("total_revenue"),
        mean(F.col("net"), F.col("n")).alias("average_order_value"),
        "favorite_category", "favorite_payment_method", "most_visited_store",
        tier(F.col("net"), tiers).alias("customer_tier"),
    ), schemas.GOLD_CUSTOMER_ANALYTICS)


def category_insights(sales: DataFrame) -> DataFrame:
    per = sales.groupBy("category").agg(
        F.sum("quantity").alias("total_products_sold"),
        F.sum("net_amount").alias("total_revenue"),
        F.sum("discount_percentage").alias("_off"),
        F.count("discount_percentage").alias("_offs"),
        F.count(F.lit(1)).alias("number_of_transactions"),
    )
    return shaped_categories(per)


def shaped_categories(per: DataFrame) -> DataFrame:
    return conform(per.withColumns({
        "average_discount_percentage": mean(F.col("_off"), F.col("_offs"), 5),
        "average_order_value": mean(F.col("total_revenue"), F.col("number_of_transactions")),
    }), schemas.GOLD_CATEGORY_INSIGHTS)


def monthly_sales(sales: DataFrame) -> DataFrame:
    per = sales.groupBy(F.trunc("sale_date", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("gross_amount").alias("gross_revenue"),
        F.sum("discount_amount").alias("total_discounts"),
        F.sum("net_amount").alias("net_revenue"),
    )
    return per.withColumn(
        "avg_order_value", F.col("net_revenue").cast("double") / F.col("total_transactions")
    ).orderBy("month")


def regional_sales(sales: DataFrame) -> DataFrame:
    per = sales.groupBy("region", "store_location").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum("net_amount").alias("total_revenue"),
        F.count_distinct("customer_id").alias("unique_customers"),
    )
    return per.withColumn(
        "avg_order_value", F.col("total_revenue").cast("double") / F.col("total_transactions")
    ).orderBy(F.desc("total_revenue"), "region", "store_location")
