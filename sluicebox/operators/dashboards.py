"""The dashboard queries: each reads gold, silver or quarantine and is named in `DASHBOARDS`."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, Window, functions as F

from sluicebox.operators import files
from sluicebox.operators.shaping import top

Tables = Mapping[str, DataFrame]

DAILY, PRODUCTS = "gold.daily_sales", "gold.product_performance"
CUSTOMERS, STORES = "gold.customer_analytics", "gold.store_performance"
CATEGORIES, SALES, QUARANTINE = "gold.category_insights", "silver.sales", "quarantine.sales_failed"


def _ranked(table: str, columns: list[str], key: str, limit: int | None = None):
    """Columns of a gold table by revenue, the table's key deciding ties."""

    def query(tables: Tables) -> DataFrame:
        order = [F.desc("total_revenue"), F.asc_nulls_last(key)]
        return top(tables[table], order, limit).select(*columns)

    return query


def total_revenue(tables: Tables) -> DataFrame:
    return tables[DAILY].agg(F.sum("net_revenue").alias("total_revenue"))


def total_transactions(tables: Tables) -> DataFrame:
    return tables[DAILY].agg(F.sum("total_transactions").alias("total_transactions"))


def total_customers(tables: Tables) -> DataFrame:
    return tables[CUSTOMERS].agg(F.count_distinct("customer_id").alias("total_customers"))


def avg_order_value(tables: Tables) -> DataFrame:
    """Unweighted: the average of the days' averages."""
    exact = F.sum("average_order_value").cast("double") / F.count("average_order_value")
    return tables[DAILY].agg(exact.alias("avg_order_value"))


def total_products(tables: Tables) -> DataFrame:
    return tables[PRODUCTS].agg(F.count_distinct("product_id").alias("total_products"))


def quarantined(tables: Tables) -> DataFrame:
    return tables[QUARANTINE].agg(F.count(F.lit(1)).alias("total_failed"))


def daily_trend(tables: Tables, days: int = 30) -> DataFrame:
    return top(tables[DAILY], [F.desc("sale_date")], days).select(
        "sale_date", "total_transactions", "net_revenue"
    )


def daily_growth(tables: Tables, days: int = 30) -> DataFrame:
    """Revenue of the last days and its change against the day before.

    The oldest shown day needs one more: only `days` + 1 rows reach the unpartitioned window.
    """
    recent = top(tables[DAILY].select("sale_date", "net_revenue"), [F.desc("sale_date")], days + 1)
    before = F.lag("net_revenue").over(Window.orderBy("sale_date"))
    return top(recent.withColumn("prev_revenue", before).withColumn(
        "growth", F.col("net_revenue") - F.col("prev_revenue")
    ), [F.desc("sale_date")], days)


def revenue_by_weekday(tables: Tables) -> DataFrame:
    """Revenue and number of days per weekday, Sunday first."""
    day = F.col("sale_date")
    return (
        tables[DAILY].groupBy(F.date_format(day, "EEEE").alias("day_of_week"), F.dayofweek(day).alias("_n"))
        .agg(F.sum("net_revenue").alias("revenue"), F.count(F.lit(1)).alias("transactions"))
        .orderBy("_n").drop("_n")
    )


def monthly_trend(tables: Tables) -> DataFrame:
    return (
        tables[DAILY].groupBy(F.date_format("sale_date", "yyyy-MM").alias("month"))
        .agg(F.sum("net_revenue").alias("revenue"), F.sum("total_transactions").alias("transactions"))
        .orderBy("month")
    )


def products_by_category(tables: Tables) -> DataFrame:
    order = [F.asc_nulls_last("category"), F.desc("total_revenue"), F.asc_nulls_last("product_id")]
    return top(tables[PRODUCTS], order).select(
        "product_name", "category", "total_revenue", "total_quantity_sold", "number_of_transactions"
    )


def tier_distribution(tables: Tables) -> DataFrame:
    return (
        tables[CUSTOMERS].groupBy("customer_tier")
        .agg(F.count(F.lit(1)).alias("count"), F.sum("total_revenue").alias("total_revenue"))
        .withColumn("avg_revenue", F.col("total_revenue").cast("double") / F.col("count"))
        .orderBy(F.desc("total_revenue"), "customer_tier")
    )


def tier_pie(tables: Tables) -> DataFrame:
    return tables[CUSTOMERS].groupBy("customer_tier").agg(
        F.count(F.lit(1)).alias("count"), F.sum("total_revenue").alias("total_revenue")
    )


def quality_score(tables: Tables) -> DataFrame:
    return files.quality_score(tables[SALES], tables[QUARANTINE])


def records_processed(tables: Tables) -> DataFrame:
    return files.records(tables[SALES], tables[QUARANTINE]).select("total")


def pending_remediation(tables: Tables) -> DataFrame:
    return tables[QUARANTINE].where(~F.col("replayed")).agg(F.count(F.lit(1)).alias("pending"))


def errors_by_type(tables: Tables, label_length: int = 50) -> DataFrame:
    """By the whole reason; the label shows as much of it as the chart does."""
    return (
        tables[QUARANTINE].groupBy("error_reason").agg(F.count(F.lit(1)).alias("count"))
        .select(F.substring("error_reason", 1, label_length).alias("error_type"), "count")
        .orderBy(F.desc("count"), "error_type")
    )


def failed_trend(tables: Tables) -> DataFrame:
    return (
        tables[QUARANTINE].groupBy(F.to_date("failed_at").alias("date"))
        .agg(F.count(F.lit(1)).alias("failed_count")).orderBy("date")
    )


def errors_by_file(tables: Tables) -> DataFrame:
    return (
        tables[QUARANTINE].where(F.col("source_file").isNotNull()).groupBy("source_file")
        .agg(F.count(F.lit(1)).alias("failed_count")).orderBy(F.desc("failed_count"), "source_file")
    )


def recent_failures(tables: Tables, limit: int = 20) -> DataFrame:
    columns = ["id", "error_reason", "failed_at", "source_file", "corrected_by", "corrected_at",
               "replayed", "replayed_at"]
    order = [F.desc("failed_at"), F.asc("id"), F.asc("source_file"), F.asc("error_reason"),
             F.asc("corrected_by"), F.asc("replayed")]
    return top(tables[QUARANTINE].select(*columns), order, limit)


def remediation_status(tables: Tables) -> DataFrame:
    state = F.when(F.col("replayed"), F.lit("Replayed")).otherwise(F.lit("Pending"))
    return tables[QUARANTINE].groupBy(state.alias("status")).agg(F.count(F.lit(1)).alias("count"))


DASHBOARDS: dict[str, Callable[[Tables], DataFrame]] = {
    "kpi_total_revenue": total_revenue,
    "kpi_total_transactions": total_transactions,
    "kpi_total_customers": total_customers,
    "kpi_avg_order_value": avg_order_value,
    "kpi_total_products": total_products,
    "kpi_quarantined": quarantined,
    "daily_trend": daily_trend,
    "revenue_by_dow": revenue_by_weekday,
    "monthly_trend": monthly_trend,
    "top_products": _ranked(PRODUCTS, [
        "product_name", "category", "total_revenue", "number_of_transactions"], "product_id", 20),
    "category_list": _ranked(CATEGORIES, [
        "category", "total_revenue", "total_products_sold", "average_order_value"], "category"),
    "store_list": _ranked(STORES, [
        "store_location", "region", "total_revenue", "total_transactions"], "store_location"),
    "top_customers": _ranked(CUSTOMERS, [
        "customer_name", "customer_tier", "total_revenue", "total_purchases"], "customer_id", 20),
    "daily_growth": daily_growth,
    "top_products_detail": _ranked(PRODUCTS, [
        "product_name", "category", "total_revenue", "number_of_transactions",
        "total_quantity_sold", "average_unit_price"], "product_id", 20),
    "category_breakdown": _ranked(CATEGORIES, [
        "category", "total_revenue", "total_products_sold", "average_order_value",
        "number_of_transactions", "average_discount_percentage"], "category"),
    "products_by_category": products_by_category,
    "category_detail": _ranked(CATEGORIES, [
        "category", "total_revenue", "total_products_sold", "average_order_value",
        "number_of_transactions"], "category"),
    "category_chart": _ranked(CATEGORIES, [
        "category", "total_revenue", "total_products_sold"], "category"),
    "customer_overview": _ranked(CUSTOMERS, [
        "customer_name", "customer_tier", "total_revenue", "total_purchases",
        "average_order_value", "favorite_category", "favorite_payment_method"], "customer_id", 20),
    "top15_customers": _ranked(CUSTOMERS, [
        "customer_name", "customer_tier", "total_revenue", "total_purchases",
        "favorite_category"], "customer_id", 15),
    "tier_distribution": tier_distribution,
    "tier_pie": tier_pie,
    "customer_details": _ranked(CUSTOMERS, [
        "customer_id", "customer_name", "customer_tier", "total_revenue", "total_purchases",
        "favorite_category", "favorite_payment_method", "most_visited_store"], "customer_id"),
    "store_overview": _ranked(STORES, [
        "store_location", "region", "total_revenue", "total_transactions", "average_order_value",
        "total_customers_served", "top_selling_category"], "store_location"),
    "store_comparison": _ranked(STORES, [
        "store_location", "region", "total_revenue", "total_transactions",
        "total_customers_served", "top_selling_category"], "store_location"),
    "store_detail": _ranked(STORES, [
        "store_location", "region", "total_revenue", "total_transactions",
        "total_customers_served", "top_selling_category"], "store_location"),
    "store_metrics": _ranked(STORES, [
        "store_location", "region", "total_revenue", "total_transactions", "average_order_value",
        "total_customers_served"], "store_location"),
    "quality_score": quality_score,
    "records_processed": records_processed,
    "pending_remediation": pending_remediation,
    "errors_by_type": errors_by_type,
    "failed_trend": failed_trend,
    "errors_by_file": errors_by_file,
    "recent_failures": recent_failures,
    "remediation_status": remediation_status,
}
