"""Gold kept up to date from changes: parts of every group by month, and groups summed from their parts.

All measures of gold are sums, counts, least and greatest values, distinct counts and heaviest values,
so a group follows from its months' parts. A merge touches few months of silver: their parts are made
again from those months' rows, and the groups that changed are summed from all their parts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sluicebox.operators import gold

MONTH = "part_month"


def _by_month(sales: DataFrame, *by: str, **measures: Column) -> DataFrame:
    return sales.groupBy(F.trunc("sale_date", "month").alias(MONTH), *by).agg(*[m.alias(n) for n, m in measures.items()])


def product_parts(sales: DataFrame) -> DataFrame:
    return _by_month(
        sales, "product_id", "product_name", "category", "sub_category", n=F.count(F.lit(1)), priced=F.count("unit_price"),
        price=F.sum("unit_price"), low=F.min("unit_price"), high=F.max("unit_price"), qty=F.sum("quantity"),
        net=F.sum("net_amount"), off=F.sum("discount_amount"),
    )


def buyer_parts(sales: DataFrame) -> DataFrame:
    """What customers, stores and categories are summed from; sales without a customer count for the last two."""
    return _by_month(
        sales, "customer_id", "customer_name", "category", "payment_method", "store_location", "region",
        n=F.count(F.lit(1)), net=F.sum("net_amount"), first=F.min("sale_date"), last=F.max("sale_date"),
        qty=F.sum("quantity"), off=F.sum("discount_percentage"), offs=F.count("discount_percentage"),
    )


def product_sums(parts: DataFrame) -> DataFrame:
    sums = ("n", "priced", "price", "qty", "net", "off")
    merges = {**{c: F.sum(c) for c in sums}, "low": F.min("low"), "high": F.max("high")}
    return gold.grouped(parts, ["product_id"], ["product_name", "category", "sub_category"], merges, merges)


def customer_sums(parts: DataFrame) -> DataFrame:
    return gold.grouped(_known(parts), ["customer_id"], ["customer_name"], gold.customer_merges(), gold.customer_merges())


def _known(parts: DataFrame) -> DataFrame:
    return parts.where(F.col("customer_id").isNotNull())


def customer_analytics(parts: DataFrame, sums: DataFrame, tiers) -> DataFrame:
    best = gold.leaders(_known(parts), "customer_id", {
        "favorite_category": "category", "favorite_payment_method": "payment_method", "most_visited_store": "store_location",
    }, F.sum("n"))
    return gold.shaped_analytics(sums, best, tiers)


def store_performance(parts: DataFrame) -> DataFrame:
    base = parts.groupBy("store_location", "region", "customer_id").agg(F.sum("n").alias("n"), F.sum("net").alias("net"))
    best = gold.leaders(parts, "store_location", {"top_selling_category": "category"}, F.sum("net"))
    return gold.shaped_stores(gold.stores_of(base), best)


def category_insights(parts: DataFrame) -> DataFrame:
    sums = {"total_products_sold": "qty", "total_revenue": "net", "_off": "off", "_offs": "offs", "number_of_transactions": "n"}
    return gold.shaped_categories(parts.groupBy("category").agg(*[F.sum(c).alias(n) for n, c in sums.items()]))


@dataclass(frozen=True)
class Kept:
    """A gold table: the parts it is summed from, and how. `total` takes the parts and, for tables that share
    the sums of `SUMS`, those. Parts of one name are met by one group column; several names may lie in one
    written table (`kept_in`)."""

    parts: str
    total: Callable[[DataFrame, DataFrame | None], DataFrame]


# written tables of parts
PRODUCTS, BUYERS = "gold_parts.products", "gold_parts.buyers"
PARTS: dict[str, Callable[[DataFrame], DataFrame]] = {PRODUCTS: product_parts, BUYERS: buyer_parts}
# by the name of their parts: a row for each group, which several gold tables take their measures from
SUMS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "gold_parts.products": product_sums, "gold_parts.customers": customer_sums,
}


def kept(as_of: Column, tiers) -> dict[str, Kept]:
    """Gold tables that are summed from parts; daily sales are made again from the days' rows."""
    return {
        "silver.customers": Kept("gold_parts.customers", lambda parts, sums: gold.shaped_customers(sums, as_of, tiers)),
        "silver.products": Kept("gold_parts.products", lambda parts, sums: gold.shaped_products(sums.where(F.col("product_id").isNotNull()))),
        "gold.product_performance": Kept("gold_parts.products", lambda parts, sums: gold.shaped_performance(sums)),
        "gold.store_performance": Kept("gold_parts.stores", lambda parts, sums: store_performance(parts)),
        "gold.customer_analytics": Kept("gold_parts.customers", lambda parts, sums: customer_analytics(parts, sums, tiers)),
        "gold.category_insights": Kept("gold_parts.categories", lambda parts, sums: category_insights(parts)),
    }


def kept_in(parts: str) -> str:
    """The written table that holds parts of a name."""
    return parts if parts in PARTS else BUYERS


def touched(changes: DataFrame, column: str) -> DataFrame:
    """Values of a group column before and after the changes, as `_touched`."""
    before = changes.where(F.col("_before").isNotNull()).select(F.col(f"_before.{column}").alias("_touched"))
    return before.unionByName(changes.select(F.col(f"_after.{column}").alias("_touched"))).distinct()


def of_groups(df: DataFrame, column: str, values: DataFrame, how: str = "left_semi") -> DataFrame:
    """Rows whose group is (or with `left_anti` is not) among the values, NULL as a value too."""
    return df.join(values, F.col(column).eqNullSafe(F.col("_touched")), how)


def replaced(known: DataFrame, fresh: DataFrame, key: str, values: DataFrame, drop_vanished: bool) -> DataFrame:
    """A gold table with the touched groups taken from `fresh`. A touched group that `fresh` does not
    have has vanished from silver: its last row stays unless `drop_vanished`."""
    out = of_groups(known, key, values, "left_anti").unionByName(fresh)
    if drop_vanished:
        return out
    gone = of_groups(known, key, values).join(
        fresh.select(F.col(key).alias("_fresh")), F.col(key).eqNullSafe(F.col("_fresh")), "left_anti"
    )
    return out.unionByName(gone)
