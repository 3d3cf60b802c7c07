from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import sale, silver_frame
from sluicebox.operators import dashboards, gold, quality


def test_top_category_ties_go_to_the_first_name(spark):
    sales = silver_frame(spark, [
        sale(transaction_id="1", category="B"), sale(transaction_id="2", category="A"),
        sale(transaction_id="3", category=None),
        sale(transaction_id="4", sale_date=date(2024, 5, 2), category=None, net_amount=Decimal("50.00")),
        sale(transaction_id="5", sale_date=date(2024, 5, 2), category="A"),
    ])
    days = {r["sale_date"]: r for r in gold.daily_sales(sales).collect()}
    assert days[date(2024, 5, 1)]["top_category"] == "A"
    assert days[date(2024, 5, 2)]["top_category"] is None
    assert days[date(2024, 5, 1)]["total_transactions"] == 3


def test_averages_round_half_up_once(spark):
    # 0.01 + 0.01 + 0.03 = 0.05 over 2 and 10.01 / 2 = 5.005
    sales = silver_frame(spark, [
        sale(transaction_id="1", net_amount=Decimal("10.00")), sale(transaction_id="2", net_amount=Decimal("0.01")),
    ])
    assert gold.daily_sales(sales).first()["average_order_value"] == Decimal("5.01")


def test_tiers_are_strict(spark):
    sales = silver_frame(spark, [
        sale(transaction_id="1", customer_id="a", net_amount=Decimal("1000.00")),
        sale(transaction_id="2", customer_id="b", net_amount=Decimal("1000.01")),
        sale(transaction_id="3", customer_id="c", net_amount=Decimal("5000.01")),
        sale(transaction_id="4", customer_id="d", net_amount=Decimal("10000.01")),
    ])
    found = {r["customer_id"]: r for r in gold.dim_customers(sales, F.lit(date(2024, 5, 11))).collect()}
    assert [found[c]["customer_segment"] for c in "abcd"] == ["Bronze", "Silver", "Gold", "Platinum"]
    assert found["a"]["days_since_last_purchase"] == 10


def test_null_store_keeps_a_row_without_top_category(spark):
    sales = silver_frame(spark, [sale(transaction_id="1", store_location=None), sale(transaction_id="2")])
    found = {r["store_location"]: r["top_selling_category"] for r in gold.store_performance(sales).collect()}
    assert found == {None: None, "X": "A"}


def test_favorites_by_count(spark):
    sales = silver_frame(spark, [
        sale(transaction_id=str(i), category=c, payment_method=p, store_location=s)
        for i, (c, p, s) in enumerate([("A", "Cash", "X"), ("B", "Cash", "Y"), ("B", "Card", "Y"), ("A", "Card", "X")])
    ])
    row = gold.customer_analytics(sales).first()
    assert (row["favorite_category"], row["favorite_payment_method"], row["most_visited_store"]) == ("A", "Card", "X")


def test_sums_agree_across_aggregates(spark):
    sales = silver_frame(spark, [sale(transaction_id=str(i), category="AB"[i % 2], store_location="XYZ"[i % 3]) for i in range(30)])
    totals = {
        gold.daily_sales(sales).agg(F.sum("net_revenue")).first()[0],
        gold.category_insights(sales).agg(F.sum("total_revenue")).first()[0],
        gold.store_performance(sales).agg(F.sum("total_revenue")).first()[0],
        sales.agg(F.sum("net_amount")).first()[0],
    }
    assert len(totals) == 1


def test_growth_needs_the_day_before_the_window(spark):
    daily = spark.createDataFrame(
        [(date(2024, 1, d), Decimal(d * d)) for d in range(1, 8)], "sale_date date, net_revenue decimal(20,2)")
    rows = dashboards.daily_growth({"gold.daily_sales": daily}, days=3).collect()
    assert [(r["sale_date"].day, int(r["growth"])) for r in rows] == [(7, 13), (6, 11), (5, 9)]


def test_empty_silver_has_completeness_zero_and_is_stale(spark):
    sales = silver_frame(spark, [])
    rows = quality.completeness({"s": sales}, {"s": ("customer_id",)}).collect()
    assert (rows[0]["completeness_pct"], rows[0]["passes_threshold"]) == (Decimal("0.00"), False)
    assert not quality.freshness(sales, F.lit("2024-01-01").cast("timestamp_ntz")).first()["is_fresh"]


def test_drift_uses_the_newest_baseline_older_than_a_day(spark):
    as_of = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    baselines = spark.createDataFrame([
        ("sales", "row_count", Decimal("50"), "2024-01-01 00:00:00"), ("sales", "row_count", Decimal("100"), "2024-01-08 23:59:59"),
        ("sales", "row_count", Decimal("999"), "2024-01-09 00:00:00"), ("sales", "other", Decimal("1"), "2024-01-08 23:59:59"),
    ], "table_name string, metric_name string, metric_value decimal(15,2), at string").withColumn(
        "recorded_at", F.col("at").cast("timestamp_ntz")).drop("at")
    counts = spark.createDataFrame([("sales", 111), ("new", 5), ("void", 0)], "table_name string, row_count bigint")
    found = {r["table_name"]: r for r in quality.drift(counts, baselines, as_of).collect()}
    assert (found["sales"]["baseline_count"], found["sales"]["change_pct"], found["sales"]["drift_detected"]) == (100, 11.0, True)
    assert (found["new"]["change_pct"], found["new"]["status"]) == (0.0, "normal")
    assert found["void"]["status"] == "not_populated"
