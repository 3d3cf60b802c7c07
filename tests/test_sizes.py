"""How the registered queries' tables follow the size of what they are made from."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F, types as T

from helpers import sale, silver_frame
from registry import deployed, landing
from registry import tables as R
from sluicebox import specs
from sluicebox.operators import gold, gold_parts, upsert, validation
from sluicebox.plans.gold import build_gold, refresh_gold
from sluicebox.plans.layers import CHANGES, GROUPS
from sluicebox.session import setting
from sluicebox.sources import bronze, tables

DAY = datetime(1998, 3, 2)
KEYED = T.StructType([T.StructField("k", T.StringType()), T.StructField("day", T.DateType())])


@pytest.fixture
def star(spark, tmp_path):
    """Forty orders of two lines, the second of which came in twice."""
    def put(name, rows, columns):
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    put("region", [(0, "ASIA")], "r_regionkey int, r_name string")
    put("nation", [(0, "INDIA", 0)], "n_nationkey int, n_name string, n_regionkey int")
    put("customer", [(c, f"Customer {c}", 0) for c in range(5)], "c_custkey bigint, c_name string, c_nationkey int")
    put("part", [(p, f"part {p}", "Brand#1", "TIN", 10.5) for p in range(3)],
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_retailprice double")
    put("orders", [(o, o % 5, DAY, "2-HIGH") for o in range(1, 41)],
        "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_orderpriority string")
    lines = [(o, o % 3, s, n, float(s), 100.0, 0.05, 0.02, DAY) for o in range(1, 41) for n, s in ((1, 1), (2, 1), (2, 2))]
    put("lineitem", lines, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp")
    return str(tmp_path)


def test_buckets_follow_the_order_lines(spark, star, monkeypatch):
    assert R.buckets(spark, star) == 2
    monkeypatch.setattr(R, "ROWS_PER_BUCKET", 25)
    assert R.buckets(spark, star) == 5
    assert deployed.merged(spark, star).sales.buckets == 5
    assert deployed.merged(spark, star).read("silver.sales").count() == 68


def test_landed_sales_are_merged_in_as_many_buckets(spark, star, monkeypatch):
    monkeypatch.setattr(R, "ROWS_PER_BUCKET", 10)
    layers = landing.ingested(spark, star)
    assert layers.sales.buckets == 12
    assert layers.read("silver.sales").count() == 68


def test_sales_are_not_shuffled_again_for_the_latest(spark, star):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        silver = R.silver_sales(spark, star)
        plan = silver._jdf.queryExecution().executedPlan().toString()
        keys = re.findall(r"Exchange hashpartitioning\((\w+)#", plan)
        rows = {r["transaction_id"]: r["quantity"] for r in silver.collect()}
    # a broadcast aside, a line is shuffled to its part and to its order
    assert sorted(keys) == sorted([
        "r_regionkey", "n_regionkey", "n_nationkey", "c_nationkey", "c_custkey", "o_custkey",
        "l_partkey", "p_partkey", "l_orderkey", "o_orderkey",
    ])
    assert len(rows) == 68 and rows["TXN-3-1"] == 1 and rows["TXN-3-2"] == 2


def test_listing_folders_takes_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "LISTING_TASKS", 5)
    stored = tables.KeyedTable(tables.TableStore(spark, str(tmp_path)), "wide", KEYED, ["k"], "day", buckets=2)
    rows = spark.range(400).selectExpr("cast(id as string) k", "add_months(date'2020-01-01', cast(id % 40 as int)) day")
    stored.merge(rows)
    spark.sparkContext.setJobGroup("listing", "")
    try:
        assert stored.merge(rows) == 80
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    status = spark.sparkContext.statusTracker()
    stages = [status.getStageInfo(s) for job in status.getJobIdsForGroup("listing") for s in status.getJobInfo(job).stageIds]
    # a task lists several of the 80 folders
    assert stages and max(s.numTasks for s in stages if s) < 80


def test_daily_sales_shuffle_no_row_per_product_and_category(spark):
    sales = silver_frame(spark, [sale(transaction_id=str(i), product_id=f"P{i % 3}", category="AB"[i % 2]) for i in range(12)])
    daily = gold.daily_sales(sales)
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert not [k for k in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan) if "product_id" in k and "category" in k]
    assert daily.select("total_transactions", "unique_products").first() == (12, 3)


def test_what_gold_tables_share_is_summed_once(spark, layers):
    rows = silver_frame(spark, [sale(transaction_id=str(i), product_id=f"P{i % 3}", customer_id=f"C{i % 2}") for i in range(12)])
    layers.sales.merge(rows)
    summed = []
    with pytest.MonkeyPatch.context() as patch:
        for name, sums in gold_parts.SUMS.items():
            patch.setitem(gold_parts.SUMS, name, lambda parts, n=name, f=sums: (summed.append(n), f(parts))[1])
        build_gold(layers, DAY.date())
    assert sorted(summed) == ["gold_parts.customers", "gold_parts.products"]
    for name, whole in {
        "silver.products": gold.dim_products(rows), "gold.product_performance": gold.product_performance(rows),
        "silver.customers": gold.dim_customers(rows, F.lit(DAY.date())), "gold.customer_analytics": gold.customer_analytics(rows),
    }.items():
        assert sorted(map(str, layers.read(name).collect())) == sorted(map(str, whole.collect())), name
    assert not layers.store.exists("staging.sums.gold_parts.products")


def test_a_refresh_finds_changed_groups_once_and_makes_two_tables_of_parts(spark, layers):
    rows = [sale(transaction_id=str(i), product_id=f"P{i % 3}", customer_id=f"C{i % 2}") for i in range(6)]
    nobody = sale(transaction_id="n", customer_id=None, store_location="Y", category="B", region="R")
    layers.sales.merge(silver_frame(spark, [*rows, nobody]), None, None, GROUPS, CHANGES)
    refresh_gold(layers, DAY.date())
    layers.sales.merge(silver_frame(spark, [sale(transaction_id="1", customer_id="C9")]), None, None, GROUPS, CHANGES)
    found, made = [], []
    touched, write = gold_parts.touched, layers.store.write_partitions
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(gold_parts, "touched", lambda changes, column: (found.append(column), touched(changes, column))[1])
        patch.setattr(layers.store, "write_partitions", lambda name, df, by: (made.append(name), write(name, df, by))[1])
        refresh_gold(layers, DAY.date(), drop_vanished=True)
    assert sorted(found) == ["category", "customer_id", "product_id", "sale_date", "store_location"]
    assert sorted(made) == ["gold_parts.buyers", "gold_parts.products"]
    assert not [c for c in found if layers.store.exists(f"staging.touched.{c}")]
    sales = layers.read("silver.sales")
    for name, whole in {
        "silver.customers": gold.dim_customers(sales, F.lit(DAY.date())), "gold.customer_analytics": gold.customer_analytics(sales),
        "gold.store_performance": gold.store_performance(sales), "gold.category_insights": gold.category_insights(sales),
        "gold.daily_sales": gold.daily_sales(sales), "gold.product_performance": gold.product_performance(sales),
    }.items():
        assert sorted(map(str, layers.read(name).collect())) == sorted(map(str, whole.collect())), name


def test_a_merge_reads_its_batch_in_small_pieces(spark, layers):
    seen, write = [], layers.store.write
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(layers.store, "write", lambda name, df, by=(): (seen.append(spark.conf.get("spark.sql.files.maxPartitionBytes")), write(name, df, by))[1])
        with setting(spark, "spark.sql.files.maxPartitionBytes", "128m"):
            layers.sales.merge(silver_frame(spark, [sale(transaction_id="1")]).withColumn("n", F.lit(1)), None, "n")
            assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "128m"
    assert seen == ["32m"]


def test_first_and_last_rows_of_a_key_meet_without_another_shuffle(spark):
    batch = spark.createDataFrame([("x", 1, 1, 1), ("x", 2, 2, 2), (None, 3, 3, 1), (None, 4, 4, 2)], "k string, a int, b int, n int")
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        one = upsert.collapse_batch(batch, ["k"], ["a"], "n")
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2
        assert sorted(map(tuple, one.collect()), key=str) == [("x", 2, 1), (None, 4, 3)]


def largest_method(df) -> int:
    debug = df.sparkSession._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$")
    text = debug.codegenString(df._jdf.queryExecution().executedPlan())
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text))


def test_tagging_and_silver_stay_within_compiled_methods(spark, star, tmp_path):
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        landed = R.bronze(spark, star).select(*specs.SALES.file_columns)
        landed.coalesce(1).write.parquet(f"{tmp_path}/landed/ingest_date=1998-03-02")
        found = bronze.list_files(spark, f"{tmp_path}/landed").collect()
        rows = bronze.read_files(spark, {"one": [r["file_path"] for r in found]}, specs.SALES)
        # the virtual machine compiles no method over 8000 bytes of bytecode
        assert largest_method(validation.tag_all(rows, specs.SALES)) <= 8000
        assert largest_method(R.silver_sales(spark, star)) <= 8000


def test_failed_casts_are_named_in_the_order_of_the_columns(spark):
    sales = silver_frame(spark, [sale(transaction_id="1"), sale(transaction_id="2")])
    errors = F.when(F.col("transaction_id") == "1", F.array(F.lit("unit_price"), F.lit("quantity"))).otherwise(F.expr("cast(array() as array<string>)"))
    rows = validation.tag_all(sales.withColumn("cast_errors", errors), specs.SALES)
    found = {r["transaction_id"]: r["error_reason"] for r in rows.collect()}
    assert found["1"] == "check:quantity;check:unit_price" and not (found["2"] or "").startswith("check:quantity")
