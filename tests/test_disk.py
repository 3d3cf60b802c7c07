"""What merges, gold and ingest leave on disk, and how often they write their rows."""

import glob
import time
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import sales_maker
from helpers import NOW, sale, silver_frame
from sluicebox.operators import gold
from sluicebox.plans.gold import build_gold, refresh_gold
from sluicebox.plans.ingest import ingest
from sluicebox.plans.layers import CHANGES, GROUPS, SALES
from sluicebox.session import SWEEP, swept
from sluicebox.sources import tables
from sluicebox.sources.tables import KeyedTable, TableStore

SCHEMA = "transaction_id string, sale_date date, quantity int"


def shuffle_files(spark):
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d}/*/shuffle_*")}


def left_after(spark, before):
    """Shuffle files that were not there before; Spark deletes them a moment after a query."""
    for _ in range(50):
        found = shuffle_files(spark) - before
        if not found:
            break
        time.sleep(0.1)
    return found


def rows_of(spark, months=(1, 2, 3)):
    return silver_frame(spark, [
        sale(transaction_id=f"T{m}-{i}", sale_date=date(2024, m, 1 + i), customer_id=f"C{i % 2}", product_id=f"P{i % 3}", net_amount=Decimal(i))
        for m in months for i in range(6)
    ])


def test_queries_delete_their_shuffles_when_they_end(spark, layers):
    before = shuffle_files(spark)
    layers.sales.merge(rows_of(spark).withColumn("n", F.col("quantity")), None, "n", GROUPS, CHANGES)
    layers.sales.merge(rows_of(spark, (2,)).withColumn("n", F.col("quantity")), None, "n", GROUPS, CHANGES)
    assert not left_after(spark, before)
    refresh_gold(layers, date(2024, 6, 1))
    layers.sales.merge(rows_of(spark, (3,)), None, None, GROUPS, CHANGES)
    refresh_gold(layers, date(2024, 6, 1))
    assert not left_after(spark, before)
    assert spark.conf.get(SWEEP, None) is None


def test_blocks_that_delete_shuffles_nest(spark):
    with swept(spark):
        with swept(spark):
            pass
        assert spark.conf.get(SWEEP) == "true"
    assert spark.conf.get(SWEEP, None) is None


def batch(spark, *values):
    return spark.createDataFrame([(k, date.fromisoformat(d), q) for k, d, q in values], SCHEMA)


@pytest.fixture
def keyed(spark, tmp_path):
    return lambda: KeyedTable(TableStore(spark, str(tmp_path)), "sales", spark.createDataFrame([], SCHEMA).schema, ["transaction_id"], "sale_date", 4)


def content(table):
    return sorted((r[0], r[1].isoformat(), r[2]) for r in table.read().collect())


def test_a_first_merge_writes_its_rows_once_and_moves_them(spark, keyed):
    table, written = keyed(), []
    write = table.store.write
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(table.store, "write", lambda name, df, by=(): (written.append(name), write(name, df, by))[1])
        patch.setattr(table, "touched", None)
        assert table.merge(batch(spark, *[(f"t{i}", "2024-01-01", i) for i in range(40)])) == 4
    assert len(written) == 1 and not written[0].startswith("_batches")
    files = table.rows().inputFiles()
    # a file for each folder, in whose name Spark finds the bucket: rows are where a search by key looks
    assert len(files) == 4 and all(f"_bucket={int(f.rsplit('_', 1)[1].split('.')[0])}/" in f for f in files)
    for i in range(40):
        assert table.read().where(F.col("transaction_id") == f"t{i}").count() == 1


def test_stored_tables_take_little_room(spark, layers):
    text = spark.range(20_000).select(F.concat(F.lit("TXN-"), F.md5(F.col("id").cast("string"))).alias("k"), F.lit("x" * 40).alias("v"))
    size = lambda at: sum(len(open(f, "rb").read()) for f in glob.glob(f"{at}/*.parquet"))
    text.coalesce(1).write.option("compression", "snappy").parquet(f"{layers.store.root}/plain")
    layers.store.write("stored", text.coalesce(1))
    assert size(layers.store.location("stored")) < 0.8 * size(layers.store.location("plain"))


def test_a_move_that_broke_off_is_repeated(spark, keyed):
    table = keyed()
    table.merge(batch(spark, ("a", "2024-01-01", 1), ("b", "2024-02-01", 2)))
    expected = [("a", "2024-03-01", 10), ("b", "2024-02-01", 2), ("c", "2024-02-01", 3)]
    with pytest.MonkeyPatch.context() as patch:
        # the driver dies before anything is moved
        patch.setattr(KeyedTable, "_publish", lambda self: 0)
        table.merge(batch(spark, ("a", "2024-03-01", 10), ("c", "2024-02-01", 3)))
    assert content(table) == [("a", "2024-01-01", 1), ("b", "2024-02-01", 2)]
    with pytest.MonkeyPatch.context() as patch:
        # and the next one when all files are moved but nothing else is done
        patch.setattr(KeyedTable, "_drop", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            table._publish()
    spark.sql(f"DROP TABLE {table.table}")
    again = keyed()
    assert content(again) == expected
    assert not any("_month=2024-01" in f for f in again.rows().inputFiles())
    assert not glob.glob(f"{again.store.root}/_merging/sales/*")


def test_parts_of_gold_are_made_month_by_month(spark, layers, monkeypatch):
    monkeypatch.setattr(tables, "TURN_BYTES", 1)
    layers.sales.merge(rows_of(spark), None, None, GROUPS, CHANGES)
    made, write = [], layers.store.write_partitions
    monkeypatch.setattr(layers.store, "write_partitions", lambda name, df, by: (made.append((name, df.select(*by).distinct().count())), write(name, df, by))[1])
    build_gold(layers, date(2024, 6, 1))
    assert sorted(made) == [("gold_parts.buyers", 1)] * 3 + [("gold_parts.products", 1)] * 3
    # the only sales of a month move to another; a rebuild forgets the month's parts
    moved = rows_of(spark, (3,)).withColumn("sale_date", F.lit(date(2024, 2, 9)))
    layers.sales.merge(moved, None)
    build_gold(layers, date(2024, 6, 1), overwrite=True)
    sales = layers.read(SALES)
    assert sales.count() == 18 and layers.sales.months() == [date(2024, 1, 1), date(2024, 2, 1)]
    for name, whole in {
        "silver.customers": gold.dim_customers(sales, F.lit(date(2024, 6, 1))), "gold.customer_analytics": gold.customer_analytics(sales),
        "gold.store_performance": gold.store_performance(sales), "gold.product_performance": gold.product_performance(sales),
    }.items():
        assert sorted(map(str, layers.read(name).collect())) == sorted(map(str, whole.collect())), name


def test_staged_rows_go_when_their_files_are_closed(spark, layers, tmp_path):
    sales_maker.sales(spark, 50, "mixed").coalesce(1).write.parquet(str(tmp_path / "bronze" / "sales" / "ingest_date=2024-05-02"))
    before = shuffle_files(spark)
    assert ingest(spark, layers, str(tmp_path / "bronze"), "run1", NOW) == 1
    assert not left_after(spark, before)
    assert layers.read(SALES).count() == 40
    assert layers.store.exists("staging.run1-0000.files") and not layers.store.exists("staging.run1-0000.rows")
