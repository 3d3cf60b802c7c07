import json
from datetime import date, timedelta
from decimal import Decimal

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import sales_maker
from helpers import NOW, sale, silver_frame
from sluicebox.operators import dashboards
from sluicebox.plans.gold import DAILY, build_gold, changed_sales, refresh_gold
from sluicebox.plans.ingest import ingest, latest_audit
from sluicebox.plans.layers import AUDIT, CHANGES, CLOSED_BY, GROUPS, LEDGER, QUARANTINE, SALES, SCHEMAS, Layers
from sluicebox.plans.quality import check_quality
from sluicebox.plans.remediation import remediate
from sluicebox.session import setting
from sluicebox.sources import bronze
from sluicebox.sources.tables import KeyedTable, TableStore
from sluicebox.streaming import ingest as stream_ingest


def put(root, name, df, day="2024-05-02", change=None):
    """One Parquet file with pandas' types: money as double, integers with NULLs as double."""
    folder = root / "sales" / f"ingest_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    pdf = df.toPandas()
    for c in ("unit_price", "discount_percentage", "discount_amount", "gross_amount", "net_amount", "profit_margin"):
        if c in pdf and pdf[c].map(type).ne(str).all():
            pdf[c] = pdf[c].astype(float)
    if change:
        pdf = change(pdf)
    pq.write_table(pa.Table.from_pandas(pdf, preserve_index=False), str(folder / f"{name}.parquet"))


@pytest.fixture
def landed(spark, tmp_path):
    root = tmp_path / "bronze"
    put(root, "a_clean", sales_maker.sales(spark, 200))
    put(root, "b_mixed", sales_maker.sales(spark, 200, "mixed", seed=7), change=lambda p: p.assign(
        quantity=p["quantity"].astype(float)))
    put(root, "c_missing", sales_maker.invalid_sales(spark, 20, "missing_required_columns"))
    put(root, "d_types", sales_maker.invalid_sales(spark, 20, "wrong_column_types"))
    put(root, "e_empty", sales_maker.sales(spark, 0))
    (root / "sales" / "ingest_date=2024-05-02" / "f_broken.parquet").write_bytes(b"not parquet")
    (root / "other").mkdir()
    return root


def statuses(layers):
    return {r["file_path"].split("/")[-1][0]: (r["status"], r["error_message"]) for r in layers.read(LEDGER).collect()}


def check_ingested(layers):
    found = statuses(layers)
    assert [found[k][0] for k in "abcdef"] == ["PROCESSED", "PROCESSED", "SCHEMA_DRIFT", "SCHEMA_DRIFT", "FAILED", "FAILED"]
    assert found["c"][1].startswith("Schema drift: Missing columns: category, customer_id")
    assert "Unusable types: is_holiday, is_weekend, quantity, sale_date, sale_hour, transaction_id" in found["d"][1]
    assert found["e"][1] == "No data found" and found["f"][1] == "Unreadable file"
    sales, failed = layers.read(SALES), layers.read(QUARANTINE)
    # both good files number their transactions from 1: the later file's rows win
    assert sales.count() == 200 and failed.count() == 40
    assert sales.where(F.col("source_file").endswith("b_mixed.parquet")).count() == 160
    assert failed.groupBy("error_reason").count().count() == 1
    assert failed.where("error_reason = 'null:customer_id;range:quantity'").count() == 40
    assert layers.read(AUDIT).where("status = 'RUNNING' and finished_at is null").count() == 1
    audit = latest_audit(layers.read(AUDIT)).first()
    assert (audit["rows_read"], audit["rows_written_silver"], audit["rows_quarantined"], audit["status"]) == (
        440, 360, 40, "COMPLETED_WITH_ERRORS")
    assert audit["finished_at"] > audit["started_at"]
    marks = {r["file_path"].split("/")[-1][0]: r["checksum"] for r in layers.read(LEDGER).collect()}
    assert marks["a"] and marks["b"] and marks["a"] != marks["b"] and marks["c"] is None
    assert len(audit["files_scanned"]) == 6


def test_ingest_gates_files_and_splits_rows(spark, layers, landed):
    assert ingest(spark, layers, str(landed), "run1", NOW) == 1
    check_ingested(layers)
    # nothing is pending any more
    assert ingest(spark, layers, str(landed), "run2", NOW) == 0
    put(landed, "g_more", sales_maker.sales(spark, 250), day="2024-05-03")
    assert ingest(spark, layers, str(landed), "run3", NOW + timedelta(hours=6)) == 1
    assert layers.read(SALES).count() == 250
    assert layers.read(LEDGER).count() == 7


def test_small_waves_reach_the_same_tables(spark, layers, landed):
    assert ingest(spark, layers, str(landed), "run1", NOW, files_per_wave=3) == 2
    assert layers.read(SALES).count() == 200 and layers.read(QUARANTINE).count() == 40
    assert layers.read(SALES).where(F.col("source_file").endswith("b_mixed.parquet")).count() == 160


def test_stream_ingest_sees_only_new_files(spark, layers, landed, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    stream_ingest.start(spark, layers, str(landed), checkpoint, "s1", NOW).awaitTermination()
    check_ingested(layers)
    put(landed, "g_more", sales_maker.sales(spark, 250), day="2024-05-03")
    stream_ingest.start(spark, layers, str(landed), checkpoint, "s2", NOW).awaitTermination()
    assert layers.read(SALES).count() == 250
    assert latest_audit(layers.read(AUDIT)).orderBy("rows_read").first()["rows_read"] == 250


def keyed(spark, root, buckets=4):
    schema = spark.createDataFrame([], "transaction_id string, sale_date date, quantity int, note string").schema
    return KeyedTable(TableStore(spark, str(root)), "sales", schema, ["transaction_id"], "sale_date", buckets)


def batch_of(spark, *values):
    df = spark.createDataFrame(list(values), "transaction_id string, d string, quantity int, n int")
    return df.select("transaction_id", F.col("d").cast("date").alias("sale_date"), "quantity", F.lit("x").alias("note"), "n")


def folders(table):
    """Data files by folder."""
    found = {}
    for f in table.spark.read.table(table.open()).inputFiles():
        found.setdefault(f.split(table.name + "/")[1].rsplit("/", 1)[0], set()).add(f)
    return found


def test_merge_equals_upsert_and_replaces_touched_folders_only(spark, tmp_path):
    table = keyed(spark, tmp_path)
    merge = lambda *values, **kw: table.merge(batch_of(spark, *values), ["sale_date", "quantity"], "n", ["sale_date"], "changes", **kw)
    assert table.read().count() == 0 and merge() == 0
    merge(("a", "2024-01-01", 1, 1), ("b", "2024-02-02", 2, 1), ("c", "2024-03-03", 3, 1), ("d", "2024-03-03", 4, 1), (None, "2024-01-09", 9, 1))
    first = folders(table)
    # b leaves its folder empty, d stays, e is new and comes twice
    assert merge(("b", "2024-04-04", 20, 1), ("e", "2024-04-04", 5, 1), ("e", "2024-04-05", 50, 2)) <= 3
    rows = [("a", "2024-01-01", 1), ("b", "2024-04-04", 20), ("c", "2024-03-03", 3), ("d", "2024-03-03", 4), ("e", "2024-04-05", 50)]
    assert content_without_null(table) == rows
    now = folders(table)
    assert not any("_month=2024-02" in f for f in now)
    assert {f: first[f] for f in first if "2024-01" in f or "2024-03" in f} == {f: now[f] for f in now if "2024-01" in f or "2024-03" in f}
    changes = {r["transaction_id"]: (r["_before"], r["_after"]["sale_date"].isoformat()) for r in table.store.read("changes").where("transaction_id in ('b', 'e')").collect()
               if r["_before"] or r["transaction_id"] == "e"}
    assert changes["b"][0]["sale_date"].isoformat() == "2024-02-02" and changes["b"][1] == "2024-04-04"
    assert changes["e"] == (None, "2024-04-05")
    # a session that does not know the table yet finds it in its folder
    spark.sql(f"DROP TABLE {table.table}")
    assert content_without_null(keyed(spark, tmp_path)) == rows


def content_without_null(table):
    return sorted((r[0], r[1].isoformat(), r[2]) for r in table.read().where("transaction_id is not null").collect())


def test_merge_shuffles_the_batch_but_not_the_table(spark, tmp_path):
    table = keyed(spark, tmp_path, buckets=8)
    day = lambda i: f"2024-0{1 + i % 5}-1{i % 9}"
    table.merge(batch_of(spark, *[(f"t{i}", day(i), i, 0) for i in range(2000)]), None, "n")
    batch = table.placed(batch_of(spark, *[(f"t{i}", day(i), -i, 0) for i in range(0, 2000, 100)]).drop("n")).where("_bucket < 3")
    touched = table.touched(batch)
    assert {b for buckets in touched.values() for b in buckets} <= {0, 1, 2}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = table.merged(batch, touched, None)._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and plan.count("Exchange hashpartitioning(") == 1, plan
        # the scan is limited to the touched folders
        read = table.rows(table.folders(touched)).inputFiles()
        assert 0 < len(read) < len(table.rows().inputFiles()) / 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unfinished_replacement_is_done_again(spark, tmp_path):
    table = keyed(spark, tmp_path)
    table.merge(batch_of(spark, ("a", "2024-01-01", 1, 1), ("b", "2024-02-01", 2, 1)), None, "n")
    # a driver that dies after the new content was written aside, with one folder already replaced
    batch = table.placed(batch_of(spark, ("a", "2024-03-01", 10, 1), ("c", "2024-02-01", 3, 1)).drop("n"))
    table.merged(batch, table.touched(batch), None).write.parquet(table._aside("dead"))
    (tmp_path / "_merging" / "sales" / "half").mkdir()
    spark.sql(f"DROP TABLE {table.table}")
    again = keyed(spark, tmp_path)
    assert content_without_null(again) == [("a", "2024-03-01", 10), ("b", "2024-02-01", 2), ("c", "2024-02-01", 3)]
    assert not list((tmp_path / "_merging" / "sales").iterdir())


def sale_rows(spark, *rows):
    return silver_frame(spark, [sale(**r) for r in rows]).withColumn("arrival", F.monotonically_increasing_id())


def gold_rows(layers):
    names = [n for n in SCHEMAS if n.startswith("gold.")] + ["silver.customers", "silver.products"]
    return {n: sorted(map(str, layers.read(n).collect())) for n in names}


@pytest.mark.parametrize("drop_vanished", [True, False])
def test_refreshed_gold_equals_a_rebuild(spark, layers, tmp_path, drop_vanished):
    day = lambda m, d: date(2024, m, d)
    base = [dict(transaction_id=f"T{i}", sale_date=day(1 + i % 4, 1 + i % 3), customer_id=f"C{i % 7}", product_id=f"P{i % 5}",
                 category="AB"[i % 2], store_location=f"S{i % 3}", net_amount=Decimal(i), payment_method="xy"[i % 2]) for i in range(60)]
    base += [dict(transaction_id="lone", sale_date=day(6, 1), customer_id="gone", product_id="gone", category="gone", store_location="gone"),
             dict(transaction_id="odd", sale_date=day(1, 1), category=None, store_location=None)]
    late = [dict(transaction_id="lone", sale_date=day(2, 2), customer_id="C1", product_id="P1", category="A", store_location="S1"),
            dict(transaction_id="T3", sale_date=day(2, 9), customer_id="C2", product_id="P9", category="C", store_location="S9", net_amount=Decimal(500)),
            dict(transaction_id="new", sale_date=day(2, 1), customer_id="C3", product_id="P2", category="B", store_location="S0")]
    layers.sales.merge(sale_rows(spark, *base), None, "arrival", GROUPS, CHANGES)
    refresh_gold(layers, date(2024, 7, 1))
    untouched = folders(layers.sales)
    layers.sales.merge(sale_rows(spark, *late), None, "arrival", GROUPS, CHANGES)
    # of silver only the months of the changes are read: T3 came from April, lone from June
    read = changed_sales(layers, layers.store.read(CHANGES)).inputFiles()
    assert {f.split("_month=")[1][:7] for f in read} <= {"2024-02", "2024-04", "2024-06"} and untouched
    refresh_gold(layers, date(2024, 8, 1), drop_vanished=drop_vanished)
    assert not layers.store.exists(CHANGES)

    other = Layers(spark, str(tmp_path / "other"))
    other.sales.merge(layers.read(SALES), None)
    build_gold(other, date(2024, 8, 1))
    mine, whole = gold_rows(layers), gold_rows(other)
    if drop_vanished:
        assert mine == whole
    else:
        for name, rows in whole.items():
            assert set(rows) <= set(mine[name]) and len(mine[name]) == len(rows) + 1, name
    # nothing to do but the customers' days
    refresh_gold(layers, date(2024, 8, 2), drop_vanished=drop_vanished)
    moved = layers.read("silver.customers").where("customer_id = 'C3'").first()["days_since_last_purchase"]
    assert moved == other.read("silver.customers").where("customer_id = 'C3'").first()["days_since_last_purchase"] + 1


def test_remediation_leaves_closed_files_alone(spark, layers):
    payload = lambda **kw: json.dumps({k: float(v) if isinstance(v, Decimal) else v for k, v in sale(**kw).items()}, default=str)
    texts = [payload(transaction_id="ok"), payload(transaction_id="low", quantity=-1), payload(transaction_id="off", discount_percentage=150), "{no"]
    record = lambda i, text: (i, text, "why", NOW, "run", "f", None, None, False, None, "pending", 0)
    layers.append(QUARANTINE, spark.createDataFrame([record(i, t) for i, t in enumerate(texts)], SCHEMAS[QUARANTINE]))
    totals = remediate(layers, "fix1", NOW).first()
    assert (totals["fixed"], totals["failed"], totals["rejected"], totals["now_pending"], totals["total"]) == (1, 1, 2, 1, 4)
    assert [r["transaction_id"] for r in layers.read(SALES).collect()] == ["ok"]
    closed = {f for f in layers.read(QUARANTINE).inputFiles() if f"{CLOSED_BY}=fix1" in f}
    layers.append(QUARANTINE, spark.createDataFrame([record(9, payload(transaction_id="two"))], SCHEMAS[QUARANTINE]))
    for name, retries in (("fix2", 2), ("fix3", 3)):
        remediate(layers, name, NOW + timedelta(days=retries))
        assert layers.read(QUARANTINE).where("id = 2").first()["retry_count"] == retries
    assert closed and closed <= set(layers.read(QUARANTINE).inputFiles())
    states = {r["id"]: r["remediation_status"] for r in layers.read(QUARANTINE).collect()}
    assert states == {0: "remediated", 1: "rejected", 2: "dead_letter", 3: "rejected", 9: "remediated"}
    # a run that is repeated under its name settles the same records, and keeps what came since
    layers.append(QUARANTINE, spark.createDataFrame([record(10, "{no")], SCHEMAS[QUARANTINE]))
    again = remediate(layers, "fix3", NOW + timedelta(days=3)).first()
    assert again["total"] == 6 and again["now_pending"] == 1 and layers.read(QUARANTINE).count() == 6


def test_whole_cycle(spark, layers, landed):
    ingest(spark, layers, str(landed), "run1", NOW)
    build_gold(layers, date(2024, 6, 1))
    before = {n: layers.read(n).count() for n in SCHEMAS}
    build_gold(layers, date(2024, 6, 1))
    assert before == {n: layers.read(n).count() for n in SCHEMAS}

    summary, report = check_quality(layers, NOW + timedelta(hours=1))
    row = summary.first()
    assert row["quarantine_issues"] and not row["integrity_issues"] and not row["freshness_issues"]
    assert report.where("section = 'completeness' and status = 'pass'").count() == 10
    summary, _ = check_quality(layers, NOW + timedelta(hours=26))
    assert summary.first()["freshness_issues"] and not summary.first()["drift_issues"]

    totals = remediate(layers, "fix1", NOW + timedelta(hours=2)).first()
    assert (totals["rejected"], totals["now_pending"]) == (40, 0)
    assert layers.read(QUARANTINE).where("remediation_status = 'rejected' and replayed").count() == 40

    tables = layers.tables()
    for name, query in dashboards.DASHBOARDS.items():
        assert query(tables).count() >= 1, name


def test_store_saves(spark, tmp_path):
    store = TableStore(spark, str(tmp_path))
    store.write("t", spark.range(3))
    # a table may be replaced by what is read from it
    assert store.replace("t", store.read("t").where("id > 0"), spark.range(0).schema).count() == 2
    store.append("t", spark.range(2))
    assert store.read("t").count() == 4
    assert store.truncate("t", spark.range(0).schema).count() == 0
    for rows, batch in ((3, 0), (2, 1), (5, 0)):
        store.write_partitions("p", spark.range(rows).withColumn("batch", F.lit(batch)), ["batch"])
    assert store.read("p").count() == 7
    (tmp_path / "u" / "_temporary").mkdir(parents=True)
    assert not store.exists("u")
    with pytest.raises(LookupError):
        store.read("u")


def test_hive_layout_round_trip(spark, tmp_path):
    df = sales_maker.sales(spark, 100).withColumn("ingest_date", F.when(F.col("quantity") > 5, "2024-01-02").otherwise("2024-01-01"))
    bronze.write_partitioned(df, str(tmp_path / "sales"))
    listed = bronze.list_files(spark, str(tmp_path), ingest_date="2024-01-02")
    assert listed.count() >= 1
    dates = bronze.ingest_dates(bronze.list_files(spark, str(tmp_path))).collect()
    assert [r[0] for r in dates] == [date(2024, 1, 1), date(2024, 1, 2)]
    back = spark.read.parquet(str(tmp_path / "sales"))
    assert back.count() == 100 and dict(back.dtypes)["ingest_date"] == "date"
    assert [r[0] for r in bronze.dataset_names(bronze.list_files(spark, str(tmp_path)), str(tmp_path)).collect()] == ["sales"]


def test_fingerprint_ignores_order_but_not_values(spark):
    df = sales_maker.sales(spark, 50).withColumn("source_file", F.lit("f"))
    mark = lambda d: bronze.fingerprint(d, df.columns).first()["checksum"]
    assert mark(df) == mark(df.orderBy(F.desc("quantity")))
    assert mark(df) != mark(df.withColumn("quantity", F.col("quantity") + 1))


def test_listing_takes_few_tasks_whatever_the_files_hold(spark, tmp_path):
    spark.range(0, 40_000, 1, 40).withColumn("s", F.rand(3)).write.parquet(str(tmp_path / "sales"))
    listed = lambda: bronze.list_files(spark, str(tmp_path)).rdd.getNumPartitions()
    with setting(spark, "spark.sql.files.maxPartitionBytes", "1000"), setting(spark, "spark.sql.files.openCostInBytes", "100"):
        assert listed() >= 40
        with setting(spark, "spark.sql.files.maxPartitionNum", "8"):
            assert listed() <= 8
