from pyspark.sql import functions as F

from sluicebox.operators import files, upsert

SCHEMA = "k string, a int, b int"


def rows(df):
    return sorted(map(tuple, df.collect()))


def test_later_rows_win_and_nothing_is_deleted(spark):
    target = spark.createDataFrame([("x", 1, 1), ("y", 2, 2)], SCHEMA)
    batch = spark.createDataFrame([("x", 5, 5, 1), ("x", 6, 6, 2), ("z", 7, 7, 1)], SCHEMA + ", n int")
    merged = upsert.merge_upsert(target, batch, ["k"], arrival="n")
    assert rows(merged) == [("x", 6, 6), ("y", 2, 2), ("z", 7, 7)]
    assert rows(upsert.merge_upsert(merged, batch, ["k"], arrival="n")) == rows(merged)


def test_partial_update_keeps_other_columns(spark):
    target = spark.createDataFrame([("x", 1, 1)], SCHEMA)
    batch = spark.createDataFrame([("x", 5, 5, 1), ("z", 7, 7, 1), ("z", 8, 8, 2)], SCHEMA + ", n int")
    merged = upsert.merge_upsert(target, batch, ["k"], ["a"], arrival="n")
    # a new key is inserted by its first row, and later rows update column a only
    assert rows(merged) == [("x", 5, 1), ("z", 8, 7)]


def test_null_in_batch_overwrites(spark):
    target = spark.createDataFrame([("x", 1, 1)], SCHEMA)
    batch = spark.createDataFrame([("x", None, 2)], SCHEMA)
    assert rows(upsert.merge_upsert(target, batch, ["k"])) == [("x", None, 2)]


def test_do_nothing_keeps_first(spark):
    target = spark.createDataFrame([("x", 1, 1)], SCHEMA)
    batch = spark.createDataFrame([("x", 5, 5, 1), ("z", 8, 8, 2), ("z", 7, 7, 1)], SCHEMA + ", n int")
    assert rows(upsert.merge_upsert(target, batch, ["k"], [], arrival="n")) == [("x", 1, 1), ("z", 7, 7)]


def test_hot_key_is_limited_before_the_shuffle(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    latest = upsert.latest_per_key(df, ["k"], [F.desc("v")])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
    assert latest.count() == 20001
    assert latest.where("k = 0").first()["v"] == 29997


def test_ledger_keeps_checksum_and_terminal_files_are_skipped(spark):
    schema = ("file_path string, dataset_name string, checksum string, ingest_date date, status string, "
              "record_count bigint, processed_at timestamp_ntz, run_id string, error_message string, created_at timestamp_ntz")
    row = lambda p, s, c: (p, "sales", c, None, s, 1, None, "r", None, None)
    ledger = spark.createDataFrame([row("sales/a", "PROCESSING", "one")], schema)
    after = files.ledger_upsert(ledger, spark.createDataFrame([row("sales/a", "PROCESSED", "two"), row("sales/b", "PROCESSING", None)], schema))
    found = {r["file_path"]: r for r in after.collect()}
    assert (found["sales/a"]["status"], found["sales/a"]["checksum"]) == ("PROCESSED", "one")
    listed = spark.createDataFrame([("sales/a",), ("sales/b",), ("sales/c",), ("other/d",)], "file_path string")
    pending = files.pending_files(listed, after, "sales")
    assert sorted(r[0] for r in pending.collect()) == ["sales/b", "sales/c"]


def test_run_severity_order(spark):
    runs = spark.createDataFrame([
        ("drift", ["f"], 10, 9, 1, 1), ("idle", [], 0, 0, 0, 0), ("error", ["f"], 10, 9, 0, 1),
        ("high", ["f"], 10, 6, 0, 0), ("half", ["f"], 10, 5, 0, 0), ("fine", ["f"], 10, 0, 0, 0),
    ], "run string, files_scanned array<string>, rows_read bigint, rows_quarantined bigint, drifted_files bigint, failed_files bigint")
    found = {r["run"]: (r["status_text"], r["severity"]) for r in files.run_severity(runs).collect()}
    assert found == {
        "drift": ("SCHEMA DRIFT", "critical"), "idle": ("NO DATA", "info"),
        "error": ("COMPLETED WITH ERRORS", "warning"), "high": ("HIGH QUARANTINE", "warning"),
        "half": ("PARTIAL SUCCESS", "warning"), "fine": ("SUCCESS", "info"),
    }
