from decimal import Decimal

from pyspark.sql import types as T

from helpers import frame, sale
from sluicebox import specs
from sluicebox.operators import checks, validation


def reasons(df):
    return [r["error_reason"] for r in df.select("transaction_id", "error_reason").orderBy("transaction_id").collect()]


def test_tags_follow_rule_order(spark):
    df = frame(spark, [
        sale(transaction_id="a"),
        sale(transaction_id="b", customer_id=None, quantity=-5, net_amount=None),
        sale(transaction_id="c", quantity=1001, unit_price=Decimal("-1.00"), discount_percentage=Decimal("150.00")),
        sale(transaction_id="d", discount_percentage=None),
        sale(transaction_id="e", quantity=1000, unit_price=Decimal("100000.00"), discount_percentage=Decimal("100.00")),
    ])
    assert reasons(validation.tag_rows(df, specs.SALES)) == [
        None, "null:customer_id;null:net_amount;range:quantity",
        "range:quantity;range:unit_price;range:discount_percentage", None, None,
    ]


def test_nan_counts_as_null(spark):
    df = spark.createDataFrame(
        [("a", float("nan")), ("b", 2.0), ("c", float("inf"))], "transaction_id string, quantity double"
    )
    spec = specs.DatasetSpec("x", df.schema, required=("quantity",), ranges={"quantity": (1, 1000)})
    assert reasons(validation.tag_rows(df, spec)) == ["null:quantity", None, "range:quantity"]
    stats = validation.column_stats(df, ["quantity"]).collect()[0]
    assert (stats["null_count"], stats["unique_count"], stats["min_value"]) == (1, 2, 2.0)


def test_column_stats_of_every_kind_in_two_scans(spark, tmp_path):
    schema = "k string, n long, x double, d date, flag boolean, raw binary, many array<int>"
    rows = [("a", 1, 0.0, None, True, b"1", [1]), ("b", 2, -0.0, None, True, b"2", [1]), ("a", None, float("nan"), None, None, b"1", [2]),
            (None, 2**53 + 1, 2.5, None, False, None, None)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "t"))
    stats = validation.column_stats(spark.read.parquet(str(tmp_path / "t")))
    assert stats._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 2
    found = {r["column_name"]: tuple(r)[2:] for r in stats.collect()}
    assert found["k"] == (1, 2, None, None, None) and found["d"] == (4, 0, None, None, None)
    assert found["n"] == (1, 3, 1.0, float(2**53 + 1), float(2**53 + 4) / 3)
    # the zeros are one value and NaN is none
    assert found["x"] == (1, 2, 0.0, 2.5, 2.5 / 3)
    assert [found[c][:2] for c in ("flag", "raw", "many")] == [(1, 2), (1, 2), (1, 2)]
    sketched = validation.column_stats(spark.range(5000).selectExpr("id % 700 AS v", "cast(id AS string) AS s"), exact=False)
    for row, exact in zip(sketched.orderBy("column_name").collect(), (5000, 700)):
        assert abs(row["unique_count"] - exact) <= 0.05 * exact


def test_stored_types_of_files(spark):
    rows = [("f1", 1, "a", "int32"), ("f1", 1, "b", "timestamp[us]"), ("f2", 1, "a", "string"), ("f2", 1, "b", "date32"), ("broken", None, None, None)]
    footers = spark.createDataFrame(rows, "file_path string, row_count long, column_name string, column_type string")
    found = validation.stored_type_errors(footers, {"a": "integer", "b": "datetime", "c": "boolean"}).collect()
    assert {(r["file_path"], r["message"]) for r in found} == {
        ("f1", "Column 'c' not found"), ("f2", "Column 'c' not found"), ("f2", "Column 'a': expected integer, got string"),
        *[("broken", f"Column '{c}' not found") for c in "abc"],
    }


def test_storage_constraints_tag_only_rows_the_rules_pass(spark):
    df = frame(spark, [
        sale(transaction_id="a", sale_hour=24, gross_amount=Decimal("-1.00")),
        sale(transaction_id="b", sale_hour=24, customer_id=None),
        sale(transaction_id="c", discount_percentage=None),
    ])
    assert reasons(validation.tag_all(df, specs.SALES)) == [
        "check:sale_hour;check:gross_amount", "null:customer_id", "check:discount_percentage",
    ]
    assert validation.good_rows(df, specs.SALES).count() == 0
    assert validation.bad_rows(df, specs.SALES).count() == 3


def test_good_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, [sale(), sale(customer_id=None)]).write.parquet(path)
    good = validation.good_rows(spark.read.parquet(path), specs.SALES)
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(customer_id)" in plan
    assert good.count() == 1


def test_uniqueness_counts_all_copies(spark):
    df = frame(spark, [sale(transaction_id=t) for t in "aaabbc"])
    row = validation.uniqueness(df, ["transaction_id"]).collect()[0]
    assert (row["duplicate_rows"], row["duplicate_keys"]) == (5, 2)
    assert [(r["transaction_id"], r["cnt"]) for r in checks.unique_check(df, "transaction_id").collect()] == [("a", 3), ("b", 2)]


def test_empty_frame_reports(spark):
    df = frame(spark, [])
    report = {(r["check"], r["column_name"]): r for r in validation.full_validation(df, specs.SALES).collect()}
    assert all(r["passed"] and r["failed_count"] == 0 for r in report.values())
    assert len(report) == 3 + 7 + 6 + 1


def test_full_validation_names_absent_columns(spark):
    df = frame(spark, [sale()]).drop("region").selectExpr("*", "1 AS bonus")
    report = {r["check"]: r for r in validation.full_validation(df, specs.SALES).collect()}
    assert (report["missing_columns"]["column_name"], report["missing_columns"]["passed"]) == ("region", False)
    assert (report["extra_columns"]["column_name"], report["extra_columns"]["passed"]) == ("bonus", True)


def test_schema_drift_details(spark):
    names = [c for c in specs.SALES.file_columns if c not in ("region", "category")]
    types = {c: "string" for c in names}
    types.update(quantity="string", sale_date="date32", sale_hour="int64", is_weekend="int64", is_holiday="int64")
    types.update(dict.fromkeys(
        ("unit_price", "discount_percentage", "discount_amount", "gross_amount", "net_amount", "profit_margin"), "double"))
    rows = [("f1", 1, c, t) for c, t in types.items()] + [("f1", 1, "zz", "int64"), ("f1", 1, "aa", "int64")]
    drift = validation.schema_drift(
        spark.createDataFrame(rows, "file_path string, row_count long, column_name string, column_type string"), specs.SALES
    ).collect()[0]
    assert drift["drift_details"] == "Missing columns: category, region. Extra columns: aa, zz."
    assert drift["type_mismatches"] == ["quantity"] and drift["has_drift"]


def test_type_errors():
    schema = T.StructType([T.StructField("quantity", T.StringType()), T.StructField("price", T.DecimalType(10, 2))])
    assert validation.type_errors(schema, {"quantity": "integer", "price": "float", "gone": "date"}) == [
        "Column 'quantity': expected integer, got string", "Column 'gone' not found",
    ]


def test_failure_sources_lists_worst_dates(spark):
    df = spark.createDataFrame(
        [("2024-01-01", None), ("2024-01-01", None), ("2024-01-02", None), ("2024-01-03", "x")],
        "ingest_date string, customer_id string")
    row = checks.failure_sources(df, "silver.sales", {"customer_id": "not_null"}).collect()
    assert [(r["source_key"], r["sources"]) for r in row] == [
        ("silver.sales.customer_id", "2024-01-01 (2 bad), 2024-01-02 (1 bad)")]
