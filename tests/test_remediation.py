import json
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from helpers import NOW, frame, ntz, sale, silver_frame
from sluicebox import schemas
from sluicebox.operators import quality, remediation

BASE = {"transaction_id": "T1", "sale_date": "2024-05-01", "customer_id": "C1", "product_id": "P1",
        "quantity": 5, "unit_price": 10.0}


def record(payload, id=1, **changes):
    text = payload if isinstance(payload, str) else json.dumps(payload)
    row = {"id": id, "payload": text, "error_reason": "null:x", "failed_at": NOW, "ingestion_run_id": "r",
           "source_file": "f", "corrected_by": None, "corrected_at": None, "replayed": False,
           "replayed_at": None, "remediation_status": "pending", "retry_count": 0}
    return {**row, **changes}


def records(spark, *rows):
    return frame(spark, list(rows), schemas.QUARANTINE)


def reason(spark, payload):
    return remediation.validate(records(spark, record(payload))).first()["reject_reason"]


def without(*names, **changes):
    return {k: v for k, v in {**BASE, **changes}.items() if k not in names}


def test_reject_reasons(spark):
    cases = [
        (BASE, None),
        ({"transaction_id": "T1"}, "Missing fields: ['sale_date', 'product_id', 'quantity', 'unit_price', 'customer_id']"),
        (without("customer_id"), "Missing fields: ['customer_id']"),
        ({**BASE, "customer_id": ""}, "Missing fields: ['customer_id']"),
        ({**BASE, "customer_id": None}, "Missing fields: ['customer_id']"),
        ({**BASE, "quantity": 0}, "Missing fields: ['quantity']"),
        ({**BASE, "unit_price": 0}, "Missing fields: ['unit_price']"),
        ({**BASE, "unit_price": 0.0}, "Missing fields: ['unit_price']"),
        ({**BASE, "customer_id": "0"}, None),
        ({**BASE, "customer_id": []}, "Missing fields: ['customer_id']"),
        ({**BASE, "quantity": -5}, "Invalid quantity (<= 0)"),
        ({**BASE, "unit_price": -10.0}, "Invalid unit_price (< 0)"),
        ({**BASE, "quantity": "5"}, "Parse error: quantity is not a number"),
        ({**BASE, "unit_price": "ten"}, "Parse error: unit_price is not a number"),
        ("not valid json", "Parse error: malformed payload"),
        ("[1, 2]", "Parse error: malformed payload"),
        ('{"a": ', "Parse error: malformed payload"),
    ]
    df = records(spark, *[record(p, id=i) for i, (p, _) in enumerate(cases)])
    found = {r["id"]: r["reject_reason"] for r in remediation.validate(df).collect()}
    assert [found[i] for i in range(len(cases))] == [expected for _, expected in cases]


def test_a_payload_is_parsed_once(spark):
    plan = remediation.validate(records(spark, record(BASE)))._jdf.queryExecution().optimizedPlan().toString().lower()
    assert plan.count("parsejson(") == 1, plan
    assert reason(spark, '{"transaction_id": "T1", "transaction_id": "T2"}') == "Parse error: malformed payload"
    assert reason(spark, '"text"') == reason(spark, "null") == reason(spark, "") == "Parse error: malformed payload"


def examined(spark, *rows, **kw):
    return remediation.examine(records(spark, *rows), F.lit(date(2024, 6, 1)), ntz(), **kw)


def test_replay_recomputes_amounts_and_defaults(spark):
    done = examined(spark, record({**BASE, "quantity": 3, "unit_price": 19.99, "discount_percentage": 12.5}))
    row = remediation.replay(silver_frame(spark, []), done).first()
    assert (row["gross_amount"], row["discount_amount"], row["net_amount"]) == (
        Decimal("59.97"), Decimal("7.50"), Decimal("52.47"))
    assert (row["sale_hour"], row["customer_name"], row["is_weekend"], row["ingest_date"]) == (0, "", False, date(2024, 6, 1))


def test_replay_updates_only_its_columns(spark):
    silver = silver_frame(spark, [sale(quantity=1, customer_name="Kept", category="Old")])
    done = examined(spark, record({**BASE, "category": "New", "customer_name": "Other"}))
    row = remediation.replay(silver, done).collect()
    assert len(row) == 1
    assert (row[0]["quantity"], row[0]["category"], row[0]["customer_name"]) == (5, "Old", "Kept")


def test_failing_replay_counts_up_and_dead_letters(spark):
    broken = {**BASE, "discount_percentage": "much"}
    rows = [record(broken, id=1), record(broken, id=2, retry_count=2), record(BASE, id=3, retry_count=3),
            record({**BASE, "sale_date": "yesterday"}, id=4), record({**BASE, "sale_hour": 25}, id=5),
            record(BASE, id=6, remediation_status="rejected", replayed=True)]
    after = {r["id"]: r for r in remediation.settle(examined(spark, *rows), ntz()).collect()}
    assert (after[1]["remediation_status"], after[1]["retry_count"], after[1]["replayed"]) == ("pending", 1, False)
    assert (after[2]["remediation_status"], after[2]["retry_count"]) == ("dead_letter", 3)
    assert after[3]["error_reason"] == "null:x | Dead-lettered after 3 retries"
    assert after[4]["retry_count"] == after[5]["retry_count"] == 1
    assert (after[6]["remediation_status"], after[6]["retry_count"]) == ("rejected", 0)


def test_settled_states(spark):
    rows = [record(BASE, id=1), record("oops", id=2)]
    after = {r["id"]: r for r in remediation.settle(examined(spark, *rows), ntz()).collect()}
    assert (after[1]["remediation_status"], after[1]["corrected_by"], after[1]["error_reason"]) == (
        "remediated", "remediation_dag", "null:x")
    assert after[2]["error_reason"] == "null:x | Rejected: Parse error: malformed payload"
    assert (after[2]["corrected_by"], after[2]["replayed_at"]) == ("auto_rejected", NOW)
    totals = remediation.run_totals(examined(spark, *rows), ntz()).first()
    assert (totals["fixed"], totals["failed"], totals["rejected"], totals["now_pending"]) == (1, 0, 1, 0)


def test_pending_batch_is_oldest_first(spark):
    rows = [record(BASE, id=i, failed_at=NOW.replace(day=5 - i)) for i in range(1, 4)] + [record(BASE, id=9, retry_count=3)]
    assert [r["id"] for r in remediation.pending_batch(records(spark, *rows), limit=2).collect()] == [3, 2]


def test_migration_adds_state_and_closes_replayed(spark):
    old = records(spark, record(BASE, id=1, replayed=True), record(BASE, id=2)).drop("remediation_status", "retry_count")
    found = {r["id"]: (r["remediation_status"], r["retry_count"]) for r in remediation.migrate(old).collect()}
    assert found == {1: ("remediated", 0), 2: ("pending", 0)}


def test_retry_increment_and_stats(spark):
    df = records(spark, record(BASE, id=1), record(BASE, id=2), record(BASE, id=3, remediation_status="rejected"))
    counted = remediation.count_up(df, df.where("id = 2"))
    assert {r["id"]: r["retry_count"] for r in counted.collect()} == {1: 0, 2: 1, 3: 0}
    stats = quality.status_counts(df).first()
    assert (stats["total"], stats["pending"], stats["rejected"], stats["dead_letter"]) == (3, 2, 1, 0)
