import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from sluicebox.operators import alerts
from sluicebox.sources.tables import TableStore
from sluicebox.streaming import events

START = datetime(2024, 1, 1)


def land(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def test_throttle_stream_keeps_state_across_batches_and_runs(spark, tmp_path):
    schema = "event_id long, alert_key string, severity string, ts timestamp_ntz"
    rng = random.Random(5)
    rows = sorted(((i, rng.choice("aab"), rng.choice(["critical", "warning", "info", "info"]), START + timedelta(minutes=rng.randrange(4000)))
                   for i in range(400)), key=lambda r: r[3])
    folder, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "tables"))
    for first in (0, 200):
        # a minute is not split over files
        for k in (first, first + 100):
            land(spark, folder, rows[k : k + 100], schema)
        stream = events.parquet_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
        decided = events.store_batches(events.throttled(stream), store, "decided", str(tmp_path / "checkpoint"))
    whole = alerts.throttle(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, decided.select("event_id", "decision").collect())) == sorted(
        map(tuple, whole.select("event_id", "decision").collect()))
    assert decided.select("batch").distinct().count() == 4


def test_idle_keys_leave_the_state(spark, tmp_path):
    schema = "event_id long, alert_key string, severity string, ts timestamp_ntz"
    folder, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "tables"))
    # each file has a key of its own, ten hours after the one before
    for n in range(6):
        land(spark, folder, [(n, f"k{n}", "info", START + timedelta(hours=10 * n))], schema)
    stream = events.parquet_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
    query = events.drain(events.throttled(stream), str(tmp_path / "checkpoint"), lambda batch, n: batch.collect())
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    keys = spark.read.format("statestore").option("stateVarName", "last").load(str(tmp_path / "checkpoint"))
    assert 1 <= keys.count() <= 3, held


def test_daily_users_merge_over_batches_and_months(spark, tmp_path):
    schema = "event_id long, ts timestamp, user_id long, value double"
    rows = [(i, START + timedelta(hours=3 * i), i * 7 % 300 if i % 50 else None, 1.25) for i in range(600)]
    folder, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "tables"))
    for k in range(3):
        land(spark, folder, rows[k::3], schema)
    stream = events.parquet_stream(spark, folder, spark.createDataFrame([], schema).schema, files_per_batch=1)
    events.keep_daily(stream, store, "daily", str(tmp_path / "checkpoint"), "ts", "value", "user_id")
    assert store.read("daily").select("batch").distinct().count() == 3
    for period, of in (("day", lambda r: r[1].date()), ("month", lambda r: r[1].date().replace(day=1))):
        users, n = {}, {}
        for r in rows:
            users.setdefault(of(r), set()).add(r[2])
            n[of(r)] = n.get(of(r), 0) + 1
        for got in events.kept_daily(store, "daily", period).collect():
            exact = len(users[got["period"]] - {None})
            assert (got["users"], got["events"]) == (exact, n.pop(got["period"]))
            assert abs(got["approx_users"] - exact) <= 0.05 * exact + 1
        assert not n


def test_first_per_key_keeps_one_row(spark, tmp_path):
    schema = "transaction_id string, ts timestamp, v int"
    folder = str(tmp_path / "in")
    land(spark, folder, [("a", START, 1), ("b", START, 2)], schema)
    land(spark, folder, [("a", START + timedelta(hours=1), 3)], schema)
    seen = []
    stream = events.parquet_stream(spark, folder, spark.createDataFrame([], schema).schema)
    events.drain(
        events.first_per_key(stream, "transaction_id", "ts"), str(tmp_path / "checkpoint"),
        lambda batch, n: seen.extend(r["transaction_id"] for r in batch.collect()),
    )
    assert sorted(seen) == ["a", "b"]


def test_daily_updates(spark, tmp_path):
    schema = "event_id long, ts timestamp, user_id long, value double"
    folder, store = str(tmp_path / "in"), TableStore(spark, str(tmp_path / "tables"))
    land(spark, folder, [(i, START + timedelta(hours=i), i % 5, 1.5) for i in range(48)], schema)
    stream = events.parquet_stream(spark, folder, spark.createDataFrame([], schema).schema)
    events.drain(events.daily(stream, "ts", "value", "user_id"), str(tmp_path / "checkpoint"),
                 lambda batch, n: store.write(f"daily.{n}", batch), mode="update")
    rows = store.read("daily.0").where(F.col("events") > 0).orderBy("event_date").collect()
    assert [(r["events"], float(r["total_value"]), r["approx_users"]) for r in rows] == [(24, 36.0, 5), (24, 36.0, 5)]
