import random
from datetime import datetime, timedelta

from sluicebox import specs
from sluicebox.operators import alerts

SCHEMA = "event_id long, alert_key string, severity string, ts timestamp_ntz"
START = datetime(2024, 1, 1)


def brute_force(rows):
    last, out = {}, {}
    order = {"critical": -1, "warning": 3600, "info": 21600}
    for id, key, severity, ts in sorted(rows, key=lambda r: (r[3], order[r[2]], r[0])):
        wait = specs.THROTTLE_SECONDS[severity]
        sent = wait is None or key not in last or (ts - last[key]).total_seconds() > wait
        if sent:
            last[key] = ts
        out[id] = "sent" if sent else "throttled"
    return out


def make(seed, count, severities, keys=("hot", "hot", "a", "b")):
    rng = random.Random(seed)
    return [(i, rng.choice(keys), rng.choice(severities), START + timedelta(seconds=rng.randrange(300000)))
            for i in range(count)]


def decisions(df):
    return {r["event_id"]: r["decision"] for r in df.collect()}


def test_matches_one_by_one_decisions(spark):
    for severities in (["warning"], ["info"], ["critical", "warning", "info"]):
        rows = make(len(severities), 800, severities)
        assert decisions(alerts.throttle(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_one_key_over_many_blocks(spark):
    """Dense and sparse stretches, days without alerts, and alerts at the very edges of blocks and halos."""
    for seed, count, days in ((1, 1500, 12), (2, 60, 90), (3, 5, 400)):
        rng = random.Random(seed)
        rows = [(i, "only", rng.choice(["critical", "warning", "info", "info"]), START + timedelta(seconds=rng.randrange(days * alerts.BLOCK)))
                for i in range(count)]
        edges = [0, 1, alerts.HALO - 1, alerts.HALO, alerts.HALO + 1, alerts.BLOCK - 1]
        rows += [(count + i, "only", rng.choice(["warning", "info"]), START + timedelta(days=rng.randrange(days), seconds=rng.choice(edges)))
                 for i in range(40)]
        assert decisions(alerts.throttle(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)


def test_a_hot_key_is_spread_over_blocks(spark):
    rows = [(i, "only", "info", START + timedelta(minutes=7 * i)) for i in range(6000)]
    seconds = alerts.sent_seconds(spark.createDataFrame(rows, SCHEMA))
    assert seconds.count() == len({k for k, v in brute_force(rows).items() if v == "sent"})
    # the last step, like the others, takes a key's block at a time
    step = next(line for line in seconds._jdf.queryExecution().analyzed().toString().splitlines() if "CoGroup" in line)
    assert step.count("block") >= 2, step


def test_no_alerts(spark):
    assert alerts.throttle(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = [(1, None, "warning", START), (2, None, "critical", START), (3, "k", "info", None)]
    assert alerts.throttle(spark.createDataFrame(rows, SCHEMA)).count() == 3


def test_exact_interval_is_still_throttled(spark):
    rows = [(1, "k", "warning", START), (2, "k", "warning", START + timedelta(seconds=3600)),
            (3, "k", "warning", START + timedelta(seconds=3601))]
    assert decisions(alerts.throttle(spark.createDataFrame(rows, SCHEMA))) == {1: "sent", 2: "throttled", 3: "sent"}


def test_fold_continues_across_arrow_batches(spark):
    rows = make(9, 600, ["warning"])
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert decisions(alerts.throttle(spark.createDataFrame(rows, SCHEMA))) == brute_force(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_earlier_state_counts(spark):
    rows = [(1, "k", "warning", START + timedelta(seconds=100)), (2, "k", "warning", START + timedelta(seconds=4000))]
    before = spark.createDataFrame([("k", int((START - datetime(1970, 1, 1)).total_seconds()))], "alert_key string, second long")
    assert decisions(alerts.throttle(spark.createDataFrame(rows, SCHEMA), before)) == {1: "throttled", 2: "sent"}


def seconds_since_1970(ts):
    return int((ts - datetime(1970, 1, 1)).total_seconds())


def test_same_second_and_late_alerts_wait_too(spark):
    before = spark.createDataFrame([(f"k{n}", seconds_since_1970(START)) for n in range(50)], "alert_key string, second long")
    rows = [(n, f"k{n}", "warning", START) for n in range(50)] + [(50 + n, f"k{n}", "info", START - timedelta(hours=n + 1)) for n in range(50)]
    assert set(decisions(alerts.throttle(spark.createDataFrame(rows, SCHEMA), before)).values()) == {"throttled"}


def test_batches_decide_as_one_pass(spark):
    rows = sorted(make(4, 400, ["critical", "warning", "info"]), key=lambda r: r[3])
    state, found = None, {}
    for first in range(0, len(rows), 100):
        # a second is not split
        part = spark.createDataFrame(rows[first : first + 100], SCHEMA)
        got = decisions(alerts.throttle(part, state))
        found.update(got)
        sent = [(key, seconds_since_1970(ts)) for id, key, _, ts in rows if found.get(id) == "sent"]
        state = spark.createDataFrame(sent, "alert_key string, second long")
    assert found == brute_force(rows)
