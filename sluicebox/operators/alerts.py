"""Alert throttling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sluicebox import specs
from sluicebox.session import workers_import, written

ALWAYS = -1  # wait of an alert that is never held back
WAITS = sorted({ALWAYS if s is None else s for s in specs.THROTTLE_SECONDS.values()})
# seconds of a block: longer than any wait, so that a block and the halo after it show what follows
BLOCK = 7 * 86_400
HALO = max(WAITS) + 1


def waiting_time(severity: str = "severity") -> Column:
    """Seconds that must have passed since the key's last sent alert."""
    wait = F.lit(ALWAYS)
    for name, seconds in specs.THROTTLE_SECONDS.items():
        wait = F.when(F.col(severity) == name, F.lit(ALWAYS if seconds is None else seconds)).otherwise(wait)
    return wait.cast("bigint")


def _timed(alerts: DataFrame) -> DataFrame:
    return alerts.withColumns({
        "second": F.unix_seconds(F.col("ts").cast("timestamp")), "wait": waiting_time(),
    })


def _successors(rows):
    """Of a key's block, in order: the place of each second's next sent one, were it sent itself, among
    the rows (which go on into the halo), or their number where it lies beyond."""
    import numpy as np

    at, wait = rows["second"].to_numpy(), rows["wait"].to_numpy()
    out = np.full(len(at), len(at))
    for w in np.unique(wait):
        places = np.flatnonzero(wait == w)
        # the first second of this wait that is late enough, and later in any case
        found = np.searchsorted(at[places], at + max(int(w), 0), "right")
        out = np.minimum(out, np.append(places, len(at))[found])
    return at, out


def _links(key, rows):
    """Per second of a block: the last second sent in the block if this one is, and the one sent after
    that, if the halo shows it."""
    import numpy as np
    import pandas as pd

    rows = rows.sort_values("second", ignore_index=True)
    at, following = _successors(rows)
    own = (rows["block"] == rows["home"]).to_numpy()
    n, size = int(own.sum()), len(at)
    # pointers within the block double until each reaches its last
    last = np.where(following[:n] < n, following[:n], np.arange(n))
    while not np.array_equal(again := last[last], last):
        last = again
    after = following[:n][last]
    return pd.DataFrame({
        "alert_key": rows["alert_key"][:n], "block": rows["block"][:n], "second": at[:n],
        "next": np.append(at, 0)[after], "shown": after < size,
    })


def _walk(key, rows, entries):
    """The seconds sent in a block that is entered at a second."""
    import pandas as pd

    rows = rows.sort_values("second", ignore_index=True)
    at, following = _successors(rows)
    place, sent = (int((at < entries["second"].iloc[0]).sum()) if len(entries) else len(at)), []
    while place < len(at):
        sent.append(place)
        place = int(following[place])
    return rows.iloc[sent][["alert_key", "second", "wait"]]


def sent_seconds(alerts: DataFrame, last_sent: DataFrame | None = None) -> DataFrame:
    """The (`alert_key`, `second`) at which an alert goes out, with its `wait`.

    An alert goes out when more than its severity's wait has passed since the key's last one, so each
    decision depends on the one before. No task follows a key through all of its time, though. Alerts are
    reduced to one row per key and second, and a key's seconds are cut into blocks of a week. Each second
    has one successor, the second sent next if it is sent; a block's task finds them, and of each second
    where its chain leaves the block. What is left is a pointer from block to block, of which a key has
    as many as weeks: doubling them, in joins over all keys, marks the seconds at which each block is
    entered after as many rounds as their number has binary digits. The blocks are then walked, each from
    its entry, in tasks of their own.

    `alerts` has `alert_key`, `severity`, `ts`; `last_sent` (`alert_key`, `second`) continues an
    earlier run: it is where a key's chain starts, so alerts of the same second and late ones wait
    like any other.
    """
    workers_import(alerts.sparkSession)
    seconds = _timed(alerts).where(F.col("alert_key").isNotNull()).groupBy("alert_key", "second").agg(F.min("wait").alias("wait"))
    seconds = written(seconds.withColumn("block", F.floor(F.col("second") / BLOCK)), "alert-seconds")
    own = seconds.withColumn("home", F.col("block"))
    halo = own.where(F.col("second") - F.col("block") * BLOCK < HALO).withColumn("home", F.col("block") - 1)
    links = written(own.unionByName(halo).groupBy("alert_key", "home").applyInPandas(
        _links, "alert_key string, block bigint, second bigint, next bigint, shown boolean"
    ), "alert-links")

    # the first second of a key beyond a block's halo: all waits are over by then
    beyond = seconds.groupBy("alert_key", "block").agg(
        F.min("second").alias("first"), F.min(F.when(F.col("second") - F.col("block") * BLOCK >= HALO, F.col("second"))).alias("late")
    )
    later = Window.partitionBy("alert_key").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    nearest = Window.partitionBy("alert_key").orderBy("block")
    beyond = beyond.withColumn("beyond", F.when(
        F.lead("block").over(nearest) == F.col("block") + 1,
        F.coalesce(F.lead("late").over(nearest), F.lead("first", 2).over(nearest)),
    ).otherwise(F.min("first").over(later))).select("alert_key", "block", "beyond")
    pointers = links.join(beyond, ["alert_key", "block"]).select(
        "alert_key", "second", F.when(F.col("shown"), F.col("next")).otherwise(F.col("beyond")).alias("next")
    )

    starts = seconds
    if last_sent is not None:
        since = last_sent.groupBy("alert_key").agg(F.max("second").alias("since"))
        starts = seconds.join(since, "alert_key", "left").where(
            F.col("since").isNull() | (F.col("second") - F.col("since") > F.col("wait"))
        )
    reached = written(starts.groupBy("alert_key").agg(F.min("second").alias("second")), "alert-entries")
    # pointers of the seconds that a block can be entered at
    entries = pointers.where(F.col("next").isNotNull()).select("alert_key", F.col("next").alias("second")).unionByName(reached).distinct()
    jumps = written(pointers.join(entries, ["alert_key", "second"]).where(F.col("next").isNotNull()), "alert-jumps")
    blocks = beyond.groupBy("alert_key").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    for round_ in range(max(0, blocks - 1).bit_length()):
        further = reached.join(jumps, ["alert_key", "second"]).select("alert_key", F.col("next").alias("second"))
        ahead = jumps.select("alert_key", F.col("second").alias("next"), F.col("next").alias("after"))
        doubled = jumps.join(ahead, ["alert_key", "next"]).select("alert_key", "second", F.col("after").alias("next"))
        # both in one table, in which what is reached points nowhere
        marked = reached.unionByName(further).distinct().withColumn("next", F.lit(None).cast("bigint"))
        both = written(marked.unionByName(doubled), "alert-round")
        reached, jumps = both.where("next is null").drop("next"), both.where("next is not null")
    entered = reached.withColumn("block", F.floor(F.col("second") / BLOCK))
    return seconds.groupBy("alert_key", "block").cogroup(entered.groupBy("alert_key", "block")).applyInPandas(
        _walk, "alert_key string, second bigint, wait bigint"
    )


def throttle(alerts: DataFrame, last_sent: DataFrame | None = None) -> DataFrame:
    """Every alert with `decision` `sent` or `throttled`.

    Critical alerts always go out. Of the others the first of a sent second does (by wait, then
    `event_id`); the join is on key and second, which spreads a hot key.
    """
    timed = _timed(alerts)
    first = timed.groupBy("alert_key", "second", "wait").agg(F.min("event_id").alias("event_id"))
    marks = sent_seconds(alerts, last_sent).join(first, ["alert_key", "second", "wait"]).select(
        "alert_key", "second", "event_id", F.lit(True).alias("_sent")
    )
    sent = (F.col("wait") == ALWAYS) | F.coalesce(F.col("_sent"), F.lit(False))
    return timed.join(marks, ["alert_key", "second", "event_id"], "left").withColumn(
        "decision", F.when(sent, F.lit("sent")).otherwise(F.lit("throttled"))
    ).drop("_sent", "second", "wait")
