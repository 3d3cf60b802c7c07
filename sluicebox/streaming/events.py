"""Incremental dedup, daily aggregates and alert throttling over event streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from sluicebox import specs
from sluicebox.operators import alerts
from sluicebox.session import workers_import
from sluicebox.sources.tables import TableStore

BATCH = "batch"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# 2 ** 12 registers: distinct counts are off by 1.6 % in the usual case
SKETCH_LG = 12


def parquet_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def first_per_key(stream: DataFrame, key: str, time: str, delay: str = "1 day") -> DataFrame:
    """One row per key within the delay. The first arrival is kept, where the keyed merge of the
    batch form keeps the last."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def daily(stream: DataFrame, time: str, value: str, who: str, delay: str = "1 day") -> DataFrame:
    """Counts, value totals and approximate distinct users per day, updated as rows arrive. Their users
    cannot be counted over several days; `keep_daily` keeps what can."""
    return (
        stream.withWatermark(time, delay)
        .groupBy(F.window(time, "1 day").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.sum(F.col(value).cast("decimal(18,2)")).alias("total_value"),
            F.approx_count_distinct(who).alias("approx_users"),
        )
        .select(F.to_date("day.start").alias("event_date"), "events", "total_value", "approx_users")
    )


def drain(
    stream: DataFrame, checkpoint: str, body: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    """Run a stream over what is there through `body` and wait for its end."""
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(body)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def store_batches(stream: DataFrame, store: TableStore, name: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Rows a stream emits, with their batch number as partition: a batch that is delivered again
    replaces its rows."""
    drain(stream, checkpoint, lambda batch, n: store.write_partitions(name, batch.withColumn(BATCH, F.lit(n)), [BATCH]), mode)
    return store.read(name)


# --- daily users --------------------------------------------------------------------------------

def keep_daily(stream: DataFrame, store: TableStore, name: str, checkpoint: str, time: str, value: str, who: str) -> None:
    """Keep of each batch one row a day (events, value total, and a sketch of its users) in the table
    `name`, and its distinct (day, user) pairs in `name`.users.

    Both are read together over any batches and days: sketches by union, which counts a user of
    several batches or days once, and the pairs for the exact number.
    """

    def body(batch: DataFrame, number: int) -> None:
        rows = batch.select(F.to_date(time).alias("event_date"), F.col(value).cast("decimal(18,2)").alias("value"), F.col(who).alias("who"))
        days = rows.groupBy("event_date").agg(
            F.count(F.lit(1)).alias("events"), F.sum("value").alias("total_value"), F.hll_sketch_agg("who", SKETCH_LG).alias("users"),
        )
        pairs = rows.where(F.col("who").isNotNull()).select("event_date", "who").distinct()
        store.write_partitions(name, days.withColumn(BATCH, F.lit(number)), [BATCH])
        store.write_partitions(f"{name}.users", pairs.withColumn(BATCH, F.lit(number)), [BATCH])

    drain(stream, checkpoint, body)


def kept_daily(store: TableStore, name: str, period: str = "day") -> DataFrame:
    """Events, value total, users by sketch (`approx_users`) and exact `users` of each day, or of each
    `month` or other period that `trunc` knows."""
    start = F.col("event_date") if period == "day" else F.trunc("event_date", period)
    totals = store.read(name).groupBy(start.alias("period")).agg(
        F.sum("events").alias("events"), F.sum("total_value").alias("total_value"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("approx_users"),
    )
    # a user of several batches or days is one row before the count
    users = store.read(f"{name}.users").select(start.alias("_period"), "who").distinct().groupBy("_period").agg(
        F.count(F.lit(1)).alias("users")
    )
    return totals.join(users, F.col("period").eqNullSafe(F.col("_period")), "left").select(
        "period", "events", "total_value", "approx_users", F.coalesce("users", F.lit(0)).alias("users")
    )


# --- alerts -------------------------------------------------------------------------------------

DECIDED = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("alert_key", T.StringType()),
    T.StructField("severity", T.StringType()), T.StructField("ts", T.TimestampType()), T.StructField("decision", T.StringType()),
])


class Throttle(StatefulProcessor):
    """Decides the alerts of a key; its state is the second of the key's last sent alert.

    A timer forgets a key once its longest wait has passed, because from then on the state decides
    nothing; so the state holds the keys of the last hours.
    """

    LONGEST = max(seconds or 0 for seconds in specs.THROTTLE_SECONDS.values())

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._last = handle.getValueState("last", T.StructType([T.StructField("second", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values(["second", "wait", "event_id"], kind="stable", ignore_index=True)
        known = self._last.get() if self._last.exists() else None
        before = last = None if known is None else known[0]
        decisions, seen = [], None
        for second, wait in zip(batch["second"].tolist(), batch["wait"].tolist()):
            # of a second only its first alert can be the one that was waited for
            sent = (last is None or second - last > wait) and second != seen
            if sent:
                last = second
            seen = second
            decisions.append("sent" if sent or wait == alerts.ALWAYS else "throttled")
        if last != before:
            self._last.update((last,))
            for timer in list(self._handle.listTimers()):
                self._handle.deleteTimer(timer)
            self._handle.registerTimer((last + self.LONGEST + 1) * 1000)
        yield batch[["event_id", "alert_key", "severity", "ts"]].assign(decision=decisions)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        self._last.clear()
        return iter(())

    def close(self) -> None:
        pass


def throttled(stream: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Every alert of a stream (`event_id, alert_key, severity, ts`) with its `decision`.

    Equal to `alerts.throttle` over all of them if batches arrive in the order of their times; alerts of
    one batch may come in any order, and one that is late waits like any other. `delay` says how late an
    alert may be before its key's state can be forgotten; alerts later than that are dropped by Spark.
    """
    spark = stream.sparkSession
    workers_import(spark)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay).select(
        "event_id", "alert_key", "severity", "ts", F.unix_seconds("ts").alias("second"), alerts.waiting_time().alias("wait")
    )
    return timed.groupBy("alert_key").transformWithStateInPandas(
        statefulProcessor=Throttle(), outputStructType=DECIDED, outputMode="Append", timeMode="EventTime"
    )
