"""Bronze files to silver and quarantine."""

from __future__ import annotations

import time
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from sluicebox import schemas, specs
from sluicebox.operators import files, quarantine, silver, validation
from sluicebox.operators.shaping import conform
from sluicebox.operators.upsert import latest_per_key
from sluicebox.plans.layers import AUDIT, CHANGES, GROUPS, LEDGER, QUARANTINE, SEVERITY, Layers
from sluicebox.session import setting, swept
from sluicebox.sources import bronze

# What a merge overwrites in a sale silver already holds. `source_file` and
# `processed_at` are set from the run as well.
FILES_PER_TASK = 50
LISTING_TASKS = 200
UPDATES = [c for c in schemas.SILVER_SALES.names if c != "transaction_id"]


def gate(footers: DataFrame) -> DataFrame:
    """Per file: state, message, row count and type signature, from its footer alone, in one
    aggregation, so that each footer is read once."""
    rows = validation.schema_drift(footers, specs.SALES, F.max("row_count").alias("row_count"), bronze.signature())
    unreadable = F.when(F.col("row_count").isNull(), F.lit("Unreadable file")).when(
        F.col("row_count") == 0, F.lit("No data found")
    )
    wrong_types = F.size("type_mismatches") > 0
    drift = F.col("row_count").isNotNull() & F.coalesce(F.col("has_drift") | wrong_types, F.lit(False))
    details = F.concat_ws(" ", F.nullif(F.col("drift_details"), F.lit("")), F.when(
        wrong_types, F.concat(F.lit("Unusable types: "), F.array_join("type_mismatches", ", "), F.lit("."))
    ))
    return rows.select(
        "file_path", F.coalesce("row_count", F.lit(0)).alias("row_count"), "signature",
        files.outcome(drift, F.coalesce("row_count", F.lit(0)), unreadable).alias("status"),
        F.coalesce(unreadable, F.when(drift, F.concat(F.lit("Schema drift: "), details))).alias("error_message"),
    )


def ledger_rows(outcomes: DataFrame, run_id: str, now: datetime) -> DataFrame:
    at = F.lit(now).cast("timestamp_ntz")
    return conform(outcomes.withColumns({
        "dataset_name": F.lit(specs.SALES.name),
        "ingest_date": F.lit(now.date()), "run_id": F.lit(run_id),
        "processed_at": at, "created_at": at,
    }), schemas.LEDGER)


def ingest_files(
    spark: SparkSession, layers: Layers, listed: DataFrame, run_id: str, now: datetime
) -> DataFrame:
    """Process one bounded list of files; returns its audit row.

    The footers decide which files are read at all. The rows of the accepted ones are scanned
    once: they are written as a staging table split into good and bad, which the later steps read.
    Rerunning after a failure repeats nothing that shows: silver is merged by key, records the
    quarantine knows are not added again, and a file counts as done only in the ledger, which is
    written last.
    """
    store, at = layers.store, F.lit(now).cast("timestamp_ntz")
    staging = f"staging.{run_id}"
    paths = listed.select("file_path")
    # paths are tiny: left to their size, all footers would be read one after another in one task
    tasks = -(-paths.count() // FILES_PER_TASK) or 1
    gated = store.write(f"{staging}.files", gate(bronze.footers(paths.repartition(tasks, "file_path"))))

    # file names of one list, whose length the caller bounds
    groups: dict[str, list[str]] = {}
    for row in gated.where("status = 'PROCESSED'").select("file_path", "signature").toLocalIterator():
        groups.setdefault(row["signature"], []).append(row["file_path"])

    counts = None
    rows = bronze.read_files(spark, groups, specs.SALES)
    if rows is not None:
        tagged = validation.tag_all(rows, specs.SALES)
        staged = store.write(
            f"{staging}.rows",
            tagged.drop("cast_errors").withColumn("outcome", F.when(F.col("error_reason").isNull(), F.lit("good")).otherwise(F.lit("bad"))),
            partition_by=["outcome"],
        )
        good = staged.where("outcome = 'good'").drop("error_reason", "outcome", "record_id")
        bad = staged.where("outcome = 'bad'")

        failed = quarantine.quarantine_rows(
            bad, specs.SALES.columns.names, F.col("record_id"), F.lit(run_id), at
        )
        known = layers.read(QUARANTINE).select("source_file", "id")
        layers.append(QUARANTINE, failed.join(known, ["source_file", "id"], "left_anti"))
        shaped = silver.shape_silver(good, F.lit(now.date()), at)
        layers.sales.merge(shaped, UPDATES, "arrival", GROUPS, CHANGES)
        marks = bronze.fingerprint(staged, specs.SALES.columns.names).select("source_file", "checksum")
        counts = files.file_counts(staged, F.col("outcome") == "bad").join(marks, "source_file")

    outcomes = gated.withColumnRenamed("row_count", "rows_read")
    if counts is None:
        none = F.lit(0).cast("bigint")
        outcomes = outcomes.withColumns({"good_rows": none, "bad_rows": none, "checksum": F.lit(None).cast("string")})
    else:
        outcomes = outcomes.join(
            counts.select(F.col("source_file").alias("file_path"), "good_rows", "bad_rows", "checksum"), "file_path", "left"
        ).fillna(0, ["good_rows", "bad_rows"])
    outcomes = store.write(f"{staging}.outcomes", outcomes.withColumns({
        "record_count": F.col("good_rows"),
    }))
    layers.replace(LEDGER, files.ledger_upsert(layers.read(LEDGER), ledger_rows(outcomes, run_id, now)))
    # the files are closed: nothing reads their staged rows again
    store.delete(store.location(f"{staging}.rows"))
    return files.audit_run(outcomes.withColumns({
        "source_file": F.col("file_path"), "ingestion_run_id": F.lit(run_id),
    }))


def record_audit(layers: Layers, audit: DataFrame, started: datetime, finished: datetime | None) -> None:
    layers.append(AUDIT, audit.withColumns({
        "started_at": F.lit(started).cast("timestamp_ntz"),
        "finished_at": F.lit(finished).cast("timestamp_ntz"),
        "operator": F.lit("ingest"),
    }))


def record_start(layers: Layers, run_id: str, started: datetime) -> None:
    """A RUNNING row, which the run's final row follows; a run that dies leaves it as its last."""
    none = F.lit(0).cast("bigint")
    row = layers.store.spark.range(1).select(
        F.lit(run_id).alias("ingestion_run_id"), F.lit("RUNNING").alias("status"),
        F.expr("cast(array() as array<string>)").alias("files_scanned"),
        *[none.alias(c) for c in ("rows_read", "rows_written_silver", "rows_quarantined", "drifted_files", "failed_files")],
    )
    record_audit(layers, row, started, None)


def latest_audit(audit: DataFrame) -> DataFrame:
    """One row a run: its final row, or RUNNING."""
    return latest_per_key(audit, ["ingestion_run_id"], [F.col("finished_at").desc_nulls_last()])


def run_wave(spark: SparkSession, layers: Layers, listed: DataFrame, run_id: str, now: datetime) -> None:
    """Process one list of files between its two audit rows. `now` is the time of the run, to which
    the time that the work took is added. How grave its findings are is kept beside the audit."""
    began = time.monotonic()
    record_start(layers, run_id, now)
    with swept(spark):
        audit = layers.store.write(f"staging.{run_id}.audit", ingest_files(spark, layers, listed, run_id, now))
    finished = now + timedelta(seconds=time.monotonic() - began)
    record_audit(layers, audit, now, finished)
    layers.append(SEVERITY, files.run_severity(audit).withColumn("finished_at", F.lit(finished).cast("timestamp_ntz")))


def ingest(
    spark: SparkSession, layers: Layers, bronze_root: str, run_id: str, now: datetime,
    files_per_wave: int = 100_000,
) -> int:
    """Ingest every pending file below the root, a wave of files at a time; returns the waves run.

    The root is listed once. A wave bounds what the driver holds of it (file names); a backfill of
    100 TB in 128 MB files takes eight. No file is left out: the loop ends when nothing is pending.
    """
    listed = bronze.list_files(spark, bronze_root, prefix=f"{specs.SALES.name}/")
    pending = files.pending_files(listed, layers.read(LEDGER), specs.SALES.name).select("file_path")
    # the listing's rows are as many as files, but Spark deals its tasks by their bytes, which nobody reads
    with setting(spark, "spark.sql.files.maxPartitionNum", str(LISTING_TASKS)):
        pending = layers.store.write(f"staging.{run_id}.pending", pending)
    waves, last = 0, ""
    while True:
        wave = pending.where(F.col("file_path") > last).orderBy("file_path").limit(files_per_wave)
        name = f"{run_id}-{waves:04d}"
        wave = layers.store.write(f"staging.{name}.listed", wave)
        with swept(spark):
            last = wave.agg(F.max("file_path")).first()[0]
        if last is None:
            return waves
        run_wave(spark, layers, wave, name, now)
        waves += 1
