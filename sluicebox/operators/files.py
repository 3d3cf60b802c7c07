"""File ledger, file outcomes, audit rows and the severity of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sluicebox import specs
from sluicebox.functions import amounts
from sluicebox.operators.upsert import merge_upsert


def pending_files(files: DataFrame, ledger: DataFrame, dataset: str) -> DataFrame:
    """The dataset's files that have not reached a final state.

    Spark broadcasts the ledger's paths only while they are small, else it shuffles on the path.
    """
    done = ledger.where(
        (F.col("dataset_name") == dataset) & F.col("status").isin(*specs.TERMINAL_FILE_STATES)
    ).select("file_path")
    mine = files.where(F.col("file_path").contains(f"{dataset}/"))
    return mine.join(done, "file_path", "left_anti")


def ledger_upsert(ledger: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Record file outcomes: a known file keeps its checksum, dataset and creation time."""
    return merge_upsert(
        ledger, outcomes, ["file_path"],
        update=["status", "record_count", "processed_at", "error_message"],
    )


def file_counts(rows: DataFrame, bad: Column, *by: str) -> DataFrame:
    """Rows read, good and bad per source file, combined before the shuffle."""
    return rows.groupBy("source_file", *by).agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~bad).alias("good_rows"),
        F.count_if(bad).alias("bad_rows"),
    )


def outcome(has_drift: Column, rows: Column, failure: Column | None = None) -> Column:
    """A file's state: failed (error or empty), drifted, or processed."""
    state = F.when(rows == 0, F.lit("FAILED"))
    if failure is not None:
        state = F.when(failure.isNotNull(), F.lit("FAILED")).when(rows == 0, F.lit("FAILED"))
    return state.when(has_drift, F.lit("SCHEMA_DRIFT")).otherwise(F.lit("PROCESSED"))


def audit_run(counts: DataFrame, by: str = "ingestion_run_id") -> DataFrame:
    """One audit row per run from its per-file counts (`rows_read`, `good_rows`, `bad_rows`,
    `status`). The file list is metadata of one run, never row data."""
    failed = F.count_if(F.col("status") != "PROCESSED") > 0
    return counts.groupBy(by).agg(
        F.array_sort(F.collect_set("source_file")).alias("files_scanned"),
        F.sum("rows_read").alias("rows_read"),
        F.sum("good_rows").alias("rows_written_silver"),
        F.sum("bad_rows").alias("rows_quarantined"),
        F.when(failed, F.lit("COMPLETED_WITH_ERRORS")).otherwise(F.lit("COMPLETED")).alias("status"),
        F.count_if(F.col("status") == "SCHEMA_DRIFT").alias("drifted_files"),
        F.count_if(F.col("status") == "FAILED").alias("failed_files"),
    )


def run_severity(runs: DataFrame) -> DataFrame:
    """Status text, alert severity and quarantine rate of each run, gravest finding first."""
    rate = F.when(
        F.col("rows_read") > 0,
        F.col("rows_quarantined") / F.col("rows_read") * F.lit(100.0),
    ).otherwise(F.lit(0.0))
    idle = (F.col("rows_read") == 0) & (F.size("files_scanned") == 0)
    errors = (F.col("drifted_files") + F.col("failed_files")) > 0
    levels = [
        (F.col("drifted_files") > 0, "SCHEMA DRIFT", "critical"),
        (idle, "NO DATA", "info"),
        (errors, "COMPLETED WITH ERRORS", "warning"),
        (F.col("quarantine_rate") > specs.HIGH_QUARANTINE_PCT, "HIGH QUARANTINE", "warning"),
        (F.col("rows_quarantined") > 0, "PARTIAL SUCCESS", "warning"),
    ]
    status = severity = None
    for test, text, level in levels:
        status = F.when(test, F.lit(text)) if status is None else status.when(test, F.lit(text))
        severity = F.when(test, F.lit(level)) if severity is None else severity.when(test, F.lit(level))
    return runs.withColumn("quarantine_rate", rate).withColumns({
        "status_text": status.otherwise(F.lit("SUCCESS")),
        "severity": severity.otherwise(F.lit("info")),
    })


def max_value(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias("max_value"), F.count(F.lit(1)).alias("row_count"))


def quality_score(silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Share of processed records that reached silver, in percent."""
    counted = records(silver, quarantine).groupBy().pivot("origin", ["silver", "quarantine"]).sum("total")
    return counted.select(amounts.percent(
        F.col("silver"), F.col("silver") + F.col("quarantine")
    ).alias("quality_score"))


def records(silver: DataFrame, quarantine: DataFrame) -> DataFrame:
    """Two counted rows, silver and quarantine."""
    return silver.agg(F.lit("silver").alias("origin"), F.count(F.lit(1)).alias("total")).unionByName(
        quarantine.agg(F.lit("quarantine").alias("origin"), F.count(F.lit(1)).alias("total"))
    )
