"""Quarantine rows and their JSON payload."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluicebox.operators.shaping import computed_once


def payload_json(df: DataFrame, columns: Sequence[str]) -> Column:
    """The named columns as JSON: NULLs kept, values JSON cannot hold (NaN, infinities) NULL."""
    fields = []
    for name in columns:
        column = F.col(name)
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            finite = ~F.isnan(column) & (F.abs(column) != F.lit(float("inf")))
            column = F.when(finite, column)
        fields.append(column.alias(name))
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd"})


def quarantine_rows(
    bad: DataFrame, columns: Sequence[str], record_id: Column, run_id: Column, failed_at: Column,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Bad rows as pending quarantine records, keyed by source file and record number; columns
    named in `keep` are carried along."""
    rows = computed_once(bad, {"_payload": payload_json(bad, columns)})
    return rows.select(
        record_id.cast("bigint").alias("id"),
        F.col("_payload").alias("payload"),
        F.coalesce(F.col("error_reason"), F.lit("unknown")).alias("error_reason"),
        failed_at.alias("failed_at"),
        run_id.alias("ingestion_run_id"),
        F.coalesce(F.col("source_file"), F.lit("")).alias("source_file"),
        F.lit(None).cast("string").alias("corrected_by"),
        F.lit(None).cast("timestamp_ntz").alias("corrected_at"),
        F.lit(False).alias("replayed"),
        F.lit(None).cast("timestamp_ntz").alias("replayed_at"),
        F.lit("pending").alias("remediation_status"),
        F.lit(0).alias("retry_count"),
        *keep,
    )
