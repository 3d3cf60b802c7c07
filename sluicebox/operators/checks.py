"""Single-column quality checks over any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def null_check(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull()).agg(F.count(F.lit(1)).alias("null_count"))


def unique_check(df: DataFrame, column: str, limit: int = 10) -> DataFrame:
    """The most repeated values of a column (the report shows ten)."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt")).where("cnt > 1")
        .orderBy(F.desc("cnt"), F.asc(column)).limit(limit)
    )


def value_range_check(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    outside = (F.col(column) < F.lit(low)) | (F.col(column) > F.lit(high))
    return df.where(outside).agg(F.count(F.lit(1)).alias("out_of_range"))


def recent_source_files(ledger: DataFrame, limit: int = 10) -> DataFrame:
    """Files processed last, newest first."""
    return (
        ledger.where(F.col("status") == "PROCESSED")
        .groupBy("file_path", "ingest_date").agg(F.max("processed_at").alias("processed_at"))
        .orderBy(F.desc("processed_at"), F.asc("file_path")).limit(limit)
    )


def failing(column: str, check: str) -> Column:
    """Rows a check type objects to: `not_null`, `value_range` (negative) or any row."""
    if check == "not_null":
        return F.col(column).isNull()
    if check == "value_range":
        return F.col(column) < 0
    return F.lit(True)


def bad_record_sources(df: DataFrame, column: str, check: str, limit: int = 3) -> DataFrame:
    """Ingest dates that brought most of a column's bad rows."""
    return (
        df.where(failing(column, check)).groupBy("ingest_date")
        .agg(F.count(F.lit(1)).alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc("ingest_date")).limit(limit)
    )


def failure_sources(df: DataFrame, table: str, rules: dict[str, str], limit: int = 3) -> DataFrame:
    """Per failed column, its worst ingest dates as text: `date (n bad), ...`.

    One pass counts all columns per ingest date; the ranking then works on those counts.
    """
    per_date = df.groupBy("ingest_date").agg(
        *[F.count_if(failing(c, check)).alias(c) for c, check in rules.items()]
    )
    counts = per_date.unpivot("ingest_date", list(rules), "column_name", "bad").where("bad > 0")
    text = F.concat(F.coalesce(F.col("ingest_date").cast("string"), F.lit("?")),
                    F.lit(" ("), F.col("bad").cast("string"), F.lit(" bad)"))
    ranked = counts.withColumn("rank", F.expr(
        "row_number() over (partition by column_name order by bad desc, ingest_date asc)"
    )).where(F.col("rank") <= limit)
    return ranked.groupBy("column_name").agg(
        F.array_sort(F.collect_list(F.struct("rank", text.alias("text")))).alias("worst"),
    ).select(
        F.concat(F.lit(f"{table}."), F.col("column_name")).alias("source_key"),
        F.array_join(F.transform("worst", lambda w: w["text"]), ", ").alias("sources"),
    )
