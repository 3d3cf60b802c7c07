"""Data-quality checks over silver and quarantine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sluicebox import specs
from sluicebox.functions import amounts
from sluicebox.operators.shaping import report_rows


def quarantine_pattern(quarantine: DataFrame) -> DataFrame:
    """Totals and NULLs of the quarantine's key columns; a success when none is NULL."""
    counted = quarantine.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("id").isNull()).alias("null_ids"),
        F.count_if(F.col("payload").isNull()).alias("null_payloads"),
        F.count_if(F.col("error_reason").isNull()).alias("null_errors"),
    )
    clean = F.col("null_ids") + F.col("null_payloads") + F.col("null_errors") == 0
    return counted.withColumn("success", clean)


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count of each table and whether it holds any."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("populated"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def baseline_before(baselines: DataFrame, as_of: Column, hours: int = 24) -> DataFrame:
    """Per table the newest row-count baseline recorded more than `hours` before `as_of`."""
    old = baselines.where(
        (F.col("metric_name") == "row_count")
        & (F.col("recorded_at") < as_of - F.expr(f"INTERVAL {int(hours)} HOURS"))
    )
    return old.groupBy("table_name").agg(F.max_by("metric_value", "recorded_at").alias("baseline"))


def drift(
    counts: DataFrame, baselines: DataFrame, as_of: Column,
    threshold: float = specs.DRIFT_THRESHOLD_PCT,
) -> DataFrame:
    """Change of each table's row count (`table_name`, `row_count`) against its baseline.

    No baseline means no alert; an empty table is reported as not populated.
    """
    both = counts.select("table_name", "row_count").unionByName(
        baseline_before(baselines, as_of), allowMissingColumns=True
    )
    joined = both.groupBy("table_name").agg(
        F.max("row_count").alias("row_count"), F.max("baseline").alias("baseline")
    ).where(F.col("row_count").isNotNull())
    baseline = F.coalesce(F.col("baseline"), F.lit(0)).cast("double")
    current = F.col("row_count").cast("double")
    change = F.when(
        (baseline > 0) & (current > 0), F.abs(current - baseline) / baseline * F.lit(100.0)
    ).otherwise(F.lit(0.0))
    drifted = F.col("change") > F.lit(float(threshold))
    return joined.withColumn("change", change).select(
        "table_name",
        F.col("row_count").alias("current_count"),
        F.when(current > 0, baseline).otherwise(F.lit(0.0)).cast("bigint").alias("baseline_count"),
        F.round("change", 2).alias("change_pct"),
        drifted.alias("drift_detected"),
        F.when(F.col("row_count") == 0, F.lit("not_populated"))
        .when(drifted, F.lit("drift_alert")).otherwise(F.lit("normal")).alias("status"),
    )


def new_baselines(counts: DataFrame, as_of: Column) -> DataFrame:
    """The rows that make today's counts a later run's baseline."""
    return counts.where("row_count > 0").select(
        "table_name", F.lit("row_count").alias("metric_name"),
        F.col("row_count").cast("decimal(15,2)").alias("metric_value"),
        as_of.alias("recorded_at"),
    )


def completeness(
    tables: Mapping[str, DataFrame], critical: Mapping[str, Sequence[str]] = specs.CRITICAL_COLUMNS,
    threshold: float = specs.COMPLETENESS_THRESHOLD_PCT,
) -> DataFrame:
    """Non-NULL share of every critical column, all columns of a table in one pass."""
    out = None
    for name, columns in critical.items():
        counted = tables[name].agg(
            F.count(F.lit(1)).alias("_total"), *[F.count(c).alias(c) for c in columns]
        )
        rows = report_rows(counted, [
            {
                "table_name": F.lit(name), "column_name": F.lit(c), "total": F.col("_total"),
                "non_null": F.col(c), "completeness_pct": amounts.percent(F.col(c), F.col("_total")),
            }
            for c in columns
        ])
        out = rows if out is None else out.unionByName(rows)
    return out.withColumn(
        "passes_threshold", F.col("completeness_pct").cast("double") >= F.lit(float(threshold))
    )


def freshness(
    sales: DataFrame, as_of: Column, sla_hours: float = specs.FRESHNESS_SLA_HOURS
) -> DataFrame:
    """Hours since the newest processed row; a table without one is stale."""
    newest = sales.agg(
        F.max("sale_date").alias("latest_sale_date"), F.max("processed_at").alias("latest_processed"),
    )
    elapsed = F.timestamp_diff("MICROSECOND", F.col("latest_processed"), as_of)
    hours = elapsed.cast("double") / F.lit(3600000000.0)
    fresh = F.coalesce(hours <= F.lit(float(sla_hours)), F.lit(False))
    return newest.select(
        "latest_sale_date", "latest_processed",
        F.round(hours, 2).alias("hours_since_update"),
        fresh.alias("is_fresh"),
        F.when(fresh, F.lit("ok")).otherwise(F.lit("stale_data_alert")).alias("status"),
    )


def orphans(sales: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct sales keys that the dimension lacks.

    Keys are made distinct before the join, so a hot key crosses the network once per task and
    the join sees each key once.
    """
    used = sales.where(F.col(key).isNotNull()).select(key).distinct()
    missing = used.join(dimension.select(key), key, "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("orphan_count"))


def status_counts(quarantine: DataFrame) -> DataFrame:
    """Quarantine totals by remediation status."""
    states = ("pending", "remediated", "rejected", "dead_letter")
    return quarantine.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("remediation_status") == s).alias(s) for s in states],
    )


def checks(
    quarantine: DataFrame, profiled: DataFrame, drifted: DataFrame, complete: DataFrame,
    fresh: DataFrame, orphan_counts: Mapping[str, DataFrame],
) -> DataFrame:
    """Every check as `check`, `failed`: the six families an alert looks at."""
    parts = [
        status_counts(quarantine).select(F.lit("quarantine").alias("check"), (F.col("pending") > 0).alias("failed")),
        profiled.agg(F.bool_or(F.col("row_count").isNull()).alias("failed")).select(F.lit("profiling").alias("check"), "failed"),
        drifted.agg(F.bool_or("drift_detected").alias("failed")).select(F.lit("drift").alias("check"), "failed"),
        complete.agg(F.bool_or(~F.col("passes_threshold")).alias("failed")).select(F.lit("completeness").alias("check"), "failed"),
        fresh.select(F.lit("freshness").alias("check"), (~F.col("is_fresh")).alias("failed")),
    ]
    for counted in orphan_counts.values():
        parts.append(counted.select(F.lit("integrity").alias("check"), (F.col("orphan_count") > 0).alias("failed")))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy("check").agg(F.bool_or(F.coalesce(F.col("failed"), F.lit(False))).alias("failed"))


def summary(check_rows: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row: a flag per check family, whether any failed, and the quarantine's counts."""
    flags = ("quarantine", "profiling", "drift", "completeness", "freshness", "integrity")
    counted = status_counts(quarantine)
    both = check_rows.unionByName(
        counted.withColumns({"check": F.lit(None).cast("string"), "failed": F.lit(False)}),
        allowMissingColumns=True,
    )
    return both.agg(
        *[F.bool_or((F.col("check") == f) & F.col("failed")).alias(f"{f}_issues") for f in flags],
        F.bool_or("failed").alias("has_issues"),
        *[F.max(c).alias(c) for c in counted.columns],
    )


def report(
    quarantine: DataFrame, profiled: DataFrame, drifted: DataFrame, complete: DataFrame,
    fresh: DataFrame, orphan_counts: Mapping[str, DataFrame],
) -> DataFrame:
    """The quality report as rows: `section`, `metric`, `value`, `status`."""
    verdict = lambda ok, good, bad: F.when(ok, F.lit(good)).otherwise(F.lit(bad))
    pattern = quarantine_pattern(quarantine)
    parts = [
        report_rows(pattern, [
            {"section": F.lit("quarantine"), "metric": F.lit(m), "value": F.col(m).cast("string"),
             "status": verdict(F.col("success"), "ok", "failed")}
            for m in ("total_rows", "null_ids", "null_payloads", "null_errors")
        ]),
        profiled.select(
            F.lit("profiling").alias("section"), F.col("table_name").alias("metric"),
            F.col("row_count").cast("string").alias("value"),
            verdict(F.col("populated"), "populated", "empty").alias("status"),
        ),
        drifted.select(
            F.lit("drift").alias("section"), F.col("table_name").alias("metric"),
            F.concat_ws(" -> ", F.col("baseline_count").cast("string"), F.col("current_count").cast("string")).alias("value"),
            F.col("status"),
        ),
        complete.select(
            F.lit("completeness").alias("section"),
            F.concat_ws(".", "table_name", "column_name").alias("metric"),
            F.concat_ws("/", F.col("non_null").cast("string"), F.col("total").cast("string")).alias("value"),
            verdict(F.col("passes_threshold"), "pass", "fail").alias("status"),
        ),
        fresh.select(
            F.lit("freshness").alias("section"), F.lit("latest_sale_date").alias("metric"),
            F.col("latest_sale_date").cast("string").alias("value"), F.col("status"),
        ),
    ]
    for name, counted in orphan_counts.items():
        parts.append(counted.select(
            F.lit("integrity").alias("section"), F.lit(f"orphan {name}").alias("metric"),
            F.col("orphan_count").cast("string").alias("value"),
            verdict(F.col("orphan_count") == 0, "valid", "invalid").alias("status"),
        ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
