"""Ad-hoc selection and SQL over Parquet."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession


def query_parquet(
    spark: SparkSession, path: str, select: Sequence[str] = ("*",), where: str | None = None,
    group_by: Sequence[str] = (),
) -> DataFrame:
    """Select expressions over Parquet with an optional filter and grouping; filter and column
    list reach the scan."""
    df = spark.read.parquet(path)
    if where:
        df = df.where(where)
    if not group_by:
        return df.selectExpr(*select)
    return run_sql(
        spark,
        f"SELECT {', '.join(select)} FROM {{source}} GROUP BY {', '.join(group_by)}",
        {"source": df},
    )


def run_sql(spark: SparkSession, text: str, frames: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """A SQL text; ``parquet.`path` `` names a file and `{name}` one of the given frames."""
    return spark.sql(text, **(frames or {}))
