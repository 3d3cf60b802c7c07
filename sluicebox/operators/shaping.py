"""Small frame-shaping helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def report_rows(summary: DataFrame, rows: Sequence[dict[str, Column]]) -> DataFrame:
    """Turn a one-row summary into report rows, one per dict of output columns.

    The array holds one entry per rule, so its size is fixed by the spec, not by the data.
    """
    return summary.select(F.inline(F.array(*[
        F.struct(*[column.alias(name) for name, column in row.items()]) for row in rows
    ])))


def computed_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns that later filters and projections use as values.

    Spark copies the expression behind a column into every filter on it; for long expressions used
    many times that multiplies the work and outgrows generated code. Columns that come out of a
    one-element `inline` are computed once per row.
    """
    fields = F.struct(*[column.alias(name) for name, column in columns.items()])
    return df.select("*", F.inline(F.array(fields)))


def conform(df: DataFrame, schema) -> DataFrame:
    """Columns of `schema` in order and type; the frame's missing ones become NULL."""
    return df.select(*[
        (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema
    ])


def top(df: DataFrame, order: Sequence[Column], limit: int | None = None) -> DataFrame:
    """Sorted frame; with a limit Spark keeps the best rows per task and merges those."""
    ordered = df.orderBy(*order)
    return ordered if limit is None else ordered.limit(limit)
