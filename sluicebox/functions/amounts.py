"""Money and label expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sluicebox import specs


def money(column: Column, precision: int = 10, scale: int = 2) -> Column:
    """Rounded half up to the stored decimal type; a value too big becomes NULL."""
    return F.round(column, scale).try_cast(f"decimal({precision},{scale})")


def mean(total_column: Column, count_column: Column, precision: int = 10, scale: int = 2) -> Column:
    """Average from an exact sum: one rounding, where avg(decimal) would round twice."""
    exact = total_column.cast("decimal(20,2)") / count_column.cast("decimal(19,0)")
    return F.round(exact, scale).cast(f"decimal({precision},{scale})")


def tier(spend: Column, tiers=specs.SPEND_TIERS, lowest: str = specs.LOWEST_TIER) -> Column:
    """First tier whose bound the spend exceeds."""
    label = None
    for name, bound in tiers:
        test = spend > F.lit(bound)
        label = F.when(test, F.lit(name)) if label is None else label.when(test, F.lit(name))
    return F.lit(lowest) if label is None else label.otherwise(F.lit(lowest))


def payment_category(method: Column, online=specs.ONLINE_PAYMENTS) -> Column:
    return F.when(method.isin(*online), F.lit("Online")).otherwise(F.lit("Offline"))


def is_weekend(day: Column) -> Column:
    """Saturday or Sunday (Spark numbers Sunday 1 and Saturday 7)."""
    return F.dayofweek(day).isin(1, 7)


def percent(part: Column, whole: Column, scale: int = 2) -> Column:
    """part / whole * 100 rounded; 0 when there is no whole."""
    share = F.try_divide(part.cast("decimal(19,0)") * F.lit(100), whole.cast("decimal(19,0)"))
    return F.coalesce(F.round(share, scale).cast(f"decimal(5,{scale})"), F.lit(0).cast(f"decimal(5,{scale})"))
