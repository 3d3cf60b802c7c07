"""Row rules compiled to column expressions, so that validation stays in generated code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

Bounds = Mapping[str, tuple[float | None, float | None]]


def is_missing(name: str, schema: T.StructType, path: str = "") -> Column:
    """NULL, and NaN for floating columns; a column the frame lacks is always missing.

    `path` is put before the name for columns inside a struct.
    """
    if name not in schema.names:
        return F.lit(True)
    column = F.col(path + name)
    if isinstance(schema[name].dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def below(name: str, low: float | None, schema: T.StructType, path: str = "") -> Column:
    if low is None or name not in schema.names:
        return F.lit(False)
    return ~is_missing(name, schema, path) & (F.col(path + name) < F.lit(low))


def above(name: str, high: float | None, schema: T.StructType, path: str = "") -> Column:
    if high is None or name not in schema.names:
        return F.lit(False)
    return ~is_missing(name, schema, path) & (F.col(path + name) > F.lit(high))


def outside(
    name: str, limits: tuple[float | None, float | None], schema: T.StructType, path: str = ""
) -> Column:
    return below(name, limits[0], schema, path) | above(name, limits[1], schema, path)


# a rule is (condition that marks a bad row, tag)
Rule = tuple[Column, str | Column]


def null_rules(names: Iterable[str], schema: T.StructType) -> list[Rule]:
    return [(is_missing(n, schema), f"null:{n}") for n in names]


def range_rules(limits: Bounds, schema: T.StructType) -> list[Rule]:
    return [(outside(n, b, schema), f"range:{n}") for n, b in limits.items()]


def storage_rules(
    not_null: Iterable[str], limits: Bounds, schema: T.StructType, path: str = ""
) -> list[Rule]:
    """One `check:<column>` rule per column with a storage constraint."""
    not_null = list(not_null)
    rules = []
    for n in dict.fromkeys([*not_null, *limits]):
        broken = is_missing(n, schema, path) if n in not_null else None
        if n in limits:
            out = outside(n, limits[n], schema, path)
            broken = out if broken is None else broken | out
        rules.append((broken, f"check:{n}"))
    return rules


def violated(rules: list[Rule]) -> Column:
    return reduce(lambda a, b: a | b, [condition for condition, _ in rules], F.lit(False))


def tags(rules: list[Rule]) -> Column:
    """Tags of the violated rules, in rule order, joined by `;`."""
    return F.concat_ws(";", *[F.when(condition, tag if isinstance(tag, Column) else F.lit(tag)) for condition, tag in rules])


def first_tags(*families: list[Rule]) -> Column:
    """Tags of the first family a row violates, NULL for a clean row.

    The text is built for bad rows only, and a filter on it being NULL reduces to the plain
    conditions, which the optimizer can move to the scan.
    """
    out = None
    for rules in families:
        test, text = violated(rules), tags(rules)
        out = F.when(test, text) if out is None else out.when(test, text)
    return out
