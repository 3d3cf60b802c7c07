"""Reading a JSON payload with each field's JSON type.

The type is kept because an absent field, a null, a zero and the text "0" are treated differently.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def parsed(payload: Column) -> Column:
    """The payload as one variant, NULL for text that is not a JSON object."""
    return F.when(F.ltrim(payload).startswith("{"), F.try_parse_json(payload))


def fields(document: str, names: Sequence[str]) -> Column:
    """Struct with a variant per name out of a parsed payload: absent fields are NULL, JSON nulls are not."""
    return F.struct(*[F.try_variant_get(F.col(document), f"$.{n}", "variant").alias(n) for n in names])


def is_number(value: Column) -> Column:
    """A JSON number or boolean (true counts as 1), never a text."""
    kind = F.schema_of_variant(value)
    number = kind.isin("BIGINT", "DOUBLE", "FLOAT", "BOOLEAN") | kind.startswith("DECIMAL")
    return F.coalesce(number, F.lit(False))


def number(value: Column) -> Column:
    """Value of a number, boolean or numeric text; NULL otherwise."""
    flag = value.try_cast("int").cast("decimal(28,8)")
    return F.when(F.schema_of_variant(value) == "BOOLEAN", flag).otherwise(value.try_cast("decimal(28,8)"))


def is_empty(value: Column) -> Column:
    """Absent, null, "", zero, false or an empty list or object."""
    text = value.try_cast("string")
    hollow = (value.try_cast("double") == 0) | text.isin("{}", "[]")
    return text.isNull() | F.when(F.schema_of_variant(value) == "STRING", text == "").otherwise(
        F.coalesce(hollow, F.lit(False))
    )


def missing(json: str, names: Sequence[str]) -> Column:
    """Names of the empty fields, in order.

    Here and in `texts` one function runs over an array of fields: a copy of it per field would
    make a method too long for the JVM to compile.
    """
    listed = F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"{json}.{n}").alias("value")) for n in names])
    return F.transform(F.filter(listed, lambda f: is_empty(f["value"])), lambda f: f["name"])


def texts(json: str, names: Sequence[str]) -> Column:
    """The fields' texts as an array in the order of the names."""
    return F.transform(F.array(*[F.col(f"{json}.{n}") for n in names]), lambda v: v.try_cast("string"))
