"""File gate, row tagging and validation reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from sluicebox.functions import rules
from sluicebox.operators.shaping import report_rows
from sluicebox.specs import DatasetSpec

# Parquet types that may be cast to each stored type. A file whose column has
# another type is held back as a whole.
TYPE_FAMILIES = {
    "string": ("string", "large_string"),
    "date": ("date32", "date64", "timestamp"),
    "int": ("int8", "int16", "int32", "int64", "uint8", "uint16", "uint32", "uint64", "bool", "float", "double"),
    "decimal": ("int8", "int16", "int32", "int64", "uint8", "uint16", "uint32", "uint64", "float", "double", "decimal128"),
}


def type_family(data_type: T.DataType) -> str:
    if isinstance(data_type, T.DecimalType):
        return "decimal"
    if isinstance(data_type, (T.IntegerType, T.LongType, T.ShortType, T.BooleanType)):
        return "int"
    return data_type.simpleString()


def schema_drift(footers: DataFrame, spec: DatasetSpec, *more: Column) -> DataFrame:
    """Per file: missing and extra columns and columns of an unusable type; `more` aggregates of its
    footer rows come along.

    `footers` has one row per file and column (`file_path`, `column_name`, `column_type`), so a
    group holds no more than one file's columns.
    """
    expected = F.array(*[F.lit(c) for c in spec.file_columns])
    wrong_type = None
    for name in spec.file_columns:
        allowed = TYPE_FAMILIES.get(type_family(spec.columns[name].dataType), ())
        # an all-NULL column carries no type to object to
        test = (F.col("column_name") == name) & ~F.col("column_type").isin(*allowed, "null")
        wrong_type = test if wrong_type is None else wrong_type | test
    per_file = footers.groupBy("file_path").agg(
        F.collect_set("column_name").alias("found"),
        F.collect_set(F.when(wrong_type, F.col("column_name"))).alias("found_types"),
        *more,
    )
    actual = F.filter("found", lambda c: ~c.isin(*spec.path_columns))
    missing = F.array_sort(F.array_except(expected, actual))
    extra = F.array_sort(F.array_except(actual, expected))
    named = per_file.select(
        "file_path",
        missing.alias("missing_columns"),
        extra.alias("extra_columns"),
        F.array_sort("found_types").alias("type_mismatches"),
        *[c for c in per_file.columns if c not in ("file_path", "found", "found_types")],
    )
    return named.withColumns({
        "has_drift": (F.size("missing_columns") > 0) | (F.size("extra_columns") > 0),
        "drift_details": F.concat_ws(
            " ",
            _listing("Missing columns", "missing_columns"),
            _listing("Extra columns", "extra_columns"),
        ),
    })


def _listing(title: str, column: str) -> Column:
    return F.when(
        F.size(column) > 0, F.concat(F.lit(f"{title}: "), F.array_join(column, ", "), F.lit("."))
    )


def type_errors(schema: T.StructType, expected: Mapping[str, str]) -> list[str]:
    """Schema-only type check: a message per column that is absent or of another kind."""
    kinds = {
        "integer": (T.ByteType, T.ShortType, T.IntegerType, T.LongType),
        "float": (T.FloatType, T.DoubleType, T.DecimalType),
        "string": (T.StringType,),
        "boolean": (T.BooleanType,),
        "date": (T.DateType, T.TimestampType, T.TimestampNTZType),
        "datetime": (T.DateType, T.TimestampType, T.TimestampNTZType),
    }
    errors = []
    for name, kind in expected.items():
        if name not in schema.names:
            errors.append(f"Column '{name}' not found")
        elif not isinstance(schema[name].dataType, kinds[kind]):
            found = schema[name].dataType.simpleString()
            errors.append(f"Column '{name}': expected {kind}, got {found}")
    return errors


# how files store each kind of column
STORED_KINDS = {
    "integer": "int8 int16 int32 int64 uint8 uint16 uint32 uint64",
    "float": "float double halffloat decimal128",
    "string": "string large_string",
    "boolean": "bool",
    "date": "date32 date64 timestamp",
    "datetime": "date32 date64 timestamp",
}


def stored_type_errors(footers: DataFrame, expected: Mapping[str, str]) -> DataFrame:
    """`type_errors` of every file, from its footer rows: `file_path, column_name, message` for each
    expected column that the file lacks or stores as another kind."""
    stored = {c: F.max(F.when(F.col("column_name") == c, F.split(F.col("column_type"), "\\[")[0])) for c in expected}
    per_file = footers.groupBy("file_path").agg(*[kind.alias(f"_{i}") for i, kind in enumerate(stored.values())])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.when(F.col(f"_{i}").isNull(), F.lit(f"Column '{c}' not found")).when(
            ~F.col(f"_{i}").isin(*STORED_KINDS[kind].split()), F.concat(F.lit(f"Column '{c}': expected {kind}, got "), F.col(f"_{i}"))
        ).alias("message"))
        for i, (c, kind) in enumerate(expected.items())
    ]
    return per_file.select("file_path", F.inline(F.array(*rows))).where(F.col("message").isNotNull())


def required_nulls(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """NULL (or NaN) count of every required column, in one pass."""
    summary = df.agg(*[F.count_if(rules.is_missing(c, df.schema)).alias(c) for c in required])
    return report_rows(summary, [
        {"column_name": F.lit(c), "null_count": F.col(c)} for c in required
    ])


def value_ranges(df: DataFrame, ranges: rules.Bounds) -> DataFrame:
    """Rows below and above each bound; NULLs pass."""
    counts = []
    for name, (low, high) in ranges.items():
        counts.append(F.count_if(rules.below(name, low, df.schema)).alias(f"{name}.below"))
        counts.append(F.count_if(rules.above(name, high, df.schema)).alias(f"{name}.above"))
    return report_rows(df.agg(*counts), [
        {
            "column_name": F.lit(name),
            "below_min": F.col(f"`{name}.below`"),
            "above_max": F.col(f"`{name}.above`"),
        }
        for name in ranges
    ])


def uniqueness(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows that share their key with another row (all of them), and the keys concerned.

    Counting per key combines before the shuffle, so a hot key costs one row per task.
    """
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("duplicate_rows"),
        F.count(F.lit(1)).alias("duplicate_keys"),
    )


def full_validation(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Every rule of the spec as a report row: `check`, `column_name`, `failed_count`, `passed`."""
    schema = df.schema
    missing = [c for c in spec.columns.names if c not in schema.names]
    extra = [c for c in schema.names if c not in spec.columns.names]
    measures = {("row_count", "*"): F.count(F.lit(1))}
    measures[("missing_columns", ", ".join(sorted(missing)))] = F.max(F.lit(len(missing))).cast("bigint")
    measures[("extra_columns", ", ".join(sorted(extra)))] = F.max(F.lit(len(extra))).cast("bigint")
    for c in spec.required:
        measures[("not_null", c)] = F.count_if(rules.is_missing(c, schema))
    for c, (low, high) in spec.ranges.items():
        measures[("range_min", c)] = F.count_if(rules.below(c, low, schema))
        measures[("range_max", c)] = F.count_if(rules.above(c, high, schema))
    summary = df.agg(*[m.alias(f"m{i}") for i, m in enumerate(measures.values())])
    # extra columns are a warning and the row count is information: both always pass
    report = report_rows(summary, [
        {
            "check": F.lit(check),
            "column_name": F.lit(column),
            "failed_count": F.coalesce(F.col(f"m{i}"), F.lit(0)),
            "passed": F.lit(True) if check in ("row_count", "extra_columns")
            else F.coalesce(F.col(f"m{i}"), F.lit(0)) == 0,
        }
        for i, (check, column) in enumerate(measures)
    ])
    if spec.unique:
        keys = list(spec.unique)
        report = report.unionByName(uniqueness(df, keys).select(
            F.lit("unique").alias("check"),
            F.lit(", ".join(keys)).alias("column_name"),
            F.col("duplicate_rows").alias("failed_count"),
            (F.col("duplicate_rows") == 0).alias("passed"),
        ))
    return report


def row_rules(schema: T.StructType, spec: DatasetSpec) -> list[rules.Rule]:
    """NULLs in required columns, then values out of range."""
    return [*rules.null_rules(spec.required, schema), *rules.range_rules(spec.ranges, schema)]


def constraint_rules(schema: T.StructType, spec: DatasetSpec) -> list[rules.Rule]:
    """What silver could not store."""
    return rules.storage_rules(spec.not_null, spec.bounds, schema)


def tag_rows(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Adds `error_reason`: the row's `null:` and `range:` tags, NULL when it is clean."""
    return df.withColumn("error_reason", rules.first_tags(row_rules(df.schema, spec)))


def all_rules(schema: T.StructType, spec: DatasetSpec) -> list[list[rules.Rule]]:
    """Rule families in the order they decide a row's tags: casts that failed when the row was
    read, row rules, storage constraints."""
    families = [row_rules(schema, spec), constraint_rules(schema, spec)]
    if "cast_errors" not in schema.names:
        return families
    # one test and one text for all columns: two for each outgrow a compiled method
    names = F.array(*[F.lit(n) for n in spec.columns.names])
    failed = F.array_join(F.array_intersect(names, F.col("cast_errors")), ";check:")
    return [[(F.arrays_overlap(F.col("cast_errors"), names), F.concat(F.lit("check:"), failed))], *families]


def is_bad(schema: T.StructType, spec: DatasetSpec) -> Column:
    return rules.violated([rule for family in all_rules(schema, spec) for rule in family])


def tag_all(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """As `tag_rows`, over all rule families."""
    return df.withColumn("error_reason", rules.first_tags(*all_rules(df.schema, spec)))


def good_rows(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows that break no rule; the plain conditions reach the Parquet scan."""
    return df.where(~is_bad(df.schema, spec))


def bad_rows(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows that break a rule, with `error_reason`."""
    return tag_all(df.where(is_bad(df.schema, spec)), spec)


def split_counts(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    bad = is_bad(df.schema, spec)
    return df.agg(
        F.count(F.lit(1)).alias("rows_read"),
        F.count_if(~bad).alias("good_rows"),
        F.count_if(bad).alias("bad_rows"),
    )


def reason_counts(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    return bad_rows(df, spec).groupBy("error_reason").agg(F.count(F.lit(1)).alias("row_count"))


def constraint_violations(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows per storage constraint broken, every constraint listed, in one pass."""
    listed = constraint_rules(df.schema, spec)
    summary = df.agg(*[F.count_if(test).alias(tag) for test, tag in listed])
    return report_rows(summary, [
        {"constraint_name": F.lit(tag), "violations": F.col(f"`{tag}`")} for _, tag in listed
    ])


def column_stats(df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Per column: type, NULLs, distinct values and, for numbers, minimum, maximum and mean; NaN is NULL.

    One scan gives everything but distinct values. Those take a second: rows are turned into (column,
    value) pairs, equal ones meet in the tasks before the shuffle, and one shuffle counts them for
    all columns. Without `exact` they are estimated by sketches in the first scan, and the second is saved.
    """
    names = list(columns or df.columns)
    types = {n: df.schema[n].dataType for n in names}
    present = {n: ~rules.is_missing(n, df.schema) for n in names}
    measures: dict[tuple[str, str], Column] = {}
    for n, kind in types.items():
        measures["null_count", n] = F.count_if(~present[n])
        if not exact:
            measures["unique_count", n] = F.hll_sketch_estimate(F.hll_sketch_agg(F.when(present[n], _value_text(n, kind))))
        if isinstance(kind, T.NumericType):
            value = F.when(present[n], F.col(n))
            # whole numbers are summed exactly, as decimals are
            addend = value.cast("decimal(19,0)") if isinstance(kind, T.IntegralType) else value
            measures["min_value", n], measures["max_value", n] = F.min(value).cast("double"), F.max(value).cast("double")
            measures["mean_value", n] = F.try_divide(F.sum(addend).cast("double"), F.count(value).cast("double"))
    place = {key: f"m{i}" for i, key in enumerate(measures)}
    summary = df.agg(*[m.alias(place[key]) for key, m in measures.items()])
    of = lambda what, n: F.col(place[what, n]) if (what, n) in place else F.lit(None).cast("double")
    stats = report_rows(summary, [
        {
            "column_name": F.lit(n), "dtype": F.lit(kind.simpleString()), "null_count": of("null_count", n),
            "unique_count": F.lit(0).cast("bigint") if exact else of("unique_count", n),
            "min_value": of("min_value", n), "max_value": of("max_value", n), "mean_value": of("mean_value", n),
        }
        for n, kind in types.items()
    ])
    if not exact:
        return stats
    pairs = df.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("of_column"), F.when(present[n], _value_text(n, kind)).alias("value")) for n, kind in types.items()
    ]))).where(F.col("value").isNotNull())
    distinct = pairs.distinct().groupBy("of_column").agg(F.count(F.lit(1)).alias("found"))
    return stats.join(distinct, F.col("column_name") == F.col("of_column"), "left").select(
        "column_name", "dtype", "null_count", F.coalesce("found", F.lit(0)).alias("unique_count"),
        "min_value", "max_value", "mean_value",
    )


def _value_text(name: str, kind: T.DataType) -> Column:
    """A text that is equal for equal values only."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        # the two zeros are one value
        return (F.col(name) + F.lit(0.0)).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(name)
    return F.col(name).cast("string") if isinstance(kind, T.AtomicType) else F.to_json(F.struct(name))
