"""Bronze files: listing, footers and reading files of differing physical types."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from sluicebox.specs import DatasetSpec

FOOTER_SCHEMA = "file_path string, row_count bigint, column_name string, column_type string"


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Scan with only the wanted columns read; a missing path raises."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def list_files(
    spark: SparkSession, root: str, prefix: str = "", suffix: str = ".parquet",
    ingest_date: str | None = None,
) -> DataFrame:
    """Path, size and modification time of the files below `root`; contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}").load(root)
        .select(
            F.col("path").alias("file_path"), F.col("length").alias("file_size"),
            F.col("modificationTime").alias("modified_at"),
        )
    )
    if prefix:
        files = files.where(F.col("file_path").contains(prefix))
    if ingest_date:
        files = files.where(F.col("file_path").contains(f"ingest_date={ingest_date}"))
    return files


def path_date(path: str = "file_path"):
    """Ingest date out of a path, NULL where it has none."""
    text = F.regexp_extract(path, r"ingest_date=(\d{4}-\d{2}-\d{2})", 1)
    return F.nullif(text, F.lit("")).try_cast("date")


def ingest_dates(files: DataFrame) -> DataFrame:
    """Distinct ingest dates of the listed files, sorted."""
    found = files.select("file_path").distinct().select(path_date().alias("ingest_date")).where("ingest_date is not null")
    return found.distinct().orderBy("ingest_date")


def dataset_names(files: DataFrame, root: str) -> DataFrame:
    """Names of the folders (or files) directly below `root` that hold data."""
    # a local path comes back as file:/x or file:///x
    below = F.regexp_replace("file_path", "^[a-z0-9]+:/+", "/")
    base = "/" + root.split("://")[-1].strip("/") + "/"
    name = F.split_part(F.substring_index(below, base, -1), F.lit("/"), F.lit(1))
    return files.select(name.alias("dataset_name")).distinct().orderBy("dataset_name")


def preview(df: DataFrame, order: Sequence[str], limit: int = 100) -> DataFrame:
    """First rows of a dataset in a fixed order."""
    return df.orderBy(*order).limit(limit)


def describe(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Column names and types as rows."""
    return spark.createDataFrame(
        [(n, t) for n, t in df.dtypes], "column_name string, column_type string"
    )


def footers(files: DataFrame) -> DataFrame:
    """One row per file and column, from the Parquet footers, which executors read in parallel.

    A file that is not Parquet gives one row with NULL for its column. A file that cannot be reached
    fails the task, which Spark runs again: a store's refusal says nothing about the file.
    """

    def read_footers(batches):
        import pandas as pd
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        for batch in batches:
            rows = []
            for path in batch["file_path"]:
                try:
                    if path.startswith("file:") or path.startswith("/"):
                        fs, inner = pafs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
                    else:
                        fs, inner = pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
                    with fs.open_input_file(inner) as handle:
                        footer = pq.ParquetFile(handle)
                        count = footer.metadata.num_rows
                        for f in footer.schema_arrow:
                            # how values are encoded is not a type of its own
                            stored = f.type.value_type if pa.types.is_dictionary(f.type) else f.type
                            kind = "decimal128" if pa.types.is_decimal(stored) else str(stored)
                            rows.append((path, count, f.name, kind.split("[")[0]))
                except pa.ArrowInvalid:
                    rows.append((path, None, None, None))
            yield pd.DataFrame(rows, columns=["file_path", "row_count", "column_name", "column_type"])

    return files.select("file_path").mapInPandas(read_footers, FOOTER_SCHEMA)


def signature():
    """Aggregate of a file's footer rows: a text of its column types. Files with equal texts can be
    scanned at once."""
    return F.array_join(F.array_sort(F.collect_set(F.concat_ws(" ", "column_name", "column_type"))), ",").alias("signature")


def read_group(spark: SparkSession, paths: Iterable[str], spec: DatasetSpec) -> DataFrame:
    """Files of one signature, cast to the spec's types.

    A value that does not fit its type becomes NULL and its column is listed in `cast_errors`. `record_id` is
    the row's position in its file, `arrival` orders rows of different files.
    """
    df = spark.read.parquet(*paths).select(
        "*", F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.row_index").alias("record_id"),
    )
    columns, failures = [], []
    for f in spec.columns:
        if f.name in spec.path_columns:
            columns.append(path_date("source_file").alias(f.name))
            continue
        raw = F.col(f.name)
        if df.schema[f.name].dataType.typeName() in ("double", "float"):
            raw = F.when(~F.isnan(raw), raw)
        value = raw.try_cast(f.dataType)
        failed = raw.isNotNull() & value.isNull()
        if isinstance(f.dataType, T.IntegralType) and isinstance(df.schema[f.name].dataType, T.FractionalType):
            # a whole number may come as 2.0, but 2.7 is not cut to 2
            value = F.when(value == raw, value)
            failed = raw.isNotNull() & value.isNull()
        columns.append(value.alias(f.name))
        failures.append(F.when(failed, F.lit(f.name)))
    return df.select(
        *columns, "source_file", "record_id",
        F.struct("source_file", "record_id").alias("arrival"),
        F.array_compact(F.array(*failures)).alias("cast_errors"),
    )


def read_files(
    spark: SparkSession, groups: dict[str, list[str]], spec: DatasetSpec
) -> DataFrame | None:
    """Union of the signature groups; each is a scan of its own because Spark cannot read one
    column as long here and double there."""
    frames = [read_group(spark, paths, spec) for _, paths in sorted(groups.items())]
    out = None
    for frame in frames:
        out = frame if out is None else out.unionByName(frame)
    return out


def write_partitioned(df: DataFrame, root: str, by: Sequence[str] = ("ingest_date",)) -> None:
    """Snappy Parquet under hive-style folders. Rebalancing splits a folder that holds many of the
    rows over several tasks and files, and lets small ones share a task."""
    (df.hint("rebalance", *by).write.mode("append").option("compression", "snappy")
     .partitionBy(*by).parquet(root))


def fingerprint(df: DataFrame, columns: Sequence[str], by: str = "source_file") -> DataFrame:
    """Per file a row count and a checksum that does not depend on row order.

    Each row gives two 32-bit words of an MD5 over its values; their sums combine before the
    shuffle, and a bigint holds them for two billion rows of a file.
    """
    # each value with its length in front, so that neither NULLs nor separators can be mistaken
    text = lambda c: F.col(c).cast("string")
    values = [F.coalesce(F.concat(F.length(text(c)).cast("string"), F.lit(":"), text(c)), F.lit("N")) for c in columns]
    hashed = df.select(by, F.md5(F.concat(*values).cast("binary")).alias("_hash"))
    word = lambda start: F.sum(F.conv(F.substring("_hash", start, 8), 16, 10).cast("bigint"))
    return hashed.groupBy(by).agg(
        F.count(F.lit(1)).alias("record_count"),
        F.concat_ws("-", word(1).cast("string"), word(9).cast("string")).alias("checksum"),
    )
