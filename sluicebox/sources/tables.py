"""Written tables: plain Parquet folders, and keyed tables that Spark keeps bucketed by their key."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Collection, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from sluicebox.operators.shaping import conform
from sluicebox.operators.upsert import collapse_batch, merge_upsert
from sluicebox.session import setting, swept


# what a task of a merge reads of files at once: Spark sorts it, by key to collapse a batch and by folder to copy
# over a keyed table's. Left to itself a task reads up to 128 MB, over a gigabyte of wide rows in memory
COPIED_BYTES = "32m"
# tasks that list a keyed table's folders: left to itself, Spark starts one for each folder
LISTING_TASKS = 64
# month that a keyed table keeps rows without a day in
NO_DAY = date(1900, 1, 1)
# what is read of a keyed table's files at once where its months are worked on one after another
TURN_BYTES = 64 * 2 ** 20
# stored bronze takes a quarter less than with snappy, and no more time
CODEC = "zstd"
# parts of what a merge writes aside: the rows by folder, and the names of the folders they replace
ROWS, REPLACED = "rows", "replaced.json"
# folders whose files the driver moves at the same time, and folders named to the catalog in one statement
MOVED_AT_ONCE, ADDED_AT_ONCE = 16, 500


def few_listing_tasks(spark: SparkSession):
    return setting(spark, "spark.sql.sources.parallelPartitionDiscovery.parallelism", str(LISTING_TASKS))


class TableStore:
    """Parquet tables, each a folder under one root, written by Spark's own saves."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, location: str):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(location)
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def location(self, name: str) -> str:
        return f"{self.root}/{name}"

    def is_complete(self, location: str) -> bool:
        """Whether a save into the folder has ended."""
        path, fs = self._path(f"{location}/_SUCCESS")
        return fs.exists(path)

    def exists(self, name: str) -> bool:
        """Whether rows have been saved; what a save has not committed does not count."""
        path, fs = self._path(self.location(name))
        entries = fs.listStatus(path) if fs.exists(path) else ()
        return any(not e.getPath().getName().startswith((".", "_temporary")) for e in entries)

    def delete(self, location: str) -> None:
        path, fs = self._path(location)
        fs.delete(path, True)

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The table; an empty frame of `schema` for one not yet written."""
        if not self.exists(name):
            if schema is None:
                raise LookupError(f"table {name} has not been written under {self.root}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.location(name))

    def write(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write the table whole and read it back; `df` must not read the table itself (see `replace`)."""
        self._save(_writer(df, "overwrite", partition_by), self.location(name))
        return self.read(name, df.schema)

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        self._save(_writer(df, "append", partition_by), self.location(name))

    def write_partitions(self, name: str, df: DataFrame, by: Sequence[str]) -> None:
        """Replace the partitions that `df` has rows of, and leave the others: a stream's batch that is
        delivered again, with its number as partition, replaces what its first delivery wrote."""
        self._save(_writer(df, "overwrite", by).option("partitionOverwriteMode", "dynamic"), self.location(name))

    def truncate(self, name: str, schema: T.StructType) -> DataFrame:
        return self.write(name, self.spark.createDataFrame([], schema))

    def replace(self, name: str, df: DataFrame, schema: T.StructType) -> DataFrame:
        """Write the table whole from a frame that may read it: over a copy, which is deleted once the
        table holds its rows. A driver that dies in between leaves the copy."""
        copy = f"{self.root}/_copies/{name}-{uuid.uuid4().hex}"
        self._save(_writer(conform(df, schema), "errorifexists"), copy)
        out = self.write(name, self.spark.read.schema(schema).parquet(copy))
        self.delete(copy)
        return out

    def _save(self, writer, location: str) -> None:
        with swept(self.spark):
            writer.parquet(location)


def _writer(df: DataFrame, mode: str, partition_by: Sequence[str] = ()):
    writer = df.write.mode(mode).option("compression", CODEC)
    return writer.partitionBy(*partition_by) if partition_by else writer


def _by_folder(df: DataFrame, places: Sequence[str]):
    return _writer(df, "errorifexists", places)


class KeyedTable:
    """A keyed table whose merges neither shuffle nor rewrite all of it.

    Spark keeps it bucketed by the hash of its key, in folders of bucket and month. A batch is shuffled
    to the buckets and meets the table bucket by bucket: the table's rows are not. Which folders a merge
    touches comes from the key column of the batch's buckets; only those are read whole, and replaced.

    `buckets` is fixed when the table is made: enough that a bucket of a month fits a task. A table has
    one writer at a time.
    """

    BUCKET, MONTH = "_bucket", "_month"

    def __init__(self, store: TableStore, name: str, schema: T.StructType, keys: Sequence[str], day: str, buckets: int = 8):
        self.store, self.name, self.schema, self.keys, self.day, self.buckets = store, name, schema, list(keys), day, buckets
        self.folder = store.location(name)
        # names in the session's catalog are unique to the folder
        self.table = f"{re.sub(r'[^a-z0-9]+', '_', name.lower())}_{hashlib.sha256(self.folder.encode()).hexdigest()[:12]}"

    @property
    def spark(self) -> SparkSession:
        return self.store.spark

    def open(self) -> str:
        """The table's name in the catalog, which learns of it and its folders when the session first
        asks; a replacement that a dead driver left unfinished is done again."""
        if not self.spark.catalog.tableExists(self.table):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
            keys = ", ".join(f"`{k}`" for k in self.keys)
            self.spark.sql(
                f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, {self.BUCKET} int, {self.MONTH} date) USING parquet "
                f"PARTITIONED BY ({self.BUCKET}, {self.MONTH}) CLUSTERED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.folder}'"
            )
            path, fs = self.store._path(self.folder)
            if fs.exists(path):
                self.spark.catalog.recoverPartitions(self.table)
            self._publish()
        return self.table

    def placed(self, df: DataFrame) -> DataFrame:
        """Rows with their bucket, as Spark's writer numbers them, and month."""
        month = F.coalesce(F.trunc(self.day, "month"), F.lit(NO_DAY))
        return df.withColumns({self.BUCKET: F.pmod(F.hash(*self.keys), F.lit(self.buckets)), self.MONTH: month})

    def rows(self, where: Column | None = None) -> DataFrame:
        """The table with its folder columns, of the folders that `where` names."""
        df = self.spark.read.table(self.open())
        return df if where is None else df.where(where)

    def read(self, months: Collection[date] | None = None) -> DataFrame:
        """The whole table, or some of its months."""
        where = None if months is None else F.col(self.MONTH).isin(sorted(months)) if months else F.lit(False)
        return self.rows(where).select(*self.schema.names)

    def months(self) -> list[date]:
        """Months that the table has folders of."""
        found = self.spark.sql(f"SHOW PARTITIONS {self.open()}").select(F.split_part("partition", F.lit(f"/{self.MONTH}="), F.lit(2)).alias("m"))
        return sorted(date.fromisoformat(r[0]) for r in found.distinct().collect())

    def turns(self, months: Collection[date]) -> list[list[date]]:
        """Months in groups whose files hold about `TURN_BYTES`: what is shuffled of one group at a time can be
        deleted before the next. Sizes come from Spark's listing of the folders, as its plans have them."""
        months = sorted(months)
        if not months:
            return []
        size = int(str(self.read(months)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        each = max(1, int(len(months) * TURN_BYTES // max(size, 1)))
        return [months[i:i + each] for i in range(0, len(months), each)]

    def touched(self, batch: DataFrame) -> dict[date, set[int]]:
        """Buckets by month of the folders that a collapsed batch with its places (`placed`) changes:
        its own, and those of the rows whose keys it has. Folders are counted here, never rows."""
        buckets = [r[0] for r in batch.select(self.BUCKET).distinct().collect()]
        if not buckets:
            return {}
        places = [self.BUCKET, self.MONTH]
        known = self.rows(F.col(self.BUCKET).isin(sorted(buckets))).select(*self.keys, *places)
        held = known.join(batch.select(*self.keys), self.keys, "left_semi").select(*places)
        out: dict[date, set[int]] = {}
        for bucket, month in held.distinct().union(batch.select(*places).distinct()).collect():
            out.setdefault(month, set()).add(bucket)
        return out

    def folders(self, touched: Mapping[date, Collection[int]]) -> Column:
        """Condition on the folder columns alone."""
        test = F.lit(False)
        for month, buckets in sorted(touched.items()):
            here = F.col(self.MONTH) == F.lit(month)
            test = test | (here if len(buckets) == self.buckets else here & F.col(self.BUCKET).isin(sorted(buckets)))
        return test

    def merged(
        self, batch: DataFrame, touched: Mapping[date, Collection[int]], update: Sequence[str] | None, tracked: Sequence[str] = ()
    ) -> DataFrame:
        """Rows of the touched folders (of all, if none are named) after the merge, with `_before` (`tracked` columns of a row that
        the batch met) and `_changed`."""
        before = self.rows(self.folders(touched) if touched else None).select(*self.schema.names).withColumn(
            "_before", F.struct(*tracked) if tracked else F.struct(F.lit(True).alias("known"))
        )
        marked = batch.select(*[c for c in batch.columns if c in self.schema.names]).withColumn("_changed", F.lit(True))
        chosen = [c for c in self.schema.names if c not in self.keys] if update is None else list(update)
        out = merge_upsert(before, marked, self.keys, [*chosen, "_changed"])
        return self.placed(out.select(
            *[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema],
            F.when(F.col("_changed"), F.col("_before")).alias("_before"), F.coalesce("_changed", F.lit(False)).alias("_changed"),
        ))

    def merge(
        self, batch: DataFrame, update: Sequence[str] | None = None, arrival: str | None = None,
        tracked: Sequence[str] = (), report: str | None = None,
    ) -> int:
        """Upsert a batch, as `merge_upsert` does; returns the number of folders replaced.

        A row for each key of the batch is added to the table `report`: its `tracked` columns `_before` (NULL for
        a new key) and `_after`. The new content of the touched folders is written aside, in the table's folders,
        and its files are then moved into the place of the old ones, which can be repeated: if the driver dies
        meanwhile, the next merge or session starts with it.
        """
        with swept(self.spark), few_listing_tasks(self.spark), setting(self.spark, "spark.sql.files.maxPartitionBytes", COPIED_BYTES):
            return self._merge(batch, update, arrival, tracked, report)

    def _merge(
        self, batch: DataFrame, update: Sequence[str] | None, arrival: str | None, tracked: Sequence[str], report: str | None,
    ) -> int:
        self.open()
        self._publish()
        run = uuid.uuid4().hex
        if arrival is not None:
            batch = collapse_batch(batch, self.keys, [c for c in batch.columns if c not in self.keys] if update is None else update, arrival)
        if not self.store.exists(self.name):
            return self._fill(run, batch, update, tracked, report)
        batch = self.store.write(f"_batches/{self.name}-{run}", self.placed(batch))
        touched = self.touched(batch)
        if touched:
            merged = self.merged(batch, touched, update, tracked)
            if report:
                # before the rows: groups that are reported and did not change do no harm
                self.store.append(report, merged.where("_changed").select(*self.keys, "_before", F.struct(*tracked).alias("_after")))
            _by_folder(self._content(merged), self._places).parquet(f"{self._aside(run)}/{ROWS}")
            self._replaces(run, {(bucket, month) for month, buckets in touched.items() for bucket in buckets})
        self.store.delete(self.store.location(f"_batches/{self.name}-{run}"))
        self._publish()
        return sum(map(len, touched.values()))

    def _fill(self, run: str, batch: DataFrame, update: Sequence[str] | None, tracked: Sequence[str], report: str | None) -> int:
        """The first merge: the batch meets nothing, so it is written in the table's folders at once. As many
        partitions as buckets let the shuffle that found a key's last row be the only one."""
        with setting(self.spark, "spark.sql.shuffle.partitions", str(self.buckets)):
            rows = self.store.write(
                f"{self._aside(run).removeprefix(f'{self.store.root}/')}/{ROWS}", self._content(self.merged(batch, {}, update)), self._places
            )
        if report:
            after = F.struct(*tracked)
            kind = rows.select(after.alias("_after")).schema["_after"].dataType
            self.store.append(report, rows.select(*self.keys, F.lit(None).cast(kind).alias("_before"), after.alias("_after")))
        self._replaces(run, ())
        return self._publish()

    @property
    def _places(self) -> list[str]:
        return [self.BUCKET, self.MONTH]

    def _content(self, merged: DataFrame) -> DataFrame:
        return merged.select(*self.schema.names, *self._places)

    def _aside(self, run: str) -> str:
        return f"{self.store.root}/_merging/{self.name}/{run}"

    def _replaces(self, run: str, folders: Collection[tuple[int, date]]) -> None:
        """Note which folders the rows aside replace; the note has its name once the rows are complete."""
        path, fs = self.store._path(f"{self._aside(run)}/{REPLACED}")
        draft = self.store._path(f"{self._aside(run)}/{REPLACED}.draft")[0]
        out = fs.create(draft)
        out.write(bytearray(json.dumps(sorted((bucket, month.isoformat()) for bucket, month in folders)).encode()))
        out.close()
        if not fs.rename(draft, path):
            raise OSError(f"{draft} was not renamed to {path}")

    def _replaced(self, aside: str) -> list[tuple[int, date]]:
        path, fs = self.store._path(f"{aside}/{REPLACED}")
        note = fs.open(path)
        text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(note, "UTF-8")
        note.close()
        return [(bucket, date.fromisoformat(month)) for bucket, month in json.loads(text)]

    def _publish(self) -> int:
        """Move what lies aside into the folders it replaces; returns their number."""
        path, fs = self.store._path(f"{self.store.root}/_merging/{self.name}")
        moved = 0
        for entry in fs.listStatus(path) if fs.exists(path) else ():
            run, aside = entry.getPath().getName(), entry.getPath().toString()
            if self.store.is_complete(aside):
                # as older versions left it: in no folders, with its changed rows marked
                rows, old = self.spark.read.parquet(aside), run
                run = uuid.uuid4().hex
                _by_folder(self._content(rows), self._places).parquet(f"{self._aside(run)}/{ROWS}")
                self._replaces(run, self._met(rows) | {tuple(r) for r in rows.select(*self._places).distinct().collect()})
                self.store.delete(self._aside(old))
                aside = self._aside(run)
            if fs.exists(self.store._path(f"{aside}/{REPLACED}")[0]):
                moved += self._move(aside, run)
            self.store.delete(aside)
        return moved

    def _move(self, aside: str, run: str) -> int:
        """Files are moved before those they replace are deleted, and bear the name of the run: a move that broke
        off is repeated with what is left aside. Spark reads a file's bucket from its name."""
        folders: dict[tuple[int, date], list] = {folder: [] for folder in self._replaced(aside)}
        path, fs = self.store._path(f"{aside}/{ROWS}")
        found = fs.listFiles(path, True)
        while found.hasNext():
            file = found.next().getPath()
            place = re.search(rf"{self.BUCKET}=(\d+)/{self.MONTH}=([\d-]+)/part-[^/]*$", file.toString())
            if place:
                folders.setdefault((int(place[1]), date.fromisoformat(place[2])), []).append(file)

        def move(bucket: int, month: date) -> bool:
            folder, _ = self.store._path(self._folder(bucket, month))
            known = [e.getPath() for e in fs.listStatus(folder)] if fs.exists(folder) else ()
            if folders[bucket, month]:
                fs.mkdirs(folder)
            for file in folders[bucket, month]:
                stem, _, kind = file.getName().partition(".")
                to = self.store._path(f"{self._folder(bucket, month)}/{stem}-{run}_{bucket:05d}.{kind}")[0]
                if not fs.rename(file, to):
                    raise OSError(f"{file} was not moved to {to}")
            for file in known:
                if run not in file.getName():
                    fs.delete(file, False)
            return bool(folders[bucket, month]) or any(run in f.getName() for f in known)

        with ThreadPoolExecutor(MOVED_AT_ONCE) as pool:
            filled = dict(zip(folders, pool.map(lambda f: move(*f), folders), strict=True))
        kept = sorted(f for f in filled if filled[f])
        for i in range(0, len(kept), ADDED_AT_ONCE):
            specs = " ".join(f"PARTITION ({self._spec(*f)})" for f in kept[i:i + ADDED_AT_ONCE])
            self.spark.sql(f"ALTER TABLE {self.table} ADD IF NOT EXISTS {specs}")
        for folder in sorted(f for f in filled if not filled[f]):
            self._drop(*folder)
        self.spark.catalog.refreshTable(self.table)
        return len(folders)

    def _met(self, rows: DataFrame) -> set[tuple[int, date]]:
        """Folders that a key of the rows lay in, of a merge whose driver is gone: the table still holds
        the key there unless it was replaced already."""
        held = self.rows().join(rows.where("_changed").select(*self.keys), self.keys, "left_semi")
        return {tuple(r) for r in held.select(*self._places).distinct().collect()}

    def _folder(self, bucket: int, month: date) -> str:
        return f"{self.folder}/{self.BUCKET}={bucket}/{self.MONTH}={month.isoformat()}"

    def _spec(self, bucket: int, month: date) -> str:
        return f"{self.BUCKET}={bucket}, {self.MONTH}=DATE'{month.isoformat()}'"

    def _drop(self, bucket: int, month: date) -> None:
        self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION ({self._spec(bucket, month)})")
        # Spark leaves the files of a table that lies in a folder of the caller's
        self.store.delete(self._folder(bucket, month))
