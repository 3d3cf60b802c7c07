"""Keyed merge of a batch into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under `order`.

    Spark turns the rank filter into a per-task limit ahead of the shuffle, so a key that holds
    a third of the rows sends one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(ranked)).where("_rank = 1").drop("_rank")


def collapse_batch(
    batch: DataFrame, keys: Sequence[str], update: Sequence[str], arrival: str
) -> DataFrame:
    """One row per key, as inserting the batch row by row would leave a new key.

    The update columns come from the last arrival and the others from the first: the first row
    inserts, later ones only update.
    """
    values = [c for c in batch.columns if c not in keys and c != arrival]
    kept = [c for c in values if c not in update]
    if not kept:
        return latest_per_key(batch, keys, [F.col(arrival).desc()]).drop(arrival)
    if not update:
        return latest_per_key(batch, keys, [F.col(arrival).asc()]).drop(arrival)
    # two rank filters, which cut a key to a row per task ahead of the shuffle; they rank and meet by the key as
    # one value, in which NULL equals NULL, so that the join moves no row again
    keyed = batch.withColumn("_key", F.struct(*keys))
    first = latest_per_key(keyed.select("_key", *kept, arrival), ["_key"], [F.col(arrival).asc()])
    last = latest_per_key(keyed.select("_key", *keys, *[c for c in values if c in update], arrival), ["_key"], [F.col(arrival).desc()])
    both = first.alias("f").join(last.alias("l"), F.col("f._key") == F.col("l._key"))
    return both.select(
        *[F.col(f"l.{k}").alias(k) for k in keys],
        *[F.col(("f." if c in kept else "l.") + c).alias(c) for c in values],
    )


def merge_upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    arrival: str | None = None,
) -> DataFrame:
    """Target with the batch merged in; no row is ever deleted.

    * `update=None`: every batch column but the keys is taken from the batch;
    * a list: only those, a matched row keeps the target's other columns;
    * an empty list: rows of known keys are ignored.

    `arrival` orders the rows of the batch; without it the batch must be unique on its keys.
    Both sides are unique on the key by then, so the join has no skew.
    """
    values = [c for c in batch.columns if c not in keys and c != arrival]
    update = values if update is None else list(update)
    if arrival is not None:
        batch = collapse_batch(batch, keys, update, arrival)
    if not update:
        fresh = batch.join(target.select(*keys), list(keys), "left_anti")
        return target.unionByName(fresh, allowMissingColumns=True)

    incoming = batch.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(c).alias(f"_n_{c}") for c in values],
        F.lit(True).alias("_incoming"),
    )
    on = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    joined = target.withColumn("_known", F.lit(True)).join(incoming, on, "full_outer")
    out = []
    for name in [*target.columns, *[c for c in values if c not in target.columns]]:
        if name in keys:
            column = F.coalesce(F.col(name), F.col(f"_k_{name}"))
        elif name not in values:
            column = F.col(name)
        elif name not in target.columns:
            column = F.col(f"_n_{name}")
        elif name in update:
            column = F.when(F.col("_incoming"), F.col(f"_n_{name}")).otherwise(F.col(name))
        else:
            column = F.when(F.col("_known"), F.col(name)).otherwise(F.col(f"_n_{name}"))
        out.append(column.alias(name))
    return joined.select(*out)
