"""Silver to gold: all of it, or what changed since the last time."""

from __future__ import annotations

from collections.abc import Callable, Collection
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, functions as F

from sluicebox import specs
from sluicebox.operators import gold, gold_parts
from sluicebox.operators.upsert import merge_upsert
from sluicebox.plans.layers import CHANGES, CUSTOMERS, SALES, SCHEMAS, Layers
from sluicebox.session import swept
from sluicebox.sources.tables import NO_DAY, few_listing_tasks

DAILY = "gold.daily_sales"
# values of a group column that merges changed, while a refresh runs
TOUCHED = "staging.touched"
# tables written at the same time: most jobs are too small to fill a cluster
AT_ONCE = 4


def _each(actions: list[Callable[[], None]]) -> None:
    with ThreadPoolExecutor(AT_ONCE) as pool:
        for done in [pool.submit(action) for action in actions]:
            done.result()


def build_gold(layers: Layers, as_of: date, tiers=specs.SPEND_TIERS, overwrite: bool = False) -> None:
    """Rebuild the parts of every aggregate from silver, and every aggregate from its parts; daily sales come
    from silver itself.

    Rows are merged by key, so keys that vanished from silver stay, unless `overwrite` is set.
    """
    with swept(layers.spark), few_listing_tasks(layers.spark):
        _build(layers, as_of, tiers, overwrite)


def _build(layers: Layers, as_of: date, tiers, overwrite: bool) -> None:
    sales, store = layers.read(SALES), layers.store
    months = layers.sales.months()
    turns = layers.sales.turns(months) or [[]]

    def keep_parts(name: str) -> None:
        _forget_parts(layers, name, months)
        _keep_parts(layers, name, turns)

    def parts_of(name: str) -> DataFrame:
        return store.read(gold_parts.kept_in(name))

    def build(name: str, fresh: DataFrame) -> None:
        key = SCHEMAS[name].names[0]
        if not overwrite and store.exists(name):
            # a NULL key never meets itself in the join: its row is taken from the new build
            known = layers.read(name).where(F.col(key).isNotNull())
            fresh = merge_upsert(known, fresh, [key])
        layers.replace(name, fresh)

    _each([*(lambda n=n: keep_parts(n) for n in gold_parts.PARTS), lambda: build(DAILY, gold.daily_sales(sales))])
    _total(layers, as_of, tiers, parts_of, build)
    store.delete(store.location(CHANGES))


def _keep_parts(layers: Layers, name: str, turns: Collection[Collection[date]]) -> None:
    """Make the parts of some months of silver again, turn by turn: nearly every sale is a group of its own there,
    so what a turn shuffles is as large as its sales. Months that share a turn are brought together once more
    to be written; a month of its own turn is written as it is."""
    for months in turns:
        parts = gold_parts.PARTS[name](layers.sales.read(months))
        layers.store.write_partitions(name, parts.hint("rebalance", gold_parts.MONTH) if len(months) > 1 else parts, [gold_parts.MONTH])


def _forget_parts(layers: Layers, name: str, months: Collection[date]) -> None:
    """Delete the parts of months that silver does not have; sales without a day lie in its month of `NO_DAY`."""
    path, fs = layers.store._path(layers.store.location(name))
    kept = {f"{gold_parts.MONTH}={m.isoformat()}" for m in months if m != NO_DAY}
    for entry in fs.listStatus(path) if fs.exists(path) else ():
        if entry.isDirectory() and entry.getPath().getName() not in kept:
            layers.store.delete(entry.getPath().toString())


def _total(
    layers: Layers, as_of: date, tiers, parts_of: Callable[[str], DataFrame], put: Callable[[str, DataFrame], None],
) -> None:
    """Sum gold's tables from parts. What several tables take their measures from is summed once and written;
    those tables follow."""
    store, kept = layers.store, gold_parts.kept(F.lit(as_of), tiers)
    place = lambda parts: f"staging.sums.{parts}"
    alone = [n for n, table in kept.items() if table.parts not in gold_parts.SUMS]

    def sum_up(parts: str) -> None:
        store.write(place(parts), gold_parts.SUMS[parts](parts_of(parts)))

    def total(name: str) -> None:
        parts = kept[name].parts
        put(name, kept[name].total(parts_of(parts), store.read(place(parts)) if parts in gold_parts.SUMS else None))

    _each([*(lambda p=p: sum_up(p) for p in gold_parts.SUMS), *(lambda n=n: total(n) for n in alone)])
    _each([lambda n=n: total(n) for n in kept if n not in alone])
    for parts in gold_parts.SUMS:
        store.delete(store.location(place(parts)))


def changed_sales(layers: Layers, changes: DataFrame) -> DataFrame:
    """Silver's rows of the months that hold a changed day; no other folder is read."""
    return _sales_of(layers, gold_parts.touched(changes, "sale_date"))


def _sales_of(layers: Layers, days: DataFrame) -> DataFrame:
    return layers.sales.read(_months_of(days))


def _months_of(days: DataFrame) -> list[date]:
    found = days.select(F.trunc("_touched", "month")).distinct().collect()
    return [r[0] for r in found if r[0] is not None]


def refresh_gold(layers: Layers, as_of: date, tiers=specs.SPEND_TIERS, drop_vanished: bool = False) -> None:
    """Bring gold up to date with the merges since it was last built or refreshed.

    Of silver only the months that a merge changed are read: for the parts of those months, which replace
    what was kept of them, and for the days that changed. The groups that changed are summed from their
    parts and take the place of their rows; days since a customer's last purchase move on for all. A
    refresh that fails is repeated whole: the changes go once everything is written.
    """
    with swept(layers.spark), few_listing_tasks(layers.spark):
        _refresh(layers, as_of, tiers, drop_vanished)


def _refresh(layers: Layers, as_of: date, tiers, drop_vanished: bool) -> None:
    store, kept = layers.store, gold_parts.kept(F.lit(as_of), tiers)
    # a first build that failed left some of them out
    if not all(store.exists(name) for name in (DAILY, *kept, *gold_parts.PARTS)):
        build_gold(layers, as_of, tiers)
        return
    if not store.exists(CHANGES):
        _age_customers(layers, as_of)
        return
    # every table meets the groups that changed several times: they are found once
    changes, keys = store.read(CHANGES), {table.parts: SCHEMAS[name].names[0] for name, table in kept.items()}
    touched: dict[str, DataFrame] = {}

    def find(column: str) -> None:
        touched[column] = store.write(f"{TOUCHED}.{column}", gold_parts.touched(changes, column))

    _each([lambda c=c: find(c) for c in ("sale_date", *dict.fromkeys(keys.values()))])
    days = touched["sale_date"]
    months = _months_of(days)
    sales, turns = layers.sales.read(months), layers.sales.turns(months)
    month = lambda day: F.trunc(day, "month").alias(gold_parts.MONTH)
    left = sales.select(month("sale_date")).distinct()
    emptied = days.select(month("_touched")).distinct().join(left, gold_parts.MONTH, "left_anti").collect()

    def keep_parts(name: str) -> None:
        _keep_parts(layers, name, turns)
        for row in emptied:
            # the month's last row moved to another one
            store.delete(f"{store.location(name)}/{gold_parts.MONTH}={row[0]}")

    def refresh_daily() -> None:
        _replace(layers, DAILY, gold.daily_sales(gold_parts.of_groups(sales, "sale_date", days)), days, drop_vanished)

    def parts_of(name: str) -> DataFrame:
        return gold_parts.of_groups(store.read(gold_parts.kept_in(name)), keys[name], touched[keys[name]])

    def refresh(name: str, fresh: DataFrame) -> None:
        _replace(layers, name, fresh, touched[keys[kept[name].parts]], drop_vanished)

    _each([*(lambda n=n: keep_parts(n) for n in gold_parts.PARTS), refresh_daily])
    _total(layers, as_of, tiers, parts_of, refresh)
    _age_customers(layers, as_of)
    store.delete(store.location(CHANGES))
    for column in touched:
        store.delete(store.location(f"{TOUCHED}.{column}"))


def _replace(layers: Layers, name: str, fresh: DataFrame, groups: DataFrame, drop_vanished: bool) -> None:
    key = SCHEMAS[name].names[0]
    layers.replace(name, gold_parts.replaced(layers.read(name), fresh, key, groups, drop_vanished))


def _age_customers(layers: Layers, as_of: date) -> None:
    days = F.datediff(F.lit(as_of), F.col("last_purchase_date"))
    layers.replace(CUSTOMERS, layers.read(CUSTOMERS).withColumn("days_since_last_purchase", days))
