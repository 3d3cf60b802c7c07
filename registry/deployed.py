"""Stored tables after what a deployment does to them: merges, gold refreshes, remediation and quality runs.

Each function makes its tables once per application and data folder, through the library's own plans.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from registry import tables as R
from sluicebox import specs
from sluicebox.operators import upsert
from sluicebox.plans.gold import refresh_gold
from sluicebox.plans.layers import CHANGES, GROUPS, QUARANTINE, Layers
from sluicebox.plans.quality import check_quality
from sluicebox.plans.remediation import remediate

AS_OF = date(2002, 1, 1)
NOW = datetime(2002, 1, 1)
UPDATES = [c for c in specs.SALES.columns.names if c != "transaction_id"]

_made: dict[tuple, object] = {}


def _once(key: tuple, make):
    with R._lock:
        if key not in _made:
            _made[key] = make()
    return _made[key]


def _layers(spark: SparkSession, sf_dir: str, name: str) -> Layers:
    return Layers(spark, f"{R.store(spark, sf_dir).root}/{name}", R.buckets(spark, sf_dir))


def _arrived(spark: SparkSession, sf_dir: str, since: date | None, until: date | None) -> DataFrame:
    """Silver rows by the day they came in."""
    rows = R.silver_rows(R.bronze(spark, sf_dir))
    for day, test in ((since, F.col("ingest_date") >= F.lit(since)), (until, F.col("ingest_date") < F.lit(until))):
        rows = rows if day is None else rows.where(test)
    return rows


SPLIT = date(1999, 1, 1)


def _early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver as of 1998."""
    rows = _arrived(spark, sf_dir, None, SPLIT)
    return upsert.latest_per_key(rows, ["transaction_id"], [F.col("arrival").desc()]).drop("arrival")


def merged(spark: SparkSession, sf_dir: str) -> Layers:
    """Silver as of 1998, then a merge of all later arrivals."""
    def make() -> Layers:
        layers = _layers(spark, sf_dir, "merged")
        layers.sales.merge(_early(spark, sf_dir))
        layers.sales.merge(_arrived(spark, sf_dir, SPLIT, None), UPDATES, "arrival")
        return layers

    return _once(("merged", R.store(spark, sf_dir).root), make)


# sales that are first stored under a wrong day, product, customer, store and category
ORDER = "cast(split(transaction_id, '-')[1] as bigint)"
MOVED = f"{ORDER} % 50 = 3"
WRONG_DAY = date(1980, 1, 1)


def wrong(column: str) -> Column:
    """The group that a moved sale is first stored in, which vanishes when its sales are corrected."""
    group = F.concat(F.lit("WRONG-"), F.expr(f"{ORDER} div 50 % 40").cast("string"))
    return F.when(F.expr(MOVED), group).otherwise(F.col(column))


def refreshed(spark: SparkSession, sf_dir: str, drop_vanished: bool) -> Layers:
    """Gold built over silver as of 1998 with the moved sales in wrong groups, then silver merged twice (the
    corrections of those, then all later arrivals) and gold refreshed after each."""
    def make() -> Layers:
        layers = _layers(spark, sf_dir, f"refreshed-{drop_vanished}")
        early = _early(spark, sf_dir)
        misplaced = early.withColumns({c: wrong(c) for c in ("customer_id", "product_id", "store_location", "category")})
        day = F.date_add(F.lit(WRONG_DAY), F.expr(f"{ORDER} div 50 % 28").cast("int"))
        misplaced = misplaced.withColumn("sale_date", F.when(F.expr(MOVED), day).otherwise(F.col("sale_date")))
        layers.sales.merge(misplaced, None, None, GROUPS, CHANGES)
        refresh_gold(layers, AS_OF - timedelta(days=2), R.TIERS)
        layers.sales.merge(early.where(F.expr(MOVED)), None, None, GROUPS, CHANGES)
        refresh_gold(layers, AS_OF - timedelta(days=1), R.TIERS, drop_vanished)
        layers.sales.merge(_arrived(spark, sf_dir, SPLIT, None), UPDATES, "arrival", GROUPS, CHANGES)
        refresh_gold(layers, AS_OF, R.TIERS, drop_vanished)
        return layers

    return _once(("refreshed", R.store(spark, sf_dir).root, drop_vanished), make)


def remediated(spark: SparkSession, sf_dir: str) -> tuple[Layers, DataFrame]:
    """Silver and quarantine after two runs, with the runs' totals. Of the quarantined payloads those with
    an id that 7 divides carry a discount that no table holds, so their replay fails."""
    def make() -> tuple[Layers, DataFrame]:
        layers = _layers(spark, sf_dir, "remediated")
        layers.sales.merge(R.table(spark, sf_dir, "silver.sales"))
        over = F.regexp_replace("payload", r'"discount_percentage":[0-9.]+', '"discount_percentage":150.00')
        records = R.table(spark, sf_dir, QUARANTINE)
        layers.append(QUARANTINE, records.withColumn("payload", F.when(F.col("id") % 7 == 0, over).otherwise(F.col("payload"))))
        totals = None
        for n, name in enumerate(("first", "second")):
            done = remediate(layers, name, NOW + timedelta(days=n)).withColumn("run", F.lit(name))
            totals = done if totals is None else totals.unionByName(done)
        return layers, totals

    return _once(("remediated", R.store(spark, sf_dir).root), make)


def checked(spark: SparkSession, sf_dir: str) -> tuple[Layers, DataFrame]:
    """Two quality runs over stored tables, a day and an hour apart, with a merge of later arrivals between
    them; their summaries."""
    def make() -> tuple[Layers, DataFrame]:
        layers = _layers(spark, sf_dir, "checked")
        layers.append(QUARANTINE, R.table(spark, sf_dir, QUARANTINE))
        summaries = None
        for n, rows in enumerate((_arrived(spark, sf_dir, None, SPLIT), _arrived(spark, sf_dir, SPLIT, None))):
            layers.sales.merge(rows, UPDATES, "arrival", GROUPS, CHANGES)
            refresh_gold(layers, AS_OF, R.TIERS)
            summary, _ = check_quality(layers, NOW + timedelta(hours=25 * n))
            summary = summary.withColumn("run", F.lit(n))
            summaries = summary if summaries is None else summaries.unionByName(summary)
        return layers, summaries

    return _once(("checked", R.store(spark, sf_dir).root), make)
