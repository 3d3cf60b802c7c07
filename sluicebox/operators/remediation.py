"""Revalidating, replaying, rejecting and dead-lettering quarantined records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sluicebox import schemas, specs
from sluicebox.functions import amounts, payload, rules
from sluicebox.operators.shaping import computed_once, conform
from sluicebox.operators.upsert import merge_upsert

# What a replay overwrites in a sale silver already holds.
REPLAY_UPDATES = (
    "sale_date", "quantity", "unit_price", "discount_percentage", "discount_amount",
    "gross_amount", "net_amount", "processed_at",
)


# Who closed a record.
REPLAYED_BY, REJECTED_BY, ESCALATED_BY = "remediation_dag", "auto_rejected", "dead_letter_escalation"


def is_open(max_retries: int = specs.MAX_RETRIES) -> Column:
    return (F.col("remediation_status") == "pending") & (F.col("retry_count") < max_retries)


def pending_batch(
    quarantine: DataFrame, limit: int = specs.REMEDIATION_BATCH, max_retries: int = specs.MAX_RETRIES
) -> DataFrame:
    """The oldest open records. A whole run needs no batches; this is the report of what is next."""
    return (
        quarantine.where(is_open(max_retries))
        .select("id", "ingestion_run_id", "payload", "error_reason", "source_file", "failed_at", "retry_count")
        .orderBy("failed_at", "id", "source_file", "payload").limit(limit)
    )


NAMES = schemas.SILVER_SALES.names
NUMBERS = ("quantity", "unit_price", "discount_percentage")

# what a replay writes for a field the payload lacks
DEFAULTS = {
    **dict.fromkeys(NAMES, ""),
    **dict.fromkeys(("sale_hour", "profit_margin", "is_weekend", "is_holiday"), "0"),
    **dict.fromkeys(("transaction_id", "sale_date", "customer_id", "product_id")),
}


def unpacked(quarantine: DataFrame) -> DataFrame:
    """Adds what the payload holds: `_readable`, the names of `_missing` fields, the `_texts` of
    all fields, and which are `_numeric` and their `_value` for the numeric ones."""
    # the text is parsed once into a variant, from which the fields are taken
    read = computed_once(quarantine, {"_document": payload.parsed(F.col("payload"))})
    read = computed_once(read, {"_json": payload.fields("_document", NAMES)})
    field = lambda n: F.col(f"_json.{n}")
    read = computed_once(read, {
        "_missing": payload.missing("_json", specs.REPLAY_REQUIRED),
        "_texts": payload.texts("_json", NAMES),
        "_numeric": F.struct(*[payload.is_number(field(n)).alias(n) for n in ("quantity", "unit_price")]),
        "_value": F.struct(*[payload.number(field(n)).alias(n) for n in NUMBERS]),
    })
    return read.select(
        *quarantine.columns, "_missing", "_texts", "_numeric", "_value",
        F.col("_document").isNotNull().alias("_readable"),
        F.struct(*[field(n).isNull().alias(n) for n in NAMES]).alias("_absent"),
    )


def reject_reason() -> Column:
    """Why an unpacked record cannot be replayed, NULL when it can; the first failing rule counts."""
    names = F.array_join(F.transform("_missing", lambda n: F.concat(F.lit("'"), n, F.lit("'"))), ", ")
    quantity, price = F.col("_value.quantity"), F.col("_value.unit_price")
    return (
        F.when(~F.col("_readable"), F.lit("Parse error: malformed payload"))
        .when(F.size("_missing") > 0, F.concat(F.lit("Missing fields: ["), names, F.lit("]")))
        .when(~F.col("_numeric.quantity"), F.lit("Parse error: quantity is not a number"))
        .when(quantity <= 0, F.lit("Invalid quantity (<= 0)"))
        .when(~F.col("_numeric.unit_price"), F.lit("Parse error: unit_price is not a number"))
        .when(price < 0, F.lit("Invalid unit_price (< 0)"))
    )


def validate(quarantine: DataFrame) -> DataFrame:
    """Adds `reject_reason` and `is_valid` to each record."""
    return (
        computed_once(unpacked(quarantine), {"reject_reason": reject_reason()})
        .select(*quarantine.columns, "reject_reason", F.col("reject_reason").isNull().alias("is_valid"))
    )


def with_sale(unpacked_records: DataFrame, run_date: Column, processed_at: Column) -> DataFrame:
    """Adds struct `sale`: the record as a silver row with recomputed amounts, where the discount
    covers the quantity, and `replay_errors`, the storage constraints that row would break."""
    share = F.when(F.col("_absent.discount_percentage"), F.lit(0)).otherwise(F.col("_value.discount_percentage"))
    read = computed_once(unpacked_records, {
        # whole numbers only: a fraction is cut off
        "_units": F.floor("_value.quantity").try_cast("int"),
        "_price": F.col("_value.unit_price").try_cast("decimal(14,4)"),
        "_share": share.try_cast("decimal(9,4)"),
    })
    # at most 33 digits, so the products are exact
    gross = F.col("_price") * F.col("_units").cast("decimal(10,0)")
    priced = computed_once(read, {
        "_gross": amounts.money(gross),
        "_off": amounts.money(gross * F.col("_share") / F.lit(100).cast("decimal(3,0)")),
    })
    given = lambda n: F.col("_texts")[NAMES.index(n)]
    text = lambda n: F.when(F.col(f"_absent.{n}"), F.lit(DEFAULTS[n])).otherwise(given(n))
    flag = lambda n: F.coalesce(text(n).isin("1", "true"), F.lit(False))
    values = {n: text(n) for n in NAMES} | {
        "sale_date": text("sale_date").try_cast("date"),
        "sale_hour": text("sale_hour").try_cast("decimal(10,0)").try_cast("int"),
        "quantity": F.col("_units"),
        "unit_price": amounts.money(F.col("_price")),
        "discount_percentage": amounts.money(F.col("_share"), 5),
        "discount_amount": F.col("_off"),
        "gross_amount": F.col("_gross"),
        "net_amount": amounts.money(F.col("_gross") - F.col("_off")),
        "profit_margin": text("profit_margin").try_cast("decimal(5,2)"),
        "is_weekend": flag("is_weekend"),
        "is_holiday": flag("is_holiday"),
        "ingest_date": F.when(F.col("_absent.ingest_date"), run_date).otherwise(given("ingest_date").try_cast("date")),
        "processed_at": processed_at,
    }
    sale = F.struct(*[
        values[f.name].cast(f.dataType).alias(f.name) for f in schemas.SILVER_SALES
    ])
    broken = rules.first_tags(rules.storage_rules(
        specs.SALES.not_null, specs.SALES.bounds, schemas.SILVER_SALES, "sale."
    ))
    return computed_once(computed_once(priced, {"sale": sale}), {"replay_errors": broken})


def examine(
    quarantine: DataFrame, run_date: Column, processed_at: Column, max_retries: int = specs.MAX_RETRIES
) -> DataFrame:
    """The records with `verdict` (`replay`, `reject` or `fail`; NULL for closed ones), their
    `reject_reason` and the `sale` a replay writes. Only open records' payloads are parsed, so the
    work grows with what is pending and not with the history."""
    is_pending = F.coalesce(is_open(max_retries), F.lit(False))
    judged = computed_once(unpacked(quarantine.where(is_pending)), {"reject_reason": reject_reason()})
    judged = with_sale(judged, run_date, processed_at)
    verdict = (
        F.when(F.col("reject_reason").isNotNull(), F.lit("reject"))
        .when(F.col("replay_errors").isNotNull(), F.lit("fail"))
        .otherwise(F.lit("replay"))
    )
    judged = judged.select(*quarantine.columns, "reject_reason", verdict.alias("verdict"), "sale")
    return judged.unionByName(unexamined(quarantine.where(~is_pending)))


def unexamined(records: DataFrame) -> DataFrame:
    """Records without a verdict, with the columns of examined ones."""
    return records.withColumns({
        "reject_reason": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string"),
        "sale": F.lit(None).cast(schemas.SILVER_SALES),
    })


def replayed_sales(examined: DataFrame) -> DataFrame:
    """The silver rows a run writes, with `arrival`: later failures count as later."""
    return examined.where(F.col("verdict") == "replay").select(
        "sale.*", F.struct("failed_at", "id").alias("arrival")
    )


def replay(silver: DataFrame, examined: DataFrame) -> DataFrame:
    """Silver with the replayable records merged in."""
    merged = merge_upsert(
        silver, replayed_sales(examined), ["transaction_id"], REPLAY_UPDATES, arrival="arrival"
    )
    return conform(merged, schemas.SILVER_SALES)


def settle(
    examined: DataFrame, now: Column, max_retries: int = specs.MAX_RETRIES, keep: Sequence[str] = ()
) -> DataFrame:
    """The quarantine after a run: replayed records remediated, unfixable ones rejected, failed
    ones counted up, and pending ones out of retries dead-lettered. No join: each record carries
    its verdict."""
    verdict = F.coalesce(F.col("verdict"), F.lit(""))
    tries = F.col("retry_count") + (verdict == "fail").cast("int")
    counted = examined.withColumn("retry_count", tries.cast("int"))
    dead = (
        (F.col("remediation_status") == "pending") & ~verdict.isin("replay", "reject")
        & (F.col("retry_count") >= max_retries)
    )
    pick = lambda done, no, gone, column: (
        F.when(verdict == "replay", done).when(verdict == "reject", no).when(dead, gone)
        .otherwise(F.col(column))
    )
    closed = F.lit(True)
    reason = F.col("error_reason")
    changes = {
        "error_reason": pick(
            reason,
            F.concat(F.coalesce(reason, F.lit("")), F.lit(" | Rejected: "), F.col("reject_reason")),
            F.concat(F.coalesce(reason, F.lit("")), F.lit(" | Dead-lettered after "),
                     F.col("retry_count").cast("string"), F.lit(" retries")),
            "error_reason",
        ),
        "corrected_by": pick(
            F.lit(REPLAYED_BY), F.lit(REJECTED_BY), F.lit(ESCALATED_BY), "corrected_by"
        ),
        "replayed": pick(closed, closed, closed, "replayed"),
        "replayed_at": pick(now, now, now, "replayed_at"),
        "remediation_status": pick(
            F.lit("remediated"), F.lit("rejected"), F.lit("dead_letter"), "remediation_status"
        ),
    }
    return counted.withColumns(changes).select(*schemas.QUARANTINE.names, *keep)


def escalate(quarantine: DataFrame, now: Column, max_retries: int = specs.MAX_RETRIES) -> DataFrame:
    """Only the dead-letter step: pending records out of retries."""
    untouched = quarantine.withColumns({
        "verdict": F.lit(None).cast("string"), "reject_reason": F.lit(None).cast("string"),
    })
    return settle(untouched, now, max_retries)


def reject(records: DataFrame, now: Column) -> DataFrame:
    """Close validated records (`reject_reason` set) as rejected."""
    return settle(records.withColumn("verdict", F.lit("reject")), now)


def count_up(quarantine: DataFrame, failed: DataFrame, keys: Sequence[str] = ("ingestion_run_id", "id")) -> DataFrame:
    """One more retry for the records whose key is in `failed`."""
    marks = failed.select(*keys).distinct().withColumn("_failed", F.lit(1))
    return quarantine.join(marks, list(keys), "left").withColumn(
        "retry_count", (F.col("retry_count") + F.coalesce(F.col("_failed"), F.lit(0))).cast("int")
    ).select(*quarantine.columns)


def migrate(quarantine: DataFrame) -> DataFrame:
    """Older quarantine tables: missing state columns get defaults, replayed records are closed."""
    df = quarantine
    if "remediation_status" not in df.columns:
        df = df.withColumn("remediation_status", F.lit("pending"))
    if "retry_count" not in df.columns:
        df = df.withColumn("retry_count", F.lit(0))
    legacy = F.col("replayed") & (F.col("remediation_status") == "pending")
    return df.withColumn(
        "remediation_status", F.when(legacy, F.lit("remediated")).otherwise(F.col("remediation_status"))
    )


def run_totals(examined: DataFrame, now: Column, max_retries: int = specs.MAX_RETRIES) -> DataFrame:
    """One row: what the run did and the quarantine's counts after it."""
    settled = settle(
        examined.withColumn("_before", F.col("remediation_status")), now, max_retries,
        keep=["verdict", "_before"],
    )
    count = lambda v: F.count_if(F.col("verdict") == v)
    status = F.col("remediation_status")
    return settled.agg(
        count("replay").alias("fixed"), count("fail").alias("failed"), count("reject").alias("rejected"),
        F.count_if((status == "dead_letter") & (F.col("_before") == "pending")).alias("dead_lettered"),
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(status == s).alias(f"now_{s}") for s in ("pending", "remediated", "rejected", "dead_letter")],
    )
