"""Dataset rules and the engine's default thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

from sluicebox import schemas


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    columns: T.StructType
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    # column -> (minimum, maximum), either end may be None
    ranges: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    # columns silver stores as NOT NULL, and those with bounds of their own
    not_null: tuple[str, ...] = ()
    bounds: dict[str, tuple[float | None, float | None]] = field(default_factory=dict)
    path_columns: tuple[str, ...] = ("ingest_date",)

    @property
    def file_columns(self) -> list[str]:
        return [c for c in self.columns.names if c not in self.path_columns]


# The sales rules.
SALES = DatasetSpec(
    name="sales",
    columns=schemas.BRONZE_SALES,
    required=(
        "transaction_id", "sale_date", "customer_id", "product_id",
        "quantity", "unit_price", "net_amount",
    ),
    unique=("transaction_id",),
    ranges={
        "quantity": (1, 1000),
        "unit_price": (0, 100000),
        "discount_percentage": (0, 100),
    },
    not_null=(
        "transaction_id", "sale_date", "sale_hour", "customer_id", "product_id", "quantity",
        "unit_price", "discount_percentage", "discount_amount", "gross_amount", "net_amount",
    ),
    bounds={
        "sale_hour": (0, 23),
        "quantity": (1, None),
        "unit_price": (0, None),
        "discount_percentage": (0, 100),
        "discount_amount": (0, None),
        "gross_amount": (0, None),
        "net_amount": (0, None),
    },
)

# Spend tiers, highest first; a customer must spend more than the bound.
SPEND_TIERS = (("Platinum", 10000), ("Gold", 5000), ("Silver", 1000))
LOWEST_TIER = "Bronze"

# Payment methods counted as online.
ONLINE_PAYMENTS = ("Credit Card", "Debit Card", "Digital Wallet")

# Quality thresholds and the columns whose completeness matters.
DRIFT_THRESHOLD_PCT = 10.0
COMPLETENESS_THRESHOLD_PCT = 95.0
FRESHNESS_SLA_HOURS = 24
CRITICAL_COLUMNS = {
    "silver.sales": ("transaction_id", "customer_id", "product_id", "sale_date", "net_amount"),
    "silver.customers": ("customer_id", "customer_name"),
    "silver.products": ("product_id", "product_name", "category"),
}

# File states, and those after which a file is not read again.
TERMINAL_FILE_STATES = ("PROCESSED", "SCHEMA_DRIFT", "FAILED")

# Remediation.
MAX_RETRIES = 3
REMEDIATION_BATCH = 1000
REPLAY_REQUIRED = (
    "transaction_id", "sale_date", "product_id", "quantity", "unit_price", "customer_id",
)

# Seconds that must pass before an alert of the same key goes out again.
THROTTLE_SECONDS = {"critical": None, "warning": 3600, "info": 21600}
HIGH_QUARANTINE_PCT = 50
