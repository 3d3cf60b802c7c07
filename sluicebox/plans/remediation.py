"""One remediation run over the stored quarantine."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from sluicebox import specs
from sluicebox.operators import remediation
from sluicebox.plans.layers import CHANGES, CLOSED_BY, GROUPS, OPEN, QUARANTINE, SCHEMAS, Layers


def remediate(layers: Layers, run_id: str, now: datetime, max_retries: int = specs.MAX_RETRIES) -> DataFrame:
    """Replay, reject and dead-letter everything pending in one pass; returns the run's totals.

    Only open records are read and written again, whatever the history. Their verdicts are written once,
    with the payloads parsed once; a run that is repeated under its name after a failure starts from
    those, so it replays the same rows over themselves and closes the same records.
    """
    at = F.lit(now).cast("timestamp_ntz")
    name = f"staging.{run_id}.examined"
    again = layers.store.exists(name)
    if not again:
        records = remediation.migrate(layers.records(F.col(CLOSED_BY) == OPEN))
        layers.store.write(name, remediation.examine(records, F.lit(now.date()), at, max_retries))
    examined = layers.store.read(name)
    layers.sales.merge(remediation.replayed_sales(examined), remediation.REPLAY_UPDATES, "arrival", GROUPS, CHANGES)
    settled = remediation.settle(examined, at, max_retries)
    if again:
        settled = settled.unionByName(_since(layers, examined))
    layers.settle(settled, run_id)
    others = layers.records(~F.col(CLOSED_BY).isin(OPEN, run_id))
    if again:
        others = others.unionByName(_since(layers, examined))
    return layers.store.write(f"staging.{run_id}.totals", remediation.run_totals(
        remediation.unexamined(others).unionByName(examined), at, max_retries
    ))


def _since(layers: Layers, examined: DataFrame) -> DataFrame:
    """Open records that an ingest has quarantined since the failed run that is repeated."""
    return layers.records(F.col(CLOSED_BY) == OPEN).join(examined, ["source_file", "id"], "left_anti").select(*SCHEMAS[QUARANTINE].names)
