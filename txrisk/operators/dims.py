"""Dimension state from change events: projection and latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk import schemas
from txrisk.operators.decode import decode_envelopes

CUSTOMER_STATE = schemas.CUSTOMER_STATE.names
ACCOUNT_STATE = schemas.ACCOUNT_STATE.names
# The order of changes to one key: the event's time, then its log position.
CHANGE_ORDER = ("ts_ms", "lsn")


def _changes(raw: DataFrame, row, key: str) -> DataFrame:
    decoded = decode_envelopes(raw, row)
    return decoded.filter(F.col(f"record.{key}").isNotNull()).select(
        "op", "record",
        (F.col("op") == "d").alias("is_deleted"),  # null when the operation is null
        F.timestamp_millis("ts_ms").alias("updated_at"),
        "ts_ms", F.col("source.lsn").alias("lsn"),
    )


def customer_changes(raw: DataFrame) -> DataFrame:
    """Customer state after each change, with the columns that order the changes."""
    return _changes(raw, schemas.CUSTOMER_ROW, "customer_id").select(
        "record.customer_id", "record.risk_level", "is_deleted", "updated_at", *CHANGE_ORDER
    )


def account_changes(raw: DataFrame) -> DataFrame:
    """Account state after each change; a deleted account has status DELETED."""
    status = F.when(F.col("op") == "d", "DELETED").otherwise(F.col("record.status"))
    return _changes(raw, schemas.ACCOUNT_ROW, "account_id").select(
        "record.account_id", "record.customer_id", "record.account_type",
        status.alias("status"), "is_deleted", "updated_at", *CHANGE_ORDER,
    )


def latest_state(
    changes: DataFrame, keys: str | Sequence[str], order: Sequence[str] = CHANGE_ORDER
) -> DataFrame:
    """The last change of each key; deleted keys stay, with their flag.

    An aggregate, not a ranking: each task reduces its rows to one per key before the shuffle,
    so a key with very many changes costs one row per task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in changes.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    return changes.groupBy(*keys).agg(last).select(*keys, "last.*").select(*changes.columns)
