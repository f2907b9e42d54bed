"""Enrich transactions with account, customer, behaviour and previous location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk import schemas
from txrisk.functions import columns as C
from txrisk.operators.asof import asof_join
from txrisk.operators.behavior import DEFAULT, Windows, trailing_features, trailing_features_by_account
from txrisk.operators.dims import CHANGE_ORDER
from txrisk.session import landed

UNKNOWN_RISK = "UNKNOWN"


def account_profiles(accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Current accounts with their current customer; one row per account.

    A customer id that is null or 0 means no customer. Such accounts are given a join key of
    their own, so they do not meet in one partition.
    """
    has_customer = F.coalesce(F.col("customer_id") != 0, F.lit(False))
    left = accounts.select(
        "account_id", "customer_id", "account_type",
        F.col("status").alias("account_status"),
        F.col("is_deleted").alias("account_is_deleted"),
        F.col("updated_at").alias("account_updated_at"),
        has_customer.alias("_has"),
        F.when(has_customer, F.col("customer_id").cast("bigint"))
        .otherwise(F.xxhash64("account_id")).alias("_customer"),
    )
    right = customers.select(
        F.col("customer_id").cast("bigint").alias("_customer_id"),
        F.col("risk_level").alias("customer_risk"),
        F.col("updated_at").alias("customer_updated_at"),
    )
    match = (F.col("_customer") == F.col("_customer_id")) & F.col("_has")
    return left.join(right, match, "left").drop("_has", "_customer", "_customer_id")


PROFILE = (
    "customer_id", "account_type", "account_status", "account_is_deleted",
    "account_updated_at", "customer_risk", "customer_updated_at",
)


def add_profiles(tx: DataFrame, accounts: DataFrame, customers: DataFrame) -> DataFrame:
    """Transactions left-joined to their account and its customer.

    Spark broadcasts the profiles while they are under its own size limit, and otherwise splits
    a hot account's partition at run time (adaptive skew join; the dimension side is unique).
    """
    joined = tx.join(account_profiles(accounts, customers), "account_id", "left")
    return joined.withColumn("customer_risk", known_risk())


def add_profiles_as_of(
    tx: DataFrame,
    account_changes: DataFrame,
    customer_changes: DataFrame,
    order: Sequence[str] = CHANGE_ORDER,
) -> DataFrame:
    """The same columns, each from the version that was valid at the transaction's time.

    Transactions with their accounts are landed in the shared folder: the lookup of customers reads
    them twice.
    """
    with_account = landed(asof_join(
        tx, account_changes, "account_id", "event_time", "updated_at", order, spread_by=["tx_id"]
    ).select(
        *tx.columns, "version.customer_id", "version.account_type",
        F.col("version.status").alias("account_status"),
        F.col("version.is_deleted").alias("account_is_deleted"),
        F.col("version.updated_at").alias("account_updated_at"),
        F.nullif(F.col("version.customer_id"), F.lit(0)).alias("_customer"),
    ), "with-account")
    found = asof_join(
        with_account, customer_changes.withColumnRenamed("customer_id", "_customer"),
        "_customer", "event_time", "updated_at", order, spread_by=["tx_id"],
    )
    return found.select(
        *[c for c in with_account.columns if c != "_customer"],
        F.col("version.risk_level").alias("customer_risk"),
        F.col("version.updated_at").alias("customer_updated_at"),
    ).withColumn("customer_risk", known_risk())


def known_risk() -> Column:
    return F.coalesce(F.col("customer_risk"), F.lit(UNKNOWN_RISK))


def enrich(
    tx: DataFrame,
    accounts: DataFrame,
    customers: DataFrame,
    windows: Windows = DEFAULT,
    event_types: Sequence[str] | None = None,
    context: DataFrame | None = None,
    earlier_tails: DataFrame | None = None,
    cuts: DataFrame | None = None,
    dense: Sequence[int] | None = None,
) -> DataFrame:
    """Clean transactions to the 27 enriched columns.

    `accounts` and `customers` hold one row per key. Profiles are looked up once per
    (account, slot), see `trailing_features`, so a hot account is never one task.
    For micro-batches: `context` holds earlier transactions within reach of the windows, and
    `earlier_tails` the slot tails of everything earlier. `cuts` as in `trailing_features`.
    With `dense`, the accounts too large for a task, the others aren't cut into slots: see
    `trailing_features_by_account`.
    """
    profiles = account_profiles(accounts, customers)
    if dense is None:
        rows = trailing_features(tx, windows, event_types, context, earlier_tails, profiles, cuts)
    elif cuts is not None:
        raise ValueError("cuts are for slots, which only dense accounts have here")
    else:
        rows = trailing_features_by_account(tx, windows, event_types, context, earlier_tails, profiles, dense)
    full = (
        rows.withColumn("customer_risk", known_risk())
        .withColumnsRenamed({"status": "tx_status", "is_deleted": "tx_is_deleted"})
        .withColumn("enriched_at", F.current_timestamp())
    )
    return full.select(*schemas.ENRICHED_COLUMNS)


def wire_format(enriched: DataFrame) -> DataFrame:
    """Timestamps as the text consumers of the enriched topic expect. Internally they stay
    timestamps; this is for the sink only."""
    shown = {
        "event_time": C.iso_text(F.col("event_time")),
        "event_date": F.col("event_date").cast("string"),
        "ingest_time": C.iso_text(F.col("ingest_time")),
        "account_updated_at": F.date_format("account_updated_at", C.ISO_MILLIS),
        "customer_updated_at": F.date_format("customer_updated_at", C.ISO_MILLIS),
        "enriched_at": F.date_format("enriched_at", C.ISO_MICROS),
    }
    return enriched.withColumns(shown)
