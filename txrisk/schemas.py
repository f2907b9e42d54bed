"""Schemas of the change events and of the tables derived from them."""

from __future__ import annotations

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def struct_of(**fields: DataType) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields.items()])


_S, _I, _L = StringType(), IntegerType(), LongType()

# --- fixed values: field names and wire types of the captured tables -------------------------
TRANSACTION_ROW = struct_of(
    tx_id=_L, account_id=_I, amount=_S, currency=_S, tx_type=_S, merchant=_S,
    device_id=_S, ip_address=_S, location=_S, status=_S, created_at=_S,
)
CUSTOMER_ROW = struct_of(
    customer_id=_I, full_name=_S, date_of_birth=_S, phone=_S, email=_S, address=_S,
    risk_level=_S, created_at=_S, updated_at=_S,
)
ACCOUNT_ROW = struct_of(
    account_id=_I, customer_id=_I, account_type=_S, balance=_S, status=_S,
    created_at=_S, updated_at=_S,
)
# ---------------------------------------------------------------------------------------------

# Name of the column that receives text `from_json` cannot read.
CORRUPT = "_corrupt_record"


def envelope(row: StructType) -> StructType:
    """The part of a change event that is used. The event's own `schema` block is left out, so
    the JSON reader skips it instead of copying it into a string per row."""
    source = struct_of(table=_S, lsn=_L)
    payload = struct_of(before=row, after=row, op=_S, source=source, ts_ms=_L)
    return StructType([StructField("payload", payload, True), StructField(CORRUPT, _S, True)])


# --- fixed values: output columns in order, and the name of the source in `cdc_source` ----------
CDC_SOURCE = "debezium"
CLEAN = struct_of(
    tx_id=_L, account_id=_I, amount=DoubleType(), currency=_S, tx_type=_S, merchant=_S,
    device_id=_S, ip_address=_S, location=_S, status=_S,
    event_type=_S, event_time=TimestampType(), event_date=DateType(),
    ingest_time=TimestampType(), is_deleted=BooleanType(),
    cdc_source=_S, table=_S, lsn=_L,
)
CUSTOMER_STATE = struct_of(
    customer_id=_I, risk_level=_S, is_deleted=BooleanType(), updated_at=TimestampType(),
)
ACCOUNT_STATE = struct_of(
    account_id=_I, customer_id=_I, account_type=_S, status=_S,
    is_deleted=BooleanType(), updated_at=TimestampType(),
)
ENRICHED_COLUMNS = (
    "tx_id", "account_id", "amount", "currency", "tx_type", "merchant", "device_id",
    "ip_address", "location", "tx_status", "event_type", "event_time", "event_date",
    "ingest_time", "tx_is_deleted",
    "customer_id", "account_type", "account_status", "account_is_deleted",
    "account_updated_at", "customer_risk", "customer_updated_at",
    "tx_count_1m", "amount_sum_5m", "failed_tx_5m", "last_location",
    "enriched_at",
)
# -------------------------------------------------------------------------------------------------

# What the rules read of an enriched event on the wire.
ENRICHED_WIRE = struct_of(
    tx_id=_L, account_id=_I, amount=DoubleType(), location=_S, customer_risk=_S,
    tx_count_1m=_L, amount_sum_5m=DoubleType(), failed_tx_5m=_L, last_location=_S,
)

# What behaviour windows read of a clean transaction on the wire.
BEHAVIOR_WIRE = StructType([CLEAN[name] for name in (
    "tx_id", "account_id", "amount", "status", "event_type", "event_time")])
