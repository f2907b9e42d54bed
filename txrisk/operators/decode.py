"""Decode change events into typed, validated rows, and encode rows for a key/value topic.

All of it is one narrow projection plus a filter, so it runs in the scan's own stage without a
shuffle, on batch and on streaming input alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from txrisk import schemas
from txrisk.functions import columns as C

# Why a change event is not a clean transaction.
NULL_VALUE = "NULL_VALUE"
UNDECODABLE = "UNDECODABLE"
NO_TX_ID = "NO_TX_ID"
NO_ACCOUNT = "NO_ACCOUNT"
NO_AMOUNT = "NO_AMOUNT"
BAD_AMOUNT = "BAD_AMOUNT"  # more than the source's NUMERIC(18,2) holds
BAD_TIME = "BAD_TIME"  # outside the years 1 to 9999
NO_KEY = "NO_KEY"
REASONS = (NULL_VALUE, UNDECODABLE, NO_TX_ID, NO_ACCOUNT, NO_AMOUNT, BAD_AMOUNT, BAD_TIME)
REJECTED = ("reason", "value", "tx_id", "event_type")


def _parsed_once(text: Column, schema: StructType) -> Column:
    """JSON text to a struct, parsed once per row.

    A plain `from_json` column is copied by the optimizer into every expression and filter that
    uses one of its fields, and is then parsed again there; plans that branch later grow without
    bound. A generator's output is not copied.
    """
    options = {"columnNameOfCorruptRecord": schemas.CORRUPT}
    return F.explode(F.array(F.from_json(text, schema, options)))


def decode_envelopes(raw: DataFrame, row: StructType) -> DataFrame:
    """Decode `value` (bytes or text). Columns: value, payload fields, row image, corrupt text.

    Reading is permissive: text that is not JSON, or a field of the wrong type, gives nulls.
    """
    text = raw.select(F.col("value").cast("string").alias("value"))
    parsed = text.select("value", _parsed_once(F.col("value"), schemas.envelope(row)).alias("data"))
    return parsed.select("value", f"data.{schemas.CORRUPT}", "data.payload.*").withColumn(
        "record", C.row_image(F.col("op"), F.col("before"), F.col("after"))
    )


def _normalised(raw: DataFrame, precision: str) -> DataFrame:
    """Every change in clean form, valid or not, with what tells the two apart."""
    gone = F.coalesce(F.col("op") == "d", F.lit(False))
    at = C.micros_to_timestamp(F.col("record.created_at"), precision)
    made = {
        "amount": F.when(~gone, F.col("record.amount").try_cast("double")),
        "event_type": C.event_type(F.col("op")),
        "event_time": at,
        "event_date": F.to_date(at),
        "ingest_time": F.current_timestamp(),
        "is_deleted": gone,
        "cdc_source": F.lit(schemas.CDC_SOURCE),
        "table": F.col("source.table"),
        "lsn": F.col("source.lsn"),
    }
    clean = [made.get(name, F.col(f"record.{name}")).alias(name) for name in schemas.CLEAN.names]
    return decode_envelopes(raw, schemas.TRANSACTION_ROW).select("value", schemas.CORRUPT, "op", *clean)


def reject_reason() -> Column:
    """Null for a valid transaction. A delete needs its key only."""
    c = F.col
    return (
        F.when(c("value").isNull(), NULL_VALUE)
        .when(c(schemas.CORRUPT).isNotNull() & c("op").isNull() & c("tx_id").isNull(), UNDECODABLE)
        .when(c("tx_id").isNull(), NO_TX_ID)
        .when(~C.plausible_time(c("event_time")), BAD_TIME)
        .when(c("is_deleted"), F.lit(None).cast("string"))
        .when(c("account_id").isNull(), NO_ACCOUNT)
        .when(c("amount").isNull(), NO_AMOUNT)
        .when(~C.fits_money(c("amount")), BAD_AMOUNT)
    )


def clean_transactions(raw: DataFrame, precision: str = "micros") -> DataFrame:
    """Valid transactions in the 18-column clean form."""
    complete = F.col("account_id").isNotNull() & C.fits_money(F.col("amount"))
    timed = F.col("event_time").isNull() | C.plausible_time(F.col("event_time"))
    valid = F.col("tx_id").isNotNull() & timed & (F.col("is_deleted") | complete)
    return _normalised(raw, precision).filter(valid).select(*schemas.CLEAN.names)


def rejected_transactions(raw: DataFrame, precision: str = "micros") -> DataFrame:
    """The other side of `clean_transactions`: raw text and the reason it was refused."""
    return (
        _normalised(raw, precision)
        .select(reject_reason().alias("reason"), "value", "tx_id", "event_type")
        .filter(F.col("reason").isNotNull())
    )


def decoded_transactions(raw: DataFrame, precision: str = "micros") -> DataFrame:
    """Both sides at once: the clean columns, and of rows that are not clean the reason and raw text."""
    reason = reject_reason()
    return _normalised(raw, precision).select(
        *schemas.CLEAN.names, reason.alias("reason"), F.when(reason.isNotNull(), F.col("value")).alias("value")
    )


def counted_reasons() -> list[Column]:
    """Numbers of rows by `reason`, of those that are clean as CLEAN."""
    counts = [F.count_if(F.col("reason") == name).alias(name) for name in REASONS]
    return [F.count_if(F.col("reason").isNull()).alias("CLEAN"), *counts]


def drop_redelivered(clean: DataFrame) -> DataFrame:
    """Optional: remove copies from at-least-once delivery. A change is identified by its
    transaction and log position."""
    keys = ["tx_id", "lsn"]
    if clean.isStreaming:
        return clean.withWatermark("event_time", "10 minutes").dropDuplicatesWithinWatermark(keys)
    return clean.dropDuplicates(keys)


def encode(df: DataFrame, key: str, timestamp_format: str = C.ISO_MICROS) -> DataFrame:
    """(key, value) text pairs for a topic. Null fields are left out of the JSON."""
    body = F.to_json(F.struct(*df.columns), {"timestampFormat": timestamp_format})
    return df.select(F.col(key).cast("string").alias("key"), body.alias("value"))


def decode_flat(raw: DataFrame, schema: StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Rows encoded by `encode`; `schema` names the fields wanted, others are skipped. `keep`
    names columns of the message, such as its key, to leave in front."""
    row = _parsed_once(F.col("value").cast("string"), schema)
    return raw.select(*keep, row.alias("row")).select(*keep, "row.*")


def _checked_flat(raw: DataFrame, schema: StructType) -> DataFrame:
    """(value, row, bad): bad where the text is no JSON object of these fields."""
    checked = StructType([*schema.fields, StructField(schemas.CORRUPT, StringType())])
    text = raw.select(F.col("value").cast("string").alias("value"))
    parsed = text.select("value", _parsed_once(F.col("value"), checked).alias("row"))
    bad = F.col("row").isNull() | F.col(f"row.{schemas.CORRUPT}").isNotNull()
    return parsed.withColumn("bad", bad)


def split_undecodable(raw: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, dead letters) of a topic of flat JSON objects."""
    parsed = _checked_flat(raw, schema)
    rows = parsed.filter(~F.col("bad")).select(*[F.col(f"row.{n}").alias(n) for n in schema.names])
    return rows, parsed.filter("bad").select("value")


def _flat_reason(schema: StructType) -> Column:
    """Why a message of a topic of transactions can't be used; null for those that can. `schema` has at least tx_id."""
    def field(name: str) -> Column:
        return F.col(f"row.{name}")

    reason = F.when(F.col("value").isNull(), NULL_VALUE).when(F.col("bad"), UNDECODABLE).when(field("tx_id").isNull(), NO_TX_ID)
    if "event_time" in schema.names:
        reason = reason.when(~C.plausible_time(field("event_time")), BAD_TIME)
    if "amount" in schema.names:
        reason = reason.when(~C.fits_money(field("amount")), BAD_AMOUNT)
    return reason


def usable_flat(raw: DataFrame, schema: StructType) -> DataFrame:
    """The rows of a topic of transactions that can be used."""
    rows = _checked_flat(raw, schema).filter(_flat_reason(schema).isNull())
    return rows.select(*[F.col(f"row.{n}").alias(n) for n in schema.names])


def rejected_flat(raw: DataFrame, schema: StructType) -> DataFrame:
    """The other side of `usable_flat`: (reason, value)."""
    rows = _checked_flat(raw, schema).select(_flat_reason(schema).alias("reason"), "value")
    return rows.filter(F.col("reason").isNotNull())


def rejected_changes(raw: DataFrame, row: StructType, key: str) -> DataFrame:
    """(reason, value) of dimension change events that change nothing: unreadable or without a key."""
    decoded = decode_envelopes(raw, row)
    unreadable = F.col(schemas.CORRUPT).isNotNull() & F.col("op").isNull() & F.col(f"record.{key}").isNull()
    reason = F.when(F.col("value").isNull(), NULL_VALUE).when(unreadable, UNDECODABLE).when(
        F.col(f"record.{key}").isNull(), NO_KEY)
    return decoded.select(reason.alias("reason"), "value").filter(F.col("reason").isNotNull())
