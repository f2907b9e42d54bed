"""The given tables read as transactions, dimensions and change events.

`events` are the transactions; `k`, the number in its `props`, stands in for what the table lacks
(operation, location, merchant). `customer` is the account dimension and `nation` the customer
dimension. `orders` is a change log: many versions per `o_custkey`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions import columns as C
from txrisk.schemas import ACCOUNT_ROW, CLEAN, CUSTOMER_ROW, TRANSACTION_ROW


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def k_of_props() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def _op() -> Column:
    k = F.col("k")
    return (
        F.when(k < 5, "d").when(k < 10, "u").when(k < 15, "r").when(k < 20, "x")
        .when(k < 25, F.lit(None).cast("string")).otherwise("c")
    )


def _location() -> Column:
    k = F.col("k")
    place = F.concat(F.lit("LOC_"), F.floor(k / 20).cast("string"))
    return F.when(k >= 95, F.lit("")).when(k != 50, place)


def transaction_rows(events: DataFrame) -> DataFrame:
    """Row images of the transactions, as text where the wire has text, and their operation."""
    return events.withColumn("k", k_of_props()).select(
        F.col("event_id").alias("tx_id"),
        F.col("user_id").try_cast("int").alias("account_id"),
        F.col("value").cast("decimal(18,2)").cast("string").alias("amount"),
        F.lit("VND").alias("currency"),
        F.upper("event_type").alias("tx_type"),
        F.concat(F.lit("M"), F.col("k").cast("string")).alias("merchant"),
        F.concat(F.lit("D"), F.col("user_id").cast("string")).alias("device_id"),
        F.lit(None).cast("string").alias("ip_address"),
        _location().alias("location"),
        F.when(F.col("event_type") == "error", "FAILED").otherwise("SUCCESS").alias("status"),
        F.unix_micros(F.col("ts").cast("timestamp")).cast("string").alias("created_at"),
        _op().alias("op"), F.col("k"),
    )


def _envelope(row_names: list[str], table_name: str, lsn: Column, ts_ms: Column) -> Column:
    """Change event as JSON text: `before` for a delete, `after` for everything else."""
    row = F.struct(*row_names)
    deleted = F.coalesce(F.col("op") == "d", F.lit(False))
    source = F.struct(F.lit(table_name).alias("table"), lsn.alias("lsn"))
    payload = F.struct(
        F.when(deleted, row).alias("before"), F.when(~deleted, row).alias("after"),
        source.alias("source"), F.col("op"), ts_ms.alias("ts_ms"),
    )
    return F.to_json(F.struct(payload.alias("payload")))


def transaction_envelopes(events: DataFrame) -> DataFrame:
    rows = transaction_rows(events)
    value = _envelope(
        TRANSACTION_ROW.names, "transactions", F.col("tx_id"),
        F.floor(F.col("created_at").cast("bigint") / 1000),
    )
    return rows.select(value.alias("value"))


def damaged_envelopes(events: DataFrame) -> DataFrame:
    """The same change events with faults put in by `k`."""
    k = F.col("k")
    rows = (
        transaction_rows(events)
        .withColumn("tx_id", F.when(k != 27, F.col("tx_id")))
        .withColumn("amount", F.when(k == 28, "abc").otherwise(F.col("amount")))
        .withColumn("account_id", F.when(~k.isin(0, 29), F.col("account_id")))
    )
    value = _envelope(
        TRANSACTION_ROW.names, "transactions", F.col("tx_id"), F.lit(0).cast("bigint")
    )
    broken = F.when(k == 25, "{not json").when(k != 26, value)
    return rows.select(broken.alias("value"))


def damaged_messages(events: DataFrame) -> DataFrame:
    """(key, value) of the clean topic, with faults put in by `k`."""
    rows = clean_rows(events).withColumn("k", F.substring("merchant", 2, 9).cast("int"))
    k = F.col("k")
    rows = (
        rows.withColumn("tx_id", F.when(k != 27, F.col("tx_id")))
        .withColumn("amount", F.when(k == 28, 1e17).otherwise(F.col("amount")))
    )
    pairs = rows.select("k", F.col("tx_id").cast("string").alias("key"), F.to_json(
        F.struct(*CLEAN.names), {"timestampFormat": C.ISO_MICROS}).alias("value"))
    broken = F.when(k == 25, "[1").when(k == 29, F.concat(F.lit('{"tx_id":'), F.lit('"x"}'))).when(k != 26, F.col("value"))
    return pairs.select("key", broken.alias("value"))


def with_outliers(clean: DataFrame) -> DataFrame:
    """Clean rows of which some, by `k`, are dated 400 days or 40 years ahead, 20 years back or not at all, or have
    an amount that no account holds."""
    k = F.substring("merchant", 2, 9).cast("int")
    at = F.col("event_time")
    moved = (
        F.when(k == 30, at + F.expr("INTERVAL 400 DAYS")).when(k == 31, at + F.expr("INTERVAL 14600 DAYS"))
        .when(k == 32, at - F.expr("INTERVAL 7300 DAYS")).when(k != 33, at)
    )
    huge = F.when(k == 34, 2e16).when(k == 35, float("nan")).otherwise(F.col("amount"))
    return clean.withColumns({"event_time": moved, "event_date": F.to_date(moved), "amount": huge})


def clean_rows(events: DataFrame) -> DataFrame:
    """The clean transactions of `transaction_envelopes`, without the way through JSON."""
    rows = transaction_rows(events)
    ts = F.timestamp_micros(F.col("created_at").cast("bigint"))
    deleted = F.coalesce(F.col("op") == "d", F.lit(False))
    return rows.select(
        *[c for c in TRANSACTION_ROW.names if c not in ("amount", "created_at")],
        F.when(~deleted, F.col("amount").cast("double")).alias("amount"),
        C.event_type(F.col("op")).alias("event_type"),
        ts.alias("event_time"), F.to_date(ts).alias("event_date"),
        F.current_timestamp().alias("ingest_time"), deleted.alias("is_deleted"),
        F.lit("debezium").alias("cdc_source"), F.lit("transactions").alias("table"),
        F.col("tx_id").alias("lsn"),
    ).select(*CLEAN.names)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts under their own ids, those overdrawn under negative ones: transactions of these stay unmatched."""
    gone = F.col("c_acctbal") > 9900
    held = F.coalesce(F.col("c_acctbal") >= 0, F.lit(False))
    key = F.col("c_custkey").try_cast("int")
    return table(spark, sf_dir, "customer").select(
        F.when(held, key).otherwise(-key).alias("account_id"),
        F.col("c_nationkey").alias("customer_id"),
        F.col("c_mktsegment").alias("account_type"),
        F.when(gone, "DELETED").when(F.col("c_acctbal") < 1000, "FROZEN").otherwise("ACTIVE")
        .alias("status"),
        gone.alias("is_deleted"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("c_custkey")).alias("updated_at"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers by nation; one region has no risk level. Nation 0 is no valid customer id."""
    region = F.col("n_regionkey")
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("customer_id"),
        F.when(region == 0, "HIGH").when(region == 1, "MEDIUM").when(region > 2, "LOW")
        .alias("risk_level"),
        F.lit(False).alias("is_deleted"),
        F.timestamp_seconds(F.lit(1_690_000_000) + F.col("n_nationkey")).alias("updated_at"),
    )


def _order_changes(orders: DataFrame) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    level = F.split_part(priority, F.lit("-"), F.lit(2))
    return orders.select(
        F.when(priority == "4-NOT SPECIFIED", F.lit(None).cast("string"))
        .when(status == "P", "d").when(status == "F", "c").otherwise("u").alias("op"),
        F.col("o_custkey").try_cast("int").alias("changed_key"),
        F.col("o_orderkey").try_cast("int").alias("version"),
        F.when(level != "NOT SPECIFIED", level).alias("level"),
        status.alias("kind"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
    )


def _as_row(df: DataFrame, names: list[str], **given: Column) -> DataFrame:
    blank = F.lit(None).cast("string")
    return df.select("op", "version", "ts_ms", *[given.get(n, blank).alias(n) for n in names])


def _account_images(orders: DataFrame) -> DataFrame:
    return _as_row(
        _order_changes(orders), ACCOUNT_ROW.names,
        account_id=F.col("changed_key"), customer_id=F.col("version"),
        account_type=F.col("kind"), status=F.col("level"),
    )


def _account_event() -> Column:
    return _envelope(ACCOUNT_ROW.names, "account", F.col("version"), F.col("ts_ms"))


def account_envelopes(orders: DataFrame) -> DataFrame:
    return _account_images(orders).select(_account_event().alias("value"))


def damaged_account_envelopes(orders: DataFrame) -> DataFrame:
    """The account changes, with faults put in by the last digit of the order's number."""
    digit = F.col("version") % 10
    rows = _account_images(orders).withColumn("account_id", F.when(digit != 1, F.col("account_id")))
    broken = F.when(digit == 2, "{not json").when(digit != 3, _account_event())
    return rows.select(broken.alias("value"))


def customer_envelopes(orders: DataFrame) -> DataFrame:
    rows = _as_row(
        _order_changes(orders), CUSTOMER_ROW.names,
        customer_id=F.col("changed_key"), risk_level=F.col("level"),
    )
    value = _envelope(CUSTOMER_ROW.names, "customer", F.col("version"), F.col("ts_ms"))
    return rows.select(value.alias("value"))


def signup_account_changes(events: DataFrame) -> DataFrame:
    """Signup events read as account changes, in the time range of the transactions."""
    return events.filter(F.col("event_type") == "signup").withColumn("k", k_of_props()).select(
        F.col("user_id").try_cast("int").alias("account_id"), F.col("k").alias("customer_id"),
        F.lit("CARD").alias("account_type"),
        F.when(F.col("value") > 50, "FROZEN").otherwise("ACTIVE").alias("status"),
        F.lit(False).alias("is_deleted"), F.col("ts").cast("timestamp").alias("updated_at"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        F.col("event_id").alias("lsn"),
    )


def view_customer_changes(events: DataFrame) -> DataFrame:
    """View events read as changes of customer `k`."""
    return events.filter(F.col("event_type") == "view").withColumn("k", k_of_props()).select(
        F.col("k").alias("customer_id"),
        F.when(F.col("value") > 50, "HIGH").when(F.col("value") > 10, "LOW").alias("risk_level"),
        F.lit(False).alias("is_deleted"), F.col("ts").cast("timestamp").alias("updated_at"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
        F.col("event_id").alias("lsn"),
    )
