"""Every query that is checked against SQL, by name: (spark, folder of tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.operators import asof, behavior, decode, dims, enrich, rules
from txrisk.operators.behavior import Windows
from txrisk.operators.slots import dense_cuts
from txrisk.plans import tables as T
from txrisk.schemas import CLEAN
from txrisk.session import landed as stored
from txrisk.session import shared_dir
from txrisk.sources import sinks

DAY = 24 * 3600
# The given events are sparse, so minute windows rarely hold two of an account's events. Day
# windows and lower limits make every rule fire.
DAY_WINDOWS = Windows(count=DAY, spend=5 * DAY, slide=DAY)
TEST_LIMITS = rules.Thresholds(amount=100, tx_count=5, spend=500, failures=3)

# Processing times differ from run to run and are left out of results that are compared.
PROCESSING_TIMES = ("ingest_time", "enriched_at")


def comparable(df: DataFrame) -> DataFrame:
    """Instants as zone-less timestamps, counts as bigint; processing times left out."""
    shown = []
    for field in df.schema.fields:
        if field.name in PROCESSING_TIMES:
            continue
        column = F.col(f"`{field.name}`")
        if field.dataType.typeName() == "timestamp":
            column = column.cast("timestamp_ntz").alias(field.name)
        shown.append(column)
    return df.select(*shown)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.table(spark, sf_dir, "events")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return T.clean_rows(events(spark, sf_dir))


def enriched(spark, sf_dir, tx: DataFrame, windows: Windows = behavior.DEFAULT) -> DataFrame:
    return enrich.enrich(tx, T.accounts(spark, sf_dir), T.customers(spark, sf_dir), windows)


def landed(spark: SparkSession, clean: DataFrame) -> DataFrame:
    lake = shared_dir(spark, "lake")
    sinks.write_lake(clean, lake)
    return spark.read.schema(CLEAN).parquet(lake)


# --- decode ------------------------------------------------------------------------------------

def cdc_decode_clean(spark, sf_dir):
    return comparable(decode.clean_transactions(T.transaction_envelopes(events(spark, sf_dir))))


def cdc_decode_second_precision(spark, sf_dir):
    raw = T.transaction_envelopes(events(spark, sf_dir))
    clean = decode.clean_transactions(raw, precision="second")
    return comparable(clean.select("tx_id", "event_type", "event_time", "event_date"))


def cdc_bad_records(spark, sf_dir):
    raw = T.damaged_envelopes(events(spark, sf_dir))
    bad = decode.rejected_transactions(raw).select("reason")
    good = decode.clean_transactions(raw).select(F.lit("VALID").alias("reason"))
    return good.unionByName(bad).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def clean_key_value(spark, sf_dir):
    pairs = decode.encode(transactions(spark, sf_dir), "tx_id")
    return comparable(decode.decode_flat(pairs, CLEAN, keep=["key"]))


def lake_partition_counts(spark, sf_dir):
    lake = landed(spark, transactions(spark, sf_dir))
    return lake.groupBy("event_date").agg(F.count(F.lit(1)).alias("n"))


# --- dimension state ---------------------------------------------------------------------------

def account_state_changes(spark, sf_dir):
    raw = T.account_envelopes(T.table(spark, sf_dir, "orders"))
    return comparable(dims.account_changes(raw).select(*dims.ACCOUNT_STATE, "ts_ms", "lsn"))


def account_state_latest(spark, sf_dir):
    raw = T.account_envelopes(T.table(spark, sf_dir, "orders"))
    latest = dims.latest_state(dims.account_changes(raw), "account_id")
    return comparable(latest.select(*dims.ACCOUNT_STATE))


def customer_state_latest(spark, sf_dir):
    raw = T.customer_envelopes(T.table(spark, sf_dir, "orders"))
    latest = dims.latest_state(dims.customer_changes(raw), "customer_id")
    return comparable(latest.select(*dims.CUSTOMER_STATE))


# --- behaviour ---------------------------------------------------------------------------------

def velocity_tumbling_1m(spark, sf_dir):
    return comparable(behavior.tumbling_counts(transactions(spark, sf_dir)))


def velocity_tumbling_inserts(spark, sf_dir):
    tx = transactions(spark, sf_dir)
    return comparable(behavior.tumbling_counts(tx, event_types=["INSERT"]))


def spend_fail_sliding_5m(spark, sf_dir):
    return comparable(behavior.sliding_spend(transactions(spark, sf_dir)))


def behavior_latest(spark, sf_dir):
    return comparable(behavior.latest_behavior(transactions(spark, sf_dir)))


def behavior_latest_days(spark, sf_dir):
    return comparable(behavior.latest_behavior(transactions(spark, sf_dir), DAY_WINDOWS))


def behavior_trailing(spark, sf_dir):
    rows = behavior.trailing_features(transactions(spark, sf_dir))
    return rows.select("tx_id", *behavior.FEATURES)


def behavior_trailing_days(spark, sf_dir):
    rows = behavior.trailing_features(transactions(spark, sf_dir), DAY_WINDOWS)
    return rows.select("tx_id", *behavior.FEATURES)


def behavior_trailing_dense(spark, sf_dir):
    """With slots of a year, cut where an account has more than ten transactions in one."""
    tx = transactions(spark, sf_dir)
    windows = Windows(count=DAY, spend=5 * DAY, slide=DAY, slot=365 * DAY)
    cuts = stored(behavior.dense_account_cuts(tx, windows, most_rows=10), "cuts")
    return behavior.trailing_features(tx, windows, cuts=cuts).select("tx_id", "last_location", *behavior.FEATURES)


def behavior_asof_ttl(spark, sf_dir):
    rows = behavior.fresh_previous_behavior(transactions(spark, sf_dir))
    return rows.select("tx_id", "previous_found", *[f"previous_{n}" for n in behavior.FEATURES])


def last_location(spark, sf_dir):
    rows = behavior.trailing_features(transactions(spark, sf_dir))
    return rows.select("tx_id", "account_id", "location", "last_location")


# --- joins -------------------------------------------------------------------------------------

def dim_enrich(spark, sf_dir):
    rows = enrich.add_profiles(
        transactions(spark, sf_dir), T.accounts(spark, sf_dir), T.customers(spark, sf_dir)
    )
    return comparable(rows.select("tx_id", "account_id", *enrich.PROFILE))


def dim_asof(spark, sf_dir):
    return _dim_asof(spark, sf_dir)


def _dim_asof(spark, sf_dir, **slots):
    orders = T.table(spark, sf_dir, "orders")
    lines = T.table(spark, sf_dir, "lineitem").join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey"
    ).select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "l_shipdate")
    versions = orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority")
    found = asof.asof_join(
        lines, versions, "o_custkey", "l_shipdate", "o_orderdate", ["o_orderkey"], **slots
    )
    return found.select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "l_shipdate",
        F.col("version.o_orderkey").alias("version_orderkey"),
        F.col("version.o_orderdate").alias("version_date"),
        F.col("version.o_orderpriority").alias("version_priority"),
    )


def dim_asof_dense(spark, sf_dir):
    """As `dim_asof`, with slots of ten years, cut where a customer has more than ten orders in one."""
    orders = T.table(spark, sf_dir, "orders")
    at = F.unix_micros(F.col("o_orderdate").cast("timestamp"))
    cuts = stored(dense_cuts(orders, "o_custkey", at, 3650 * DAY, 10), "cuts")
    return _dim_asof(spark, sf_dir, slot=3650 * DAY, cuts=cuts)


def dim_enrich_asof(spark, sf_dir):
    """Account and customer versions valid at each transaction's time."""
    rows = enrich.add_profiles_as_of(
        transactions(spark, sf_dir).select("tx_id", "account_id", "event_time"),
        T.signup_account_changes(events(spark, sf_dir)),
        T.view_customer_changes(events(spark, sf_dir)),
    )
    return comparable(rows.select("tx_id", "account_id", *enrich.PROFILE))


def behavior_asof_join(spark, sf_dir):
    """Freshness by the general as-of join: the latest earlier behaviour row under 600 s old."""
    rows = stored(behavior.trailing_features(transactions(spark, sf_dir)).select(
        "tx_id", "account_id", "event_time", *behavior.FEATURES
    ), "features")
    versions = rows.select("account_id", "event_time", *behavior.FEATURES)
    found = asof.asof_join(
        rows.select("tx_id", "account_id", "event_time"), versions, "account_id",
        "event_time", "event_time", strict=True, within=600,
    )
    return found.select("tx_id", *[
        F.col(f"version.{n}").alias(f"previous_{n}") for n in behavior.FEATURES
    ])


# --- enriched rows and verdicts ------------------------------------------------------------------

def enriched_full(spark, sf_dir):
    """From change events. They are decoded once and landed in the lake; enrichment reads that."""
    clean = decode.clean_transactions(T.transaction_envelopes(events(spark, sf_dir)))
    return comparable(enriched(spark, sf_dir, landed(spark, clean)))


def wire_format_text(spark, sf_dir):
    """Times of the enriched rows as the text their consumers read."""
    rows = enrich.wire_format(enriched(spark, sf_dir, transactions(spark, sf_dir)))
    return rows.select("tx_id", "event_time", "event_date", "account_updated_at", "customer_updated_at")


def redelivered_once(spark, sf_dir):
    """Clean rows of which half are delivered again, some of them twice, each kept once."""
    rows = transactions(spark, sf_dir)
    k = F.substring("merchant", 2, 9).cast("int")
    again = rows.unionByName(rows.filter(k >= 50)).unionByName(rows.filter(k >= 90))
    return comparable(decode.drop_redelivered(again))


def judged(spark, sf_dir):
    rows = enriched(spark, sf_dir, transactions(spark, sf_dir), DAY_WINDOWS)
    return rules.verdicts(rows, TEST_LIMITS)


def flat_verdicts(verdicts: DataFrame) -> DataFrame:
    codes = F.array_join(F.transform("alerts", lambda a: a["code"]), ",")
    return verdicts.select("tx_id", "account_id", "verdict", codes.alias("codes"))


def risk_verdicts(spark, sf_dir):
    return flat_verdicts(judged(spark, sf_dir))


def risk_verdicts_default(spark, sf_dir):
    rows = enriched(spark, sf_dir, transactions(spark, sf_dir))
    return flat_verdicts(rules.verdicts(rows))


def risk_alert_rows(spark, sf_dir):
    return rules.alert_rows(judged(spark, sf_dir))


BATCH: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        cdc_decode_clean, cdc_decode_second_precision, cdc_bad_records, clean_key_value,
        lake_partition_counts,
        account_state_changes, account_state_latest, customer_state_latest,
        velocity_tumbling_1m, velocity_tumbling_inserts, spend_fail_sliding_5m,
        behavior_latest, behavior_latest_days, behavior_trailing, behavior_trailing_days, behavior_trailing_dense,
        behavior_asof_ttl, behavior_asof_join, last_location,
        dim_enrich, dim_asof, dim_asof_dense, dim_enrich_asof, enriched_full, wire_format_text,
        redelivered_once,
        risk_verdicts, risk_verdicts_default, risk_alert_rows,
    )
}
