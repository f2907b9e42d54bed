import datetime
import json

import pytest
from pyspark.sql import functions as F

from txrisk import schemas
from txrisk.operators import decode, dims

UTC = datetime.timezone.utc

ROW = {
    "tx_id": 31, "account_id": 1, "amount": "2750000.00", "currency": "VND",
    "tx_type": "PAYMENT", "merchant": "Corner Shop", "device_id": "PHONE_7",
    "ip_address": "192.0.2.17", "location": "Nantes", "status": "SUCCESS",
    "created_at": 1771234567890123,
}


def event(op="c", before=None, after=None, table="transactions", lsn=4711, ts_ms=1771234567911):
    return json.dumps({
        "schema": {"type": "struct", "optional": False},
        "payload": {
            "before": before, "after": after, "op": op, "ts_ms": ts_ms,
            "source": {"version": "2.6", "table": table, "lsn": lsn}, "transaction": None,
        },
    })


def messages(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def clean(spark, *values, **options):
    return decode.clean_transactions(messages(spark, *values), **options).collect()


def test_sample_transaction(spark):
    [row] = clean(spark, event(after=ROW))
    assert row.asDict().keys() == set(schemas.CLEAN.names)
    assert (row.tx_id, row.account_id, row.amount) == (31, 1, 2750000.0)
    assert (row.event_type, row.is_deleted, row.cdc_source) == ("INSERT", False, "debezium")
    assert (row.table, row.lsn) == ("transactions", 4711)
    assert row.event_date == datetime.date(2026, 2, 16)


def test_column_types_and_order(spark):
    got = decode.clean_transactions(messages(spark, event(after=ROW))).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in schemas.CLEAN]


@pytest.mark.parametrize("precision,micros", [("micros", 890123), ("second", 0)])
def test_event_time_precision(spark, precision, micros):
    df = decode.clean_transactions(messages(spark, event(after=ROW)), precision)
    [(text,)] = df.select(F.date_format("event_time", "HH:mm:ss.SSSSSS")).collect()
    assert text == f"09:36:07.{micros:06d}"


def test_unknown_precision_is_refused(spark):
    with pytest.raises(ValueError):
        clean(spark, event(after=ROW), precision="day")


@pytest.mark.parametrize("op,name", [
    ("c", "INSERT"), ("u", "UPDATE"), ("r", "SNAPSHOT"), ("x", "UNKNOWN"), (None, "UNKNOWN"),
])
def test_operation_takes_after_image(spark, op, name):
    [row] = clean(spark, event(op, before={**ROW, "tx_id": 1}, after=ROW))
    assert (row.event_type, row.tx_id, row.amount) == (name, 31, 2750000.0)


def test_delete_takes_before_image_and_needs_only_its_key(spark):
    rows = clean(spark, event("d", before=ROW), event("d", before={"tx_id": 5}))
    assert [(r.tx_id, r.account_id, r.amount, r.is_deleted) for r in rows] == [
        (31, 1, None, True), (5, None, None, True)
    ]


def test_id_above_32_bits(spark):
    [row] = clean(spark, event(after={**ROW, "tx_id": 2**31 + 7}))
    assert row.tx_id == 2**31 + 7


def test_invalid_messages_are_left_out_with_a_reason(spark):
    bad = {
        None: decode.NULL_VALUE,
        "{oops": decode.UNDECODABLE,
        event(after={**ROW, "tx_id": None}): decode.NO_TX_ID,
        event(after=None): decode.NO_TX_ID,
        event("d", before=None): decode.NO_TX_ID,
        event(after={**ROW, "account_id": None}): decode.NO_ACCOUNT,
        event(after={**ROW, "amount": "abc"}): decode.NO_AMOUNT,
        event("u", after={**ROW, "amount": None}): decode.NO_AMOUNT,
    }
    raw = messages(spark, *bad, event(after=ROW))
    assert decode.clean_transactions(raw).count() == 1
    rejected = decode.rejected_transactions(raw).collect()
    assert {r.value: r.reason for r in rejected} == bad


def test_valid_and_rejected_partition_the_input(spark):
    values = [event(op, b, a) for op in ("c", "d", None) for b in (None, ROW, {"tx_id": 2})
              for a in (None, ROW, {"tx_id": 3})]
    raw = messages(spark, *values, None, "[]", "3", "null", "")
    n_good = decode.clean_transactions(raw).count()
    n_bad = decode.rejected_transactions(raw).count()
    assert n_good + n_bad == len(values) + 5


def test_unreadable_time_is_null(spark):
    [row] = clean(spark, event(after={**ROW, "created_at": "soon"}))
    assert row.event_time is None and row.event_date is None


def test_bytes_are_decoded(spark):
    raw = messages(spark, event(after=ROW)).withColumn("value", F.col("value").cast("binary"))
    assert decode.clean_transactions(raw).count() == 1


def test_encode_round_trip_keeps_microseconds_and_omits_nulls(spark):
    raw = messages(spark, event(after={**ROW, "merchant": None}))
    df = decode.clean_transactions(raw)
    pairs = decode.encode(df, "tx_id")
    [pair] = pairs.collect()
    assert pair.key == "31" and "merchant" not in json.loads(pair.value)
    back = decode.decode_flat(pairs, schemas.CLEAN).drop("ingest_time").collect()
    assert back == df.drop("ingest_time").collect()


def test_redelivered_changes(spark):
    one = event(after=ROW)
    twice = decode.clean_transactions(messages(spark, one, one, event("u", after=ROW, lsn=9)))
    assert decode.drop_redelivered(twice).count() == 2


def test_split_undecodable(spark):
    raw = messages(spark, '{"tx_id": 1, "amount": 2.5}', "{bad", "7", None)
    rows, dead = decode.split_undecodable(raw, schemas.ENRICHED_WIRE)
    assert [(r.tx_id, r.amount) for r in rows.collect()] == [(1, 2.5)]
    assert {r.value for r in dead.collect()} == {"{bad", "7", None}


ACCOUNT = {
    "account_id": 12, "customer_id": 4, "account_type": "CARD", "balance": "4250000.00",
    "status": "ACTIVE", "created_at": 1771300000654321, "updated_at": 1771300000654321,
}


def test_sample_account(spark):
    value = event(after=ACCOUNT, table="account", lsn=4722, ts_ms=1771300000777)
    df = dims.account_changes(messages(spark, value))
    [row] = df.withColumn("text", F.date_format("updated_at", "HH:mm:ss.SSS")).collect()
    assert (row.account_id, row.customer_id, row.account_type, row.status) == (
        12, 4, "CARD", "ACTIVE"
    )
    assert row.is_deleted is False and row.text == "03:46:40.777"


def test_latest_account_state_keeps_deleted_keys(spark):
    values = [
        event(after=ACCOUNT, ts_ms=1000, lsn=1),
        event("u", after={**ACCOUNT, "status": "FROZEN"}, ts_ms=2000, lsn=2),
        event("d", before={"account_id": 12}, ts_ms=2000, lsn=3),
        event("c", after={**ACCOUNT, "account_id": 13}, ts_ms=1, lsn=4),
        event("c", after={**ACCOUNT, "account_id": None}, ts_ms=1, lsn=4),
    ]
    changes = dims.account_changes(messages(spark, *values))
    rows = {r.account_id: r for r in dims.latest_state(changes, "account_id").collect()}
    assert rows.keys() == {12, 13}
    assert (rows[12].status, rows[12].is_deleted, rows[12].customer_id) == ("DELETED", True, None)
    assert rows[13].status == "ACTIVE"


def test_customer_state_with_null_operation(spark):
    value = event(None, after={"customer_id": 1, "risk_level": None})
    [row] = dims.customer_changes(messages(spark, value)).collect()
    assert (row.customer_id, row.risk_level, row.is_deleted) == (1, None, None)


@pytest.mark.parametrize("change, reason", [
    ({"amount": "1e40"}, decode.BAD_AMOUNT), ({"amount": "Infinity"}, decode.BAD_AMOUNT), ({"amount": "NaN"}, decode.BAD_AMOUNT),
    ({"amount": "1e16"}, decode.BAD_AMOUNT), ({"created_at": 2**63 - 1}, decode.BAD_TIME), ({"created_at": -(2**63)}, decode.BAD_TIME),
])
def test_impossible_amounts_and_times_are_dead_letters(spark, change, reason):
    value = event(after={**ROW, **change})
    assert clean(spark, value) == []
    [row] = decode.rejected_transactions(messages(spark, value)).collect()
    assert (row.reason, row.value) == (reason, value)


def test_money_of_any_size_has_a_text_and_counts(spark):
    from txrisk.functions import columns as C

    df = spark.createDataFrame([(v,) for v in (52000.0, 1e40, float("inf"), float("nan"), -1e40)], "amount double")
    got = df.select(C.money_text(F.col("amount")).alias("t"), C.spent(F.col("amount"), F.lit("SUCCESS")).alias("s")).collect()
    assert got[0].t == "52000.0" and got[2].t == "Infinity" and all(r.t for r in got)
    # What a NUMERIC(18,2) can't hold adds nothing.
    assert [r.s for r in got] == [5200000, 0, 0, 0, 0]
