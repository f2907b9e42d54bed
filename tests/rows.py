"""Small clean transactions for tests, and the features they should get, worked out row by row."""

from __future__ import annotations

import datetime

from txrisk.schemas import CLEAN

T0 = datetime.datetime(2025, 12, 29, 11, 30, 0, tzinfo=datetime.timezone.utc)


def at(seconds: float) -> datetime.datetime:
    return T0 + datetime.timedelta(seconds=seconds)


def tx(tx_id, account, seconds, amount=10.0, status="SUCCESS", location="Hue",
       event_type="INSERT", lsn=None):
    time = None if seconds is None else at(seconds)
    return {
        "tx_id": tx_id, "account_id": account, "amount": amount, "currency": "VND",
        "tx_type": "TRANSFER", "merchant": "Shop", "device_id": "D1", "ip_address": "10.0.0.1",
        "location": location, "status": status, "event_type": event_type,
        "event_time": time, "event_date": None if time is None else time.date(),
        "ingest_time": T0, "is_deleted": event_type == "DELETE", "cdc_source": "debezium",
        "table": "transactions", "lsn": tx_id if lsn is None else lsn,
    }


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[n] for n in CLEAN.names) for r in rows], CLEAN)


def expected(rows, count=60, spend=300, types=None):
    """tx_id -> (count, spend, failures, last location), by comparing all pairs of rows."""
    out = {}
    timed = [r for r in rows if r["account_id"] is not None and r["event_time"] is not None]
    for r in rows:
        if r not in timed:
            out[r["tx_id"]] = (0, 0.0, 0, None)
            continue
        same = [o for o in timed if o["account_id"] == r["account_id"]]

        def inside(seconds):
            low = r["event_time"] - datetime.timedelta(seconds=seconds)
            return [
                o for o in same if low <= o["event_time"] <= r["event_time"]
                and (types is None or o["event_type"] in types)
            ]

        def place(o):
            return (o["event_time"], o["tx_id"], o["lsn"])

        before = sorted((o for o in same if place(o) < place(r)), key=place)
        paid = sum(round((o["amount"] or 0) * 100) for o in inside(spend)
                   if o["status"] == "SUCCESS")
        out[r["tx_id"]] = (
            len(inside(count)), paid / 100,
            sum(o["status"] == "FAILED" for o in inside(spend)),
            before[-1]["location"] if before else None,
        )
    return out
