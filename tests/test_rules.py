import pytest

from txrisk import schemas
from txrisk.operators import rules

QUIET = {
    "tx_id": 1, "account_id": 2, "amount": 50.0, "location": "Hue", "customer_risk": "LOW",
    "tx_count_1m": 1, "amount_sum_5m": 50.0, "failed_tx_5m": 0, "last_location": "Hue",
}


def judge(spark, limit=rules.DEFAULT, **changes):
    row = {**QUIET, **changes}
    df = spark.createDataFrame(
        [tuple(row[n] for n in schemas.ENRICHED_WIRE.names)], schemas.ENRICHED_WIRE
    )
    [got] = rules.verdicts(df, limit).collect()
    assert got.verdict == ("ALERT" if got.alerts else "SAFE")
    return [a.code for a in got.alerts]


@pytest.mark.parametrize("changes,codes", [
    ({}, []),
    ({"customer_risk": "HIGH", "amount": 10000.0}, []),
    ({"customer_risk": "HIGH", "amount": 10000.01}, [rules.HIGH_RISK_AMOUNT]),
    ({"customer_risk": "LOW", "amount": 99999.0}, []),
    ({"customer_risk": None, "amount": 99999.0}, []),
    ({"customer_risk": "HIGH", "amount": None}, []),
    ({"tx_count_1m": 5}, []),
    ({"tx_count_1m": 6}, [rules.VELOCITY]),
    ({"tx_count_1m": None}, []),
    ({"amount_sum_5m": 50000.0}, []),
    ({"amount_sum_5m": 50000.01}, [rules.SPEND]),
    ({"amount_sum_5m": None}, []),
    ({"last_location": "Dubai"}, [rules.IMPOSSIBLE_TRAVEL]),
    ({"last_location": None}, []),
    ({"last_location": ""}, []),
    ({"location": ""}, []),
    ({"location": None}, []),
    ({"last_location": "hue"}, [rules.IMPOSSIBLE_TRAVEL]),
    ({"failed_tx_5m": 1}, [rules.RECENT_FAILURES]),
    ({"failed_tx_5m": None}, []),
])
def test_edges(spark, changes, codes):
    assert judge(spark, **changes) == codes


def test_thresholds_are_parameters(spark):
    limit = rules.Thresholds(amount=10, tx_count=0, spend=10, failures=-1)
    assert judge(spark, limit, customer_risk="HIGH", last_location="X") == [
        rules.HIGH_RISK_AMOUNT, rules.VELOCITY, rules.SPEND, rules.IMPOSSIBLE_TRAVEL,
        rules.RECENT_FAILURES,
    ]


def test_messages_and_rows_in_rule_order(spark):
    row = {**QUIET, "customer_risk": "HIGH", "amount": 15000000.5, "tx_count_1m": 7,
           "amount_sum_5m": 52000.0, "failed_tx_5m": 2, "last_location": "Dubai"}
    df = spark.createDataFrame(
        [tuple(r[n] for n in schemas.ENRICHED_WIRE.names) for r in (row, {**QUIET, "tx_id": 9})],
        schemas.ENRICHED_WIRE,
    )
    judged = rules.verdicts(df)
    rows = rules.alert_rows(judged).orderBy("position").collect()
    assert [(r.tx_id, r.position, r.message.split(" ", 1)[1].strip()) for r in rows] == [
        (1, 1, "High Risk Customer: HIGH | Amount: 15000000.5"),
        (1, 2, "High Velocity detected: 7 tx/min"),
        (1, 3, "Spending Threshold Exceeded: 52000.0 in 5 mins"),
        (1, 4, "Impossible Travel: Dubai -> Hue"),
        (1, 5, "Recent failed transactions in window: 2"),
    ]
    assert [r.tx_id for r in rules.alerts_only(judged).collect()] == [1]
    assert [r.tx_id for r in rules.safe_only(judged).collect()] == [9]
