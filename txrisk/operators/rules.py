"""Risk rules as one projection: which rules fire for an enriched transaction, and why."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions import columns as C


# --- fixed values: thresholds and message texts ------------------------------------------------
@dataclass(frozen=True)
class Thresholds:
    """A rule fires when its value is strictly greater."""

    amount: float = 10000
    tx_count: int = 5
    spend: float = 50000
    failures: int = 0


HIGH_RISK_TEXT = "⚠️  High Risk Customer: %s | Amount: %s"
VELOCITY_TEXT = "🚨 High Velocity detected: %s tx/min"
SPEND_TEXT = "💰 Spending Threshold Exceeded: %s in 5 mins"
TRAVEL_TEXT = "✈️  Impossible Travel: %s -> %s"
FAILURES_TEXT = "❌ Recent failed transactions in window: %s"
# -------------------------------------------------------------------------------------------------

HIGH_RISK_AMOUNT = "HIGH_RISK_AMOUNT"
VELOCITY = "VELOCITY"
SPEND = "SPEND"
IMPOSSIBLE_TRAVEL = "IMPOSSIBLE_TRAVEL"
RECENT_FAILURES = "RECENT_FAILURES"

ALERT, SAFE = "ALERT", "SAFE"
DEFAULT = Thresholds()


def _rules(limit: Thresholds) -> list[tuple[str, Column, str, list[Column]]]:
    """(code, condition, text, values shown), in the order alerts are listed. Absent numbers
    count as 0; an empty location is no location."""
    c = F.col

    def number(name):
        return F.coalesce(c(name), F.lit(0))

    moved = (
        (F.length("last_location") > 0) & (F.length("location") > 0)
        & (c("last_location") != c("location"))
    )
    return [
        (HIGH_RISK_AMOUNT, (c("customer_risk") == "HIGH") & (number("amount") > limit.amount),
         HIGH_RISK_TEXT, [c("customer_risk"), C.money_text(c("amount"))]),
        (VELOCITY, number("tx_count_1m") > limit.tx_count, VELOCITY_TEXT, [c("tx_count_1m")]),
        (SPEND, number("amount_sum_5m") > limit.spend,
         SPEND_TEXT, [C.money_text(c("amount_sum_5m"))]),
        (IMPOSSIBLE_TRAVEL, moved, TRAVEL_TEXT, [c("last_location"), c("location")]),
        (RECENT_FAILURES, number("failed_tx_5m") > limit.failures,
         FAILURES_TEXT, [c("failed_tx_5m")]),
    ]


def with_alerts(enriched: DataFrame, limit: Thresholds = DEFAULT) -> DataFrame:
    """Add `alerts`, the fired rules in order as (code, message), and the verdict."""
    fired = [
        F.when(condition, F.struct(
            F.lit(code).alias("code"), F.format_string(text, *values).alias("message")
        ))
        for code, condition, text, values in _rules(limit)
    ]
    return enriched.withColumn("alerts", F.array_compact(F.array(*fired))).withColumn(
        "verdict", F.when(F.size("alerts") > 0, ALERT).otherwise(SAFE)
    )


def verdicts(enriched: DataFrame, limit: Thresholds = DEFAULT) -> DataFrame:
    """One row per transaction: verdict and alerts."""
    return with_alerts(enriched, limit).select("tx_id", "account_id", "verdict", "alerts")


def alerts_only(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size("alerts") > 0)


def safe_only(judged: DataFrame) -> DataFrame:
    return judged.filter(F.size("alerts") == 0)


def alert_rows(judged: DataFrame) -> DataFrame:
    """One row per fired rule, numbered from 1 within its transaction."""
    return judged.select(
        "tx_id", "account_id", F.posexplode("alerts").alias("position", "alert")
    ).select(
        "tx_id", "account_id", (F.col("position") + 1).alias("position"),
        "alert.code", "alert.message",
    )
