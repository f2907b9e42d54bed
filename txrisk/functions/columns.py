"""Scalar column expressions for change events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: operation codes and the names given to them -------------------------------
EVENT_TYPES = {"c": "INSERT", "u": "UPDATE", "d": "DELETE", "r": "SNAPSHOT"}
UNKNOWN_EVENT = "UNKNOWN"
# ---------------------------------------------------------------------------------------------

# Money is NUMERIC(18,2) at the source. Sums are taken on whole hundredths, so they are exact and do
# not depend on the order in which partitions arrive. A decimal that fits a machine word is as fast
# as a bigint, and its sums are wider and cannot overflow.
HUNDREDTHS = "decimal(18,0)"
MONEY_LIMIT = 1e16  # amounts from here on don't fit

# Text forms. ISO keeps microseconds, unlike the JSON writer's default of milliseconds.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"


def event_type(op: Column) -> Column:
    """Readable name of an operation code; anything else, null included, is UNKNOWN."""
    name = None
    for code, label in EVENT_TYPES.items():
        name = (F if name is None else name).when(op == code, label)
    return name.otherwise(UNKNOWN_EVENT)


def row_image(op: Column, before: Column, after: Column) -> Column:
    """The image a change is about: the old row of a delete, otherwise the new row."""
    return F.when(op == "d", before).otherwise(after)


def micros_to_timestamp(text: Column, precision: str = "micros") -> Column:
    """Epoch microseconds held in text; unreadable text gives null. `precision="second"` drops
    the fraction of a second."""
    micros = text.try_cast("decimal(20,0)").try_cast("bigint")
    ts = F.timestamp_micros(micros)
    if precision == "second":
        return F.date_trunc("second", ts)
    if precision != "micros":
        raise ValueError(f"precision must be 'micros' or 'second', not {precision!r}")
    return ts


def no_money() -> Column:
    return F.lit(0).cast(HUNDREDTHS)


def spent(amount: Column, status: Column) -> Column:
    """What a transaction adds to spend, in hundredths: its amount if it succeeded, else nothing.
    Amounts that a NUMERIC(18,2) can't hold, which decoding rejects, add nothing either: NaN,
    infinities and what is larger."""
    counts = (status == "SUCCESS") & amount.isNotNull() & fits_money(amount)
    return F.when(counts, F.floor(amount * 100 + 0.5).cast(HUNDREDTHS)).otherwise(no_money())


def fits_money(amount: Column) -> Column:
    """Whether a NUMERIC(18,2) holds the amount; infinities and NaN are too large."""
    return (amount < MONEY_LIMIT) & (amount > -MONEY_LIMIT)


def plausible_time(ts: Column) -> Column:
    """Whether the time lies in the years 1 to 9999, so that windows around it can be reckoned."""
    return ts.between(F.lit("0001-01-01").cast("timestamp"), F.lit("9999-12-31").cast("timestamp"))


def units(hundredths: Column) -> Column:
    return hundredths.cast("double") / 100


def failed(status: Column) -> Column:
    return F.when(status == "FAILED", 1).otherwise(0)


def money_text(amount: Column) -> Column:
    """A two-decimal amount with at least one decimal: 52000.0, 12.3, 12.34; as it is if it has no such form."""
    exact = F.regexp_replace(amount.try_cast("decimal(38,2)").cast("string"), "0$", "")
    return F.coalesce(exact, amount.cast("string"))


def iso_text(ts: Column) -> Column:
    """ISO-8601 without zone; the fraction appears only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))
