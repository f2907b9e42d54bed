"""Per-account behaviour: window tables, latest row, and trailing features at each event."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions import columns as C
from txrisk.operators.slots import MICROS, carry_in, dense_cuts, slot_of, slot_start, with_cuts


@dataclass(frozen=True)
class Windows:
    """Lengths in seconds. `slot` only sets how work is split; it never changes a result."""

    count: int = 60
    spend: int = 300
    slide: int = 60
    freshness: int = 600
    slot: int = 900


DEFAULT = Windows()


def with_watermark(clean: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Late rows: those further behind than `delay` may be left out of window tables."""
    return clean.withWatermark("event_time", delay)


def _counted(tx: DataFrame, event_types: Sequence[str] | None) -> DataFrame:
    """Rows that count as behaviour. Every event type does unless told otherwise; rows without
    an account (a delete may carry its key only) belong to no one."""
    tx = tx.filter(F.col("account_id").isNotNull())
    return tx.filter(F.col("event_type").isin(*event_types)) if event_types else tx


def _flat(df: DataFrame, *values: str) -> DataFrame:
    return df.select(
        "account_id", F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"), *values,
    )


def tumbling_counts(
    tx: DataFrame, windows: Windows = DEFAULT, event_types: Sequence[str] | None = None
) -> DataFrame:
    """Events per account in fixed windows: cnt_1m."""
    window = F.window("event_time", f"{windows.count} seconds")
    grouped = _counted(tx, event_types).groupBy("account_id", window)
    return _flat(grouped.agg(F.count(F.lit(1)).alias("cnt_1m")), "cnt_1m")


PANE = ("cnt", "spend", "failures")


def panes(
    tx: DataFrame, windows: Windows = DEFAULT, event_types: Sequence[str] | None = None
) -> DataFrame:
    """One row per account and slide step: rows, spend in hundredths, failures. All window tables
    are sums of these."""
    return (
        _counted(tx, event_types)
        .groupBy("account_id", F.window("event_time", f"{windows.slide} seconds"))
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.sum(C.spent(F.col("amount"), F.col("status"))).alias("spend"),
            F.sum(C.failed(F.col("status"))).alias("failures"),
        )
        .select("account_id", F.col("window.start").alias("pane"), *PANE)
    )


def counts_of(panes: DataFrame, windows: Windows = DEFAULT) -> DataFrame:
    """cnt_1m of fixed windows, from panes that they are made up of."""
    if windows.count % windows.slide:
        raise ValueError("a count window must be a whole number of slide steps")
    grouped = panes.groupBy("account_id", F.window("pane", f"{windows.count} seconds"))
    return _flat(grouped.agg(F.sum("cnt").alias("cnt_1m")), "cnt_1m")


def sums_of(panes: DataFrame, windows: Windows = DEFAULT) -> DataFrame:
    """sum_5m and fail_5m of sliding windows, from panes. Copying into the windows that cover a row
    happens to panes, not to transactions."""
    length, slide = f"{windows.spend} seconds", f"{windows.slide} seconds"
    grouped = panes.groupBy("account_id", F.window("pane", length, slide))
    sums = C.units(F.sum("spend")).alias("sum_5m"), F.sum("failures").alias("fail_5m")
    return _flat(grouped.agg(*sums), "sum_5m", "fail_5m")


def latest_of(panes: DataFrame, windows: Windows = DEFAULT) -> DataFrame:
    """One row per account: the counters of the windows its latest pane is in.

    Of the sliding windows over that pane, the one that ends soonest is taken, because it holds
    most history. Needs `count == slide`, the default.
    """
    if windows.count != windows.slide:
        raise ValueError("the latest row is defined for count windows of one slide step")
    # At most one pane per account and slide step is ordered here, whatever the number of rows.
    marked = panes.withColumn("latest", F.max("pane").over(Window.partitionBy("account_id")))
    oldest = F.col("latest") - F.make_dt_interval(secs=F.lit(windows.spend - windows.slide))
    return (
        marked.filter(F.col("pane") >= oldest)
        .groupBy("account_id", "latest")
        .agg(
            F.sum(F.when(F.col("pane") == F.col("latest"), F.col("cnt"))).alias("tx_count_1m"),
            C.units(F.sum("spend")).alias("amount_sum_5m"),
            F.sum("failures").alias("failed_tx_5m"),
        )
        .withColumnRenamed("latest", "updated_at")
    )


def sliding_spend(
    tx: DataFrame, windows: Windows = DEFAULT, event_types: Sequence[str] | None = None
) -> DataFrame:
    """Successful amount and failures per account in sliding windows: sum_5m, fail_5m."""
    return sums_of(panes(tx, windows, event_types), windows)


def latest_behavior(
    tx: DataFrame,
    windows: Windows = DEFAULT,
    event_types: Sequence[str] | None = None,
    now: Column | None = None,
) -> DataFrame:
    """`latest_of` the transactions' panes. With `now`, rows that have expired by then are left out."""
    rows = latest_of(panes(tx, windows, event_types), windows)
    return rows if now is None else rows.filter(expires_at(windows) > now)


def expires_at(windows: Windows = DEFAULT) -> Column:
    """When a behaviour row is no longer fresh."""
    return F.col("updated_at") + F.make_dt_interval(secs=F.lit(windows.freshness))


# ---------------------------------------------------------------------------------------------
# Features at each transaction
# ---------------------------------------------------------------------------------------------

FEATURES = ("tx_count_1m", "amount_sum_5m", "failed_tx_5m")
_SUMS = ("_count", "_spend", "_failures")


def _entering(
    tx: DataFrame, windows: Windows, event_types: Sequence[str] | None, cuts: DataFrame | None = None
) -> DataFrame:
    """Transactions with their place on the account's time line and what they add to its sums."""
    tx = with_cuts(tx, "account_id", cuts)
    at = F.unix_micros("event_time")
    owned = F.col("account_id").isNotNull() & at.isNotNull()
    counts = F.col("event_type").isin(*event_types) if event_types else F.lit(True)
    counts = owned & F.coalesce(counts, F.lit(False))
    spend = C.spent(F.col("amount"), F.col("status"))
    # Rows without an account or a time have no neighbours: spread them over slots of their own
    # (negative, and so small that no real slot has that start).
    spread = -1 - F.pmod(F.xxhash64("tx_id"), F.lit(1 << 16))
    return tx.select(
        *tx.columns,
        F.when(owned, _slot(at, windows, tx)).otherwise(spread).alias("slot"),
        F.coalesce(at, F.lit(0)).alias("at"),
        F.when(counts, 1).otherwise(0).alias("_count"),
        F.when(counts, spend).otherwise(C.no_money()).alias("_spend"),
        F.when(counts, C.failed(F.col("status"))).otherwise(0).alias("_failures"),
    )


def _slot(at: Column, windows: Windows, rows: DataFrame) -> Column:
    return slot_of(at, windows.slot, F.col("_cuts") if "_cuts" in rows.columns else None)


def _owned() -> Column:
    return F.col("account_id").isNotNull() & F.col("event_time").isNotNull()


def _ends(windows: Windows) -> tuple[Column, Column]:
    """When a transaction leaves the count window and the spend window. Both ends of a window
    belong to it, so that is one microsecond after the far end."""
    at = F.col("at")
    return at + (windows.count * MICROS + 1), at + (windows.spend * MICROS + 1)


_ENTERS, _LEAVES_COUNT, _LEAVES_SPEND = range(3)


def _mark(kind: int, at: Column, slot: Column, *sums: Column, **more: Column) -> Column:
    named = [c.alias(name) for name, c in zip(_SUMS, sums)]
    named += [c.alias(name) for name, c in more.items()]
    return F.struct(F.lit(kind).alias("kind"), at.alias("at"), slot.alias("slot"), *named)


def _changes_something(mark: str) -> Column:
    return (F.col(f"{mark}._count") != 0) | (F.col(f"{mark}._spend") != 0) | (F.col(f"{mark}._failures") != 0)


def _marks(entering: DataFrame, windows: Windows) -> DataFrame:
    """Each transaction as a mark where it enters the windows, with all its columns, and marks where it leaves
    the count window and the spend window, with what the sums need only. One pass over the rows."""
    none, (count_end, spend_end) = F.lit(0), _ends(windows)
    count, spend, failures = (F.col(name) for name in _SUMS)
    marks = F.explode(F.array(
        _mark(_ENTERS, F.col("at"), F.col("slot"), count, spend, failures),
        _mark(_LEAVES_COUNT, count_end, _slot(count_end, windows, entering), -count, C.no_money(), none),
        _mark(_LEAVES_SPEND, spend_end, _slot(spend_end, windows, entering), none, -spend, -failures),
    ))
    enters = F.col("mark.kind") == _ENTERS
    taken = ("at", "slot", *_SUMS)
    rest = [c for c in entering.columns if c not in (*taken, "account_id", "_emit", "_cuts")]
    return (
        entering.select("*", marks.alias("mark")).filter(enters | _changes_something("mark"))
        .select(
            "account_id", *[F.when(enters, F.col(c)).alias(c) for c in rest],
            *[f"mark.{name}" for name in taken],
            enters.alias("_entering"), (enters & F.col("_emit")).alias("_emit"),
        )
    )


def _tail() -> Column:
    return F.struct(F.struct("at", "tx_id", "lsn").alias("pos"), F.col("location"))


def _slot_carry(
    entering: DataFrame, windows: Windows, earlier_tails: DataFrame | None = None
) -> DataFrame:
    """For each (account, slot) with output: the sums and the last transaction brought into it.

    Slots are reduced to their last row and what they add to the sums of later slots, by one map-side
    combined aggregate over one pass. Transactions that leave a window in the slot they entered it add nothing,
    so the marks are few where windows are short. Running totals are then taken over the slots, however
    many transactions an account has.
    """
    none, slot, (count_end, spend_end) = F.lit(0), F.col("slot"), _ends(windows)
    count, spend, failures = (F.col(name) for name in _SUMS)
    count_slot, spend_slot = (_slot(end, windows, entering) for end in (count_end, spend_end))
    count = F.when(count_slot != slot, count).otherwise(none)
    spend, failures = (F.when(spend_slot != slot, c).otherwise(zero)
                       for c, zero in ((spend, C.no_money()), (failures, none)))
    own, nothing = {"tail": _tail(), "_emit": F.col("_emit")}, F.lit(None)
    other = {"tail": F.when(nothing.isNotNull(), _tail()), "_emit": F.lit(False)}
    marks = F.explode(F.array(
        _mark(_ENTERS, F.col("at"), slot, count, spend, failures, **own),
        _mark(_LEAVES_COUNT, F.col("at"), count_slot, -count, C.no_money(), none, **other),
        _mark(_LEAVES_SPEND, F.col("at"), spend_slot, none, -spend, -failures, **other),
    ))
    rows = (
        entering.filter(_owned()).select("account_id", marks.alias("mark"))
        .filter((F.col("mark.kind") == _ENTERS) | _changes_something("mark"))
        .select("account_id", "mark.slot", "mark.tail", "mark._emit", *[f"mark.{name}" for name in _SUMS])
    )
    if earlier_tails is not None:
        rows = rows.unionByName(
            earlier_tails.select("account_id", "slot", "tail", F.lit(False).alias("_emit")),
            allowMissingColumns=True,
        )
    slots = rows.groupBy("account_id", "slot").agg(
        F.max_by("tail", "tail.pos").alias("tail"), F.max("_emit").alias("_emit"),
        *[F.sum(name).alias(name) for name in _SUMS],
    )
    return carry_in(slots, "account_id", "tail", _SUMS).filter("_emit").select(
        "account_id", "slot", "tail", *[F.col(name).alias(f"{name}_in") for name in _SUMS],
    )


def trailing_features(
    tx: DataFrame,
    windows: Windows = DEFAULT,
    event_types: Sequence[str] | None = None,
    context: DataFrame | None = None,
    earlier_tails: DataFrame | None = None,
    profiles: DataFrame | None = None,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Add to each transaction what its account did in the windows ending at it, and where the
    account's preceding transaction was.

    tx_count_1m, amount_sum_5m and failed_tx_5m include the transaction itself and both ends of
    the window. last_location follows the order of (event_time, tx_id, lsn).

    Every transaction is a mark on its account's time line where it enters the windows, and one
    where it leaves each; sums over the marks so far are the window contents. That is one ordered
    pass, linear in the rows however dense an account is, where a sliding frame would add up its
    content anew for every row. The line is cut into slots: sums run within (account, slot), and
    start from what `_slot_carry` brings in, so the slot may be shorter than the windows.

    Marks that are output keep all columns, the others only what the sums need. They are
    shuffled once, by (account, slot), sorted once, and joined with the slots where they are.

    `profiles`, one row per account, is joined to the slots and so costs no further shuffle of the
    transactions. `context` holds earlier transactions that count but are not output, and
    `earlier_tails` the slot tails of everything earlier. `cuts`, from `dense_account_cuts`, split the slots of
    accounts that are too dense for them; with `earlier_tails`, which are kept by whole slots, there can't be any.
    """
    if cuts is not None and earlier_tails is not None:
        raise ValueError("slots that earlier tails are kept by can't be cut")
    output = list(tx.columns)
    if "lsn" not in tx.columns:
        tx = tx.withColumn("lsn", F.lit(None).cast("bigint"))
    rows = tx.withColumn("_emit", F.lit(True))
    if context is not None:
        context = context.select(*[c for c in tx.columns if c in context.columns])
        rows = rows.unionByName(context.withColumn("_emit", F.lit(False)), allowMissingColumns=True)
    entering = _entering(rows, windows, event_types, cuts)
    marks = _marks(entering, windows)

    # Sorting once by the full order serves both windows below, and the join.
    line = marks.repartition("account_id", "slot").sortWithinPartitions(
        "account_id", "slot", "at", "tx_id", "lsn"
    )
    part = Window.partitionBy("account_id", "slot")
    so_far = part.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    in_order = part.orderBy("at", "tx_id", "lsn")
    here = line.select(
        *tx.columns, "slot", "_entering", "_emit",
        "at", *[F.sum(name).over(so_far).alias(name) for name in _SUMS],
    ).filter("_entering")
    here = here.withColumn("_previous", F.lag(F.struct("location")).over(in_order)).filter("_emit")

    slots = _slot_carry(entering, windows, earlier_tails)
    if profiles is not None:
        slots = slots.join(profiles, "account_id", "left")
        output += [c for c in profiles.columns if c != "account_id"]

    def total(name):
        return F.col(name) + F.coalesce(F.col(f"{name}_in"), F.lit(0))

    inside = F.col("_previous").isNotNull()
    last = F.when(inside, F.col("_previous.location")).otherwise(F.col("tail.location"))
    return here.join(slots, ["account_id", "slot"], "left").select(
        *output,
        total("_count").alias("tx_count_1m"),
        C.units(total("_spend")).alias("amount_sum_5m"),
        total("_failures").alias("failed_tx_5m"),
        F.when(_owned(), last).alias("last_location"),
    )


def trailing_features_by_account(
    tx: DataFrame,
    windows: Windows = DEFAULT,
    event_types: Sequence[str] | None = None,
    context: DataFrame | None = None,
    earlier_tails: DataFrame | None = None,
    profiles: DataFrame | None = None,
    dense: Sequence[int] = (),
) -> DataFrame:
    """`trailing_features` with whole accounts as the parts, but for the `dense` ones.

    An account that one task can hold needs no slots, and so nothing brought into them: earlier tails are
    rows on its time line like any other, and its profile is joined where its rows already are. Where
    transactions are sparse, slots are as many as the rows, and this is one shuffle in place of five.
    Accounts that are too much for a task, see `dense_keys`, are worked out slot by slot.
    `earlier_tails` may have several rows of a slot. `tx` is read again for rows without an account or a time.
    """
    if dense:
        few = F.col("account_id").isin(*dense)

        def parts(rows):
            return (None, None) if rows is None else (rows.filter(~few), rows.filter(few))

        (some, cut), (near, near_cut), (tails, tails_cut) = parts(tx), parts(context), parts(earlier_tails)
        some = some.unionByName(tx.filter("account_id is null"))
        apart = trailing_features(cut, windows, event_types, near_cut, tails_cut, profiles)
        rest = trailing_features_by_account(some, windows, event_types, near, tails, profiles)
        return rest.unionByName(apart)

    rows = tx if "lsn" in tx.columns else tx.withColumn("lsn", F.lit(None).cast("bigint"))
    owned = rows.filter(_owned()).withColumn("_emit", F.lit(True))
    if context is not None:
        near = context.filter(_owned()).select(*[c for c in rows.columns if c in context.columns])
        owned = owned.unionByName(near.withColumn("_emit", F.lit(False)), allowMissingColumns=True)
    line = _line(_entering(owned, windows, event_types), tx.columns, windows)
    sums = ("_count", "_billions", "_units", "_failures")
    if earlier_tails is not None:
        line = line.unionByName(earlier_tails.select(
            "account_id", "tail.pos.*", F.struct("tail.location").alias("_place"),
            F.lit(True).alias("_entering"), F.lit(False).alias("_emit"),
            *[F.lit(0).cast("bigint").alias(name) for name in sums],
        ), allowMissingColumns=True)

    # As in `trailing_features`: sorted once for both windows and the join.
    line = line.repartition("account_id").sortWithinPartitions("account_id", "at", "tx_id", "lsn")
    part = Window.partitionBy("account_id")
    so_far = part.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    here = line.withColumns({name: F.sum(name).over(so_far) for name in sums}).filter("_entering")
    before = F.lag("_place").over(part.orderBy("at", "tx_id", "lsn"))
    here = here.withColumn("_previous", before).filter("_emit")
    output = [F.col(f"_row.{c}").alias(c) for c in tx.columns]
    if profiles is not None:
        here = here.join(profiles, "account_id", "left")
        output += [F.col(c) for c in profiles.columns if c != "account_id"]
    spend = F.col("_billions").cast(C.HUNDREDTHS) * BILLION + F.col("_units")
    found = here.select(
        *output,
        F.col("_count").alias("tx_count_1m"), C.units(spend).alias("amount_sum_5m"),
        F.col("_failures").alias("failed_tx_5m"), F.col("_previous.location").alias("last_location"),
    )
    # Rows without an account or a time belong to no one, and have no profile.
    no_one = tx.filter(~_owned()).select("*", F.lit(0).cast("bigint").alias("tx_count_1m"),
                                         F.lit(0.0).alias("amount_sum_5m"), F.lit(0).cast("bigint").alias("failed_tx_5m"))
    return found.unionByName(no_one, allowMissingColumns=True)


BILLION = 1_000_000_000


def _line(entering: DataFrame, columns: Sequence[str], windows: Windows) -> DataFrame:
    """The marks of `_marks` with the transaction's columns in one, `_row`, that is null in all but those that
    are output: marks that only change the sums stay narrow. Spend is in two whole numbers, `_billions` of
    hundredths and `_units`, whose sums are exact and much faster than those of a decimal."""
    none, (count_end, spend_end) = F.lit(0), _ends(windows)
    count, spend, failures = (F.col(name) for name in _SUMS)
    marks = F.explode(F.array(
        _mark(_ENTERS, F.col("at"), none, count, spend, failures),
        _mark(_LEAVES_COUNT, count_end, none, -count, C.no_money(), none),
        _mark(_LEAVES_SPEND, spend_end, none, none, -spend, -failures),
    ))
    enters, whole = F.col("mark.kind") == _ENTERS, F.col("mark._spend").cast("bigint")
    return (
        entering.select("*", marks.alias("mark")).filter(enters | _changes_something("mark"))
        .select(
            "account_id", "mark.at", *[F.when(enters, F.col(c)).alias(c) for c in ("tx_id", "lsn")],
            F.col("mark._count").cast("bigint").alias("_count"),
            F.call_function("div", whole - F.pmod(whole, F.lit(BILLION)), F.lit(BILLION)).alias("_billions"), F.pmod(whole, F.lit(BILLION)).alias("_units"),
            F.col("mark._failures").cast("bigint").alias("_failures"),
            F.when(enters, F.struct("location")).alias("_place"),
            F.when(enters & F.col("_emit"), F.struct(*columns)).alias("_row"),
            enters.alias("_entering"), (enters & F.col("_emit")).alias("_emit"),
        )
    )


def row_tails(tx: DataFrame, slot: int) -> DataFrame:
    """Each transaction as if it were the last of its (account, slot): its position and its location."""
    if "lsn" not in tx.columns:
        tx = tx.withColumn("lsn", F.lit(None).cast("bigint"))
    return tx.filter(_owned()).withColumn("at", F.unix_micros("event_time")).select(
        "account_id", slot_start(F.col("at"), slot).alias("slot"),
        _tail().alias("tail"),
    )


def slot_tails(tx: DataFrame, slot: int) -> DataFrame:
    """The last transaction of each (account, slot): its position and its location."""
    return row_tails(tx, slot).groupBy("account_id", "slot").agg(F.max_by("tail", "tail.pos").alias("tail"))


def dense_account_cuts(tx: DataFrame, windows: Windows = DEFAULT, most_rows: int = 1_000_000) -> DataFrame:
    """Where to cut the slots of accounts with more than `most_rows` marks in one: see `dense_cuts`.

    A burst of transactions is as dense again where they leave the windows, so those times count too.
    Write the cuts to the shared folder and use them if there are any; they take two narrow passes.
    """
    at = F.unix_micros("event_time")
    marks = tx.select("account_id", at.alias("at")).select(
        "account_id", F.explode(F.array("at", *_ends(windows))).alias("at"))
    return dense_cuts(marks, "account_id", F.col("at"), windows.slot, most_rows)


def fresh_previous_behavior(
    tx: DataFrame, windows: Windows = DEFAULT, event_types: Sequence[str] | None = None
) -> DataFrame:
    """The stored-state reading: each transaction with the counters its account had after the
    latest earlier one, unless those are `freshness` seconds old. Absent counters are 0.

    What a fresh earlier row can have counted lies at most `freshness` and a window back. So each
    transaction is a mark in its own slot and, if that is within reach, in the next one too; then every
    (account, slot) is worked out by itself, in one ordered pass and one shuffle: the sums at each
    mark, and of these the ones at the last earlier time.
    """
    reach = windows.freshness + max(windows.count, windows.spend)
    length = max(windows.slot, reach)
    windows = replace(windows, slot=length)
    entering = _entering(tx, windows, event_types)
    none, at, slot, (count_end, spend_end) = F.lit(0), F.col("at"), F.col("slot"), _ends(windows)
    count, spend, failures = (F.col(name) for name in _SUMS)
    marks = []
    for place, home in ((slot, True), (slot + length * MICROS, False)):
        more = {"home": F.lit(home)}
        marks += [
            _mark(_ENTERS, at, place, count, spend, failures, **more),
            _mark(_LEAVES_COUNT, count_end, place, -count, C.no_money(), none, **more),
            _mark(_LEAVES_SPEND, spend_end, place, none, -spend, -failures, **more),
        ]
    enters, home = F.col("mark.kind") == _ENTERS, F.col("mark.home")
    inside = F.col("mark.at") < F.col("mark.slot") + length * MICROS
    within_reach = _owned() & (F.col("at") + reach * MICROS >= F.col("mark.slot"))
    wanted = (enters & home) | (inside & (home | within_reach) & (enters | _changes_something("mark")))
    own = enters & home
    line = (
        entering.select("*", F.explode(F.array(*marks)).alias("mark")).filter(wanted)
        .select(
            F.col("account_id").alias("_account"), *[F.when(own, F.col(c)).alias(c) for c in tx.columns],
            "mark.slot", "mark.at", *[f"mark.{name}" for name in _SUMS],
            enters.alias("_enters"), own.alias("_own"), (own & _owned()).alias("_owned"),
        )
        .repartition("_account", "slot").sortWithinPartitions("_account", "slot", "at")
    )
    part = Window.partitionBy("_account", "slot").orderBy("at")
    so_far = part.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [F.sum(name).over(so_far).alias(name) for name in _SUMS]
    rows = line.select(*tx.columns, "_account", "slot", "at", "_enters", "_own", "_owned", *sums)
    before = part.rangeBetween(Window.unboundedPreceding, -1)
    state = F.when(F.col("_enters"), F.struct("at", *_SUMS))
    rows = rows.withColumn("previous", F.last(state, ignorenulls=True).over(before)).filter("_own")
    fresh = F.col("_owned") & (F.col("at") - F.col("previous.at") < windows.freshness * MICROS)
    found = F.coalesce(fresh, F.lit(False))

    def kept(value: Column, zero: Column) -> Column:
        return F.when(found, value).otherwise(zero)

    return rows.select(
        *tx.columns,
        kept(F.col("previous._count"), F.lit(0)).alias("previous_tx_count_1m"),
        kept(C.units(F.col("previous._spend")), F.lit(0.0)).alias("previous_amount_sum_5m"),
        kept(F.col("previous._failures"), F.lit(0)).alias("previous_failed_tx_5m"),
        found.alias("previous_found"),
    )
