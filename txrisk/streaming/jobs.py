"""Continuous queries: clean, dimension state, behaviour windows, verdicts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk import schemas
from txrisk.functions import columns as C
from txrisk.operators import behavior, decode, dims, rules
from txrisk.operators.behavior import DEFAULT, Windows
from txrisk.operators.slots import MICROS, slot_start
from txrisk.sources import sinks
from txrisk.sources.state import BatchTable, KeyedState
from txrisk.streaming.enrichment import newest_slots


def state_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session for aggregating streams. A stream's first run fixes its number of state
    partitions: `partitions`, or else the session's own setting."""
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set(
        "spark.sql.shuffle.partitions",
        partitions or int(spark.conf.get("spark.sql.shuffle.partitions")),
    )
    return session


# --- clean ---------------------------------------------------------------------------------------

def start_clean(
    raw: DataFrame,
    checkpoint: str,
    lake: str | None = None,
    dead_letters: str | None = None,
    publish: Callable[[DataFrame], None] | None = None,
    precision: str = "micros",
    rows_per_file: int = 1_000_000,
    on_counts: Callable[[int, dict[str, int]], None] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Change events to the lake, to `publish` as (key, value) rows, and to the dead letters.

    A micro-batch is decoded once and landed beside the checkpoint; everything else is made from what
    was landed, so all outlets have the same rows and processing time. The lake has a folder per event date
    and in it one per micro-batch, which a retry replaces, with a file for every `rows_per_file` rows. `on_counts`
    gets the number of rows of a batch by reason, null for clean ones, from the landing itself.
    """
    landed, dead = BatchTable(f"{checkpoint}/landed"), BatchTable(dead_letters or "")

    def process(incoming: DataFrame, batch_id: int) -> None:
        spark = incoming.sparkSession
        counts = Observation(f"clean {batch_id}")
        decoded = decode.decoded_transactions(incoming, precision)
        landed.write(decoded.observe(counts, *decode.counted_reasons()), batch_id)
        by_reason = {None if k == "CLEAN" else k: n for k, n in counts.get.items() if n}
        landed.drop_before(spark, batch_id - 1)
        rows = landed.read(spark, [batch_id])
        clean = rows.filter("reason is null").select(*schemas.CLEAN.names)
        if lake and by_reason.get(None):
            sinks.write_lake_batch(clean, lake, batch_id, rows_per_file)
        if dead_letters:
            dead.write(rows.filter("reason is not null").select(*decode.REJECTED), batch_id)
        if publish:
            publish(decode.encode(clean, "tx_id"))
        if on_counts:
            on_counts(batch_id, by_reason)

    return sinks.start_batches(raw, process, f"{checkpoint}/query", available_now=available_now)


def start_flat_dead_letters(
    raw: DataFrame, schema, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Messages of a topic of flat JSON that can't be used, with the reason."""
    rejected = decode.rejected_flat(raw, schema)
    return sinks.start_rows_sink(rejected, path, checkpoint, available_now)


# --- dimension state -----------------------------------------------------------------------------

def account_state(path: str, **options) -> KeyedState:
    return KeyedState(path, ["account_id"], dims.CHANGE_ORDER, **options)


def customer_state(path: str, **options) -> KeyedState:
    return KeyedState(path, ["customer_id"], dims.CHANGE_ORDER, **options)


def dimension_tables(
    spark: SparkSession,
    accounts: KeyedState,
    customers: KeyedState,
    account_ids: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Current (accounts, customers); empty before the first change. With `account_ids`, those
    accounts and their customers only."""

    def current(state, schema, only):
        rows = state.read(spark, only=only)
        return spark.createDataFrame([], schema) if rows is None else rows.select(*schema.names)

    account_rows = current(accounts, schemas.ACCOUNT_STATE, account_ids)
    customer_ids = None if account_ids is None else account_rows.select("customer_id")
    return account_rows, current(customers, schemas.CUSTOMER_STATE, customer_ids)


def start_dimension(
    spark: SparkSession,
    changes: DataFrame,
    state: KeyedState,
    checkpoint: str,
    publish: Callable[[DataFrame], None] | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Append each micro-batch of changes to the dimension's log; its state is the last change
    per key. `publish`, if given, gets the (key, value) rows of the batch as well."""
    key = state.keys[0]

    def process(batch: DataFrame, batch_id: int) -> None:
        state.fold(spark, batch_id)
        state.write(batch, batch_id)
        if publish is not None:
            written = state.batch(spark, batch_id)
            if written is not None:
                publish(decode.encode(
                    written.drop(*dims.CHANGE_ORDER), key, timestamp_format=C.ISO_MILLIS
                ))

    return sinks.start_batches(changes, process, checkpoint, available_now=available_now)


# --- behaviour windows ---------------------------------------------------------------------------

class BehaviorStore:
    """Panes by account and slide step, and each account's behaviour row with when it expires.

    Counts and sums of all windows are read from the panes. Of each account the `keep` newest panes
    are kept, or all of them.
    """

    def __init__(self, path: str, windows: Windows = DEFAULT, keep: int | None = None, **options):
        def newest(rows: DataFrame) -> DataFrame:
            return newest_slots(rows, F.col("pane"), keep)

        self.windows = windows
        self.panes = KeyedState(
            f"{path}/panes", ["account_id", "pane"], [], trim=newest if keep else None,
            layout=f"panes of {windows.slide} s", **options
        )
        self.latest = KeyedState(f"{path}/latest", ["account_id"], ["updated_at"], **options)

    def counts(self, spark: SparkSession) -> DataFrame | None:
        rows = self.panes.read(spark)
        return None if rows is None else behavior.counts_of(rows, self.windows)

    def sums(self, spark: SparkSession) -> DataFrame | None:
        rows = self.panes.read(spark)
        return None if rows is None else behavior.sums_of(rows, self.windows)

    def rows(
        self, spark: SparkSession, now: Column | None = None, only: DataFrame | None = None
    ) -> DataFrame | None:
        """One behaviour row per account, without those that have expired by `now`."""
        rows = self.latest.read(spark, only=only)
        return rows if rows is None or now is None else rows.filter(F.col("expires_at") > now)

    def process(self, spark: SparkSession, changed: DataFrame, batch_id: int) -> None:
        """Take over changed panes, and work out the rows of their accounts."""
        self.panes.fold(spark, batch_id)
        self.latest.fold(spark, batch_id)
        self.panes.write(changed, batch_id)
        written = self.panes.batch(spark, batch_id)
        if written is None:
            return
        accounts = written.select("account_id").distinct()
        current = self.panes.read(spark, before=batch_id + 1, only=accounts)
        rows = behavior.latest_of(current, self.windows)
        self.latest.write(rows.withColumn("expires_at", behavior.expires_at(self.windows)), batch_id)


def start_behavior(
    spark: SparkSession,
    clean: DataFrame,
    store: BehaviorStore,
    checkpoint: str,
    delay: str = "10 minutes",
    event_types=None,
    available_now: bool = False,
) -> StreamingQuery:
    """One aggregating query in update mode: each micro-batch brings the panes that changed."""
    marked = behavior.with_watermark(clean, delay)

    def process(batch: DataFrame, batch_id: int) -> None:
        store.process(spark, batch, batch_id)

    rows = behavior.panes(marked, store.windows, event_types)
    return sinks.start_batches(rows, process, checkpoint, "update", available_now)


LATE = "LATE"


def start_late_rows(
    spark: SparkSession,
    clean: DataFrame,
    path: str,
    checkpoint: str,
    windows: Windows = DEFAULT,
    delay: int = 600,
    available_now: bool = False,
) -> StreamingQuery:
    """The transactions that `start_behavior` may leave out, given the same micro-batches: those whose
    pane had ended `delay` seconds before the latest event of earlier micro-batches.

    Columns: those of the transaction, `watermark` and `reason`.
    """
    out, marks = BatchTable(f"{path}/rows"), BatchTable(f"{path}/marks")

    def process(incoming: DataFrame, batch_id: int) -> None:
        at = F.unix_micros("event_time")
        earlier = marks.read(spark, [i for i in marks.ids(spark) if i < batch_id][-1:])
        seen = None if earlier is None else earlier.first()["latest"]
        # The watermark has milliseconds.
        mark = None if seen is None else seen // 1000 * 1000 - delay * MICROS
        rows = incoming.filter("account_id is not null and event_time is not null")
        late = rows.filter(slot_start(at, windows.slide) + windows.slide * MICROS <= F.lit(mark).cast("bigint"))
        out.write(late.withColumns({
            "watermark": F.timestamp_micros(F.lit(mark).cast("bigint")), "reason": F.lit(LATE)}), batch_id)
        latest = rows.agg(F.max(at).alias("latest")).select(F.greatest("latest", F.lit(seen).cast("bigint")).alias("latest"))
        marks.write(latest, batch_id)
        marks.drop_before(spark, batch_id - 1)

    return sinks.start_batches(clean, process, checkpoint, available_now=available_now)


# --- verdicts ------------------------------------------------------------------------------------

def judge_topic(
    raw: DataFrame, limit: rules.Thresholds = rules.DEFAULT
) -> tuple[DataFrame, DataFrame]:
    """Verdicts for a topic of enriched JSON, and the messages that could not be read."""
    rows, dead = decode.split_undecodable(raw, schemas.ENRICHED_WIRE)
    return rules.verdicts(rows, limit), dead


def await_any(queries: list[StreamingQuery], seconds: float = 1.0) -> None:
    """Run until one of the queries ends, whichever session it is of, then stop the others. If it
    failed, its error is raised."""
    try:
        while all(query.isActive for query in queries):
            queries[0].awaitTermination(seconds)
        for query in queries:
            if not query.isActive:
                query.awaitTermination()
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
