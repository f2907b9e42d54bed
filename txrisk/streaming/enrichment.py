"""Continuous enrichment: the batch operators, one micro-batch at a time.

Trailing windows and the previous location need rows of earlier micro-batches. Those are kept dealt
out by account, and each micro-batch opens the buckets of its own accounts:

* earlier transactions of the batch's accounts within a window's reach, for the windows;
* the last transaction per (account, slot), for the previous location;
* the current dimension state.

A row that arrives in a later micro-batch than rows it precedes in time still gets the right
values itself, but rows already written are not revised.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.operators import enrich
from txrisk.operators.behavior import DEFAULT, Windows, row_tails, slot_tails
from txrisk.operators.slots import MICROS, MOST_ROWS, dense_keys, slot_start
from txrisk.sources import sinks
from txrisk.sources.state import BatchTable, BucketedLog, KeyedState

# What earlier transactions are kept for: windows and the order within an account.
KEPT = ("account_id", "event_time", "tx_id", "lsn", "amount", "status", "event_type", "location")


def newest_slots(rows: DataFrame, slot: Column, most: int) -> DataFrame:
    """The rows in the `most` newest slots in which their account has any.

    Slots are counted, not measured: a row dated far ahead takes the place of one slot of its own
    account, whatever its date, and none of any other account.
    """
    keyed = rows.withColumn("_slot", slot).filter("account_id is not null and _slot is not null")
    order = Window.partitionBy("account_id").orderBy(F.desc("_slot"))
    # Accounts with fewer slots have no row here: usually it is small, if not empty, and the rows stay where they are.
    oldest = (
        keyed.select("account_id", "_slot").distinct()
        .withColumn("_place", F.row_number().over(order)).filter(F.col("_place") == most)
        .select("account_id", F.col("_slot").alias("_oldest"))
    )
    kept = F.col("_oldest").isNull() | (F.col("_slot") >= F.col("_oldest"))
    return keyed.join(oldest, "account_id", "left").filter(kept).select(*rows.columns)


def over(rows: DataFrame, most: int) -> bool:
    """Whether an account has more than `most` rows, and so may have more slots."""
    counts = rows.groupBy("account_id").agg(F.count(F.lit(1)).alias("n"))
    return not counts.filter(F.col("n") > most).isEmpty()


class EnrichmentStore:
    """What enrichment keeps between micro-batches, under one folder.

    Of each account the `keep_slots` newest slots (rows: stretches) that hold any of its
    transactions are kept, however long ago they are. A row that arrives later than those lacks
    earlier rows in its windows, and finds no previous location of before its own time.
    """

    def __init__(
        self,
        path: str,
        windows: Windows = DEFAULT,
        keep_slots: int = 24 * 4,
        fold_every: int = 20,
        buckets: int = 16,
        most_rows: int = MOST_ROWS,
    ):
        self.windows = windows
        # Accounts with more rows in a micro-batch and its context are worked out slot by slot.
        self.most_rows = most_rows
        self.reach = max(windows.count, windows.spend)
        # Rows are looked up by stretches that a window, or a slot, spans at most two of.
        self.stretch = max(windows.slot, self.reach)
        self.keep_slots = keep_slots
        self.landed = BatchTable(f"{path}/landed")
        self.near = BatchTable(f"{path}/near")
        options = {"fold_every": fold_every, "buckets": buckets, "trim_due": lambda rows: over(rows, keep_slots)}
        self.rows = BucketedLog(
            f"{path}/rows", "account_id", trim=self._trim_rows, layout=f"stretch {self.stretch}", **options
        )
        self.tails = KeyedState(
            f"{path}/tails", ["account_id", "slot"], ["tail"], trim=self._trim_tails,
            layout=f"slot {windows.slot}", **options
        )

    def _trim_rows(self, rows: DataFrame) -> DataFrame:
        own = slot_start(F.unix_micros("event_time"), self.stretch)
        return newest_slots(rows, own, self.keep_slots + 1)

    def _trim_tails(self, tails: DataFrame) -> DataFrame:
        return newest_slots(tails, F.col("slot"), self.keep_slots)

    def fold(self, spark: SparkSession, batch_id: int) -> None:
        self.tails.fold(spark, batch_id)
        self.rows.fold(spark, batch_id)

    def keep(self, batch: DataFrame, batch_id: int, sparse: bool = False) -> None:
        """Keep a micro-batch for those after it. In a `sparse` one most slots have one row, and are reduced
        to their last when they are folded."""
        owned = F.col("account_id").isNotNull() & F.col("event_time").isNotNull()
        self.rows.write(batch.filter(owned).select(*KEPT), batch_id)
        self.tails.write((row_tails if sparse else slot_tails)(batch, self.windows.slot), batch_id)

    def context(self, spark: SparkSession, batch: DataFrame, span, batch_id: int):
        """Earlier rows that windows ending in this batch can reach, or None. They are landed, as they are
        read more than once."""
        if span["first"] is None:
            return None
        earlier = self.rows.read(spark, before=batch_id, buckets=set(span["buckets"]))
        if earlier is None:
            return None
        at = F.unix_micros("event_time")
        low, high = (F.timestamp_micros(F.lit(v)) for v in (span["first"] - self.reach * MICROS, span["last"]))
        # One row an account, combined before the shuffle, where its stretches would be as many as its rows.
        own = batch.groupBy("account_id").agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
        reached = at.between(F.col("_first") - self.reach * MICROS, F.col("_last"))
        near = (
            earlier.filter(F.col("event_time").between(low, high))
            .join(own, "account_id").filter(reached).drop("_first", "_last")
        )
        self.near.write(near, batch_id)
        self.near.drop_before(spark, batch_id - 1)
        return self.near.read(spark, [batch_id])

    def earlier_tails(self, spark: SparkSession, account_ids: DataFrame, span, batch_id: int):
        return self.tails.read(spark, before=batch_id, only=account_ids, buckets=set(span["buckets"]), reduced=False)


def process_batch(
    spark: SparkSession,
    incoming: DataFrame,
    batch_id: int,
    store: EnrichmentStore,
    dimensions: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    sink: Callable[[DataFrame, int], None],
    event_types=None,
) -> None:
    """Enrich one micro-batch. Reads earlier batches only and replaces what an earlier attempt
    at the same batch wrote, so it may be repeated after a failure at any point."""
    # Written first and read back: the batch is computed once, and what follows runs as a batch
    # query with adaptive execution, which streams run without.
    store.landed.write(incoming, batch_id)
    store.landed.drop_before(spark, batch_id - 1)
    batch = store.landed.read(spark, [batch_id])
    span = batch.agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.unix_micros("event_time")).alias("first"),
        F.max(F.unix_micros("event_time")).alias("last"),
        F.collect_set(store.rows.bucket()).alias("buckets"),
        F.approx_count_distinct(F.struct(
            "account_id", slot_start(F.unix_micros("event_time"), store.windows.slot))).alias("slots"),
    ).first()
    if span["n"] == 0:
        return
    store.fold(spark, batch_id)

    context = store.context(spark, batch, span, batch_id)
    account_ids = batch.select("account_id").distinct()
    accounts, customers = dimensions(account_ids)
    enriched = enrich.enrich(
        batch, accounts, customers, store.windows, event_types,
        context=context, earlier_tails=store.earlier_tails(spark, account_ids, span, batch_id),
        dense=dense_keys(store.most_rows, *[
            rows.select("account_id") for rows in (batch, context) if rows is not None]),
    )
    sink(enriched, batch_id)
    store.keep(batch, batch_id, sparse=span["n"] < 2 * span["slots"])


def start_enrichment(
    spark: SparkSession,
    clean: DataFrame,
    store: EnrichmentStore,
    dimensions: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    event_types=None,
    available_now: bool = False,
) -> StreamingQuery:
    """`dimensions(account_ids)` gives the current (accounts, customers), for those accounts at
    least, and is called for every micro-batch; `jobs.dimension_tables` reads them from state.
    `sink(enriched, batch_id)` must replace what it wrote before for the same id, as
    `BatchTable.write` does."""

    def process(incoming: DataFrame, batch_id: int) -> None:
        process_batch(spark, incoming, batch_id, store, dimensions, sink, event_types)

    return sinks.start_batches(clean, process, checkpoint, available_now=available_now)
