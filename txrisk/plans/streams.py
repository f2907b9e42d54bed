"""The continuous queries run over the given tables until these are read up, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.operators import behavior, decode, dims, rules
from txrisk.plans import catalog
from txrisk.plans import tables as T
from txrisk.plans.catalog import DAY_WINDOWS, TEST_LIMITS, comparable
from txrisk.schemas import ACCOUNT_ROW, CLEAN
from txrisk.session import shared_dir
from txrisk.sources import readers
from txrisk.sources.state import BatchTable
from txrisk.streaming import enrichment, jobs


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = T.table(spark, sf_dir, name).schema
    return readers.file_stream(spark, sf_dir, schema, only=f"{name}.parquet")


def finish(*queries) -> None:
    for query in queries:
        query.awaitTermination()


def slice_of(n: int) -> Column:
    """Which of `n` consecutive stretches of time, 0 to n - 1, a row of `events` is in; 0 without a time.
    `low` and `high` are the first and last time of the table, in microseconds."""
    at, number = F.unix_micros(F.col("ts").cast("timestamp")), F.lit(0)
    for i in range(1, n):
        edge = F.col("low") + F.floor((F.col("high") - F.col("low")) * i / n)
        number = F.when(at >= edge, i).otherwise(number)
    return number


def time_slices(events: DataFrame, n: int) -> list[DataFrame]:
    """The whole table in `n` consecutive stretches of time; a table without times is the first."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    low, high = events.agg(F.min(at), F.max(at)).first()
    marked = events.withColumns({name: F.lit(value).cast("bigint") for name, value in (("low", low), ("high", high))})
    marked = marked.withColumn("slice", slice_of(n)).drop("low", "high")
    return [marked.filter(F.col("slice") == i).drop("slice") for i in range(n)]


def delivered(spark, sf_dir, name: str, work: str, slices: int, arrange=None):
    """The rows of a table as files of `slices` runs: after each yield the next is there to be read.

    Gives the schema and the folder. `arrange` may change the slices' rows.
    """
    parts = (time_slices if name == "events" else hashed_slices)(T.table(spark, sf_dir, name), slices)
    schema = parts[0].schema
    for i, part in enumerate(arrange(parts) if arrange else parts):
        part.write.mode("append").parquet(f"{work}/{name}")
        yield schema, f"{work}/{name}"


def hashed_slices(rows: DataFrame, n: int) -> list[DataFrame]:
    """The whole table in `n` parts by a hash of its rows: changes of a key arrive out of order."""
    part = F.pmod(F.xxhash64(*rows.columns), F.lit(n))
    return [rows.filter(part == i) for i in range(n)]


def stream_clean_lake(spark, sf_dir):
    """In two runs on one checkpoint: the lake, from the landed decode."""
    work = shared_dir(spark, "clean")
    for schema, folder in delivered(spark, sf_dir, "events", work, 2):
        raw = T.transaction_envelopes(readers.file_stream(spark, folder, schema))
        finish(jobs.start_clean(raw, f"{work}/checkpoint", f"{work}/lake", available_now=True))
    return comparable(spark.read.schema(CLEAN).parquet(f"{work}/lake").select(*CLEAN.names))


def _damaged(spark, sf_dir):
    """The clean job over damaged change events, in two runs: (lake, dead letters)."""
    work = shared_dir(spark, "dead")
    for schema, folder in delivered(spark, sf_dir, "events", work, 2):
        raw = T.damaged_envelopes(readers.file_stream(spark, folder, schema))
        finish(jobs.start_clean(raw, f"{work}/checkpoint", f"{work}/lake", f"{work}/rows", available_now=True))
    return spark.read.parquet(f"{work}/lake"), BatchTable(f"{work}/rows").read_all(spark)


def stream_dead_letters(spark, sf_dir):
    """From the same query as the lake."""
    _, rows = _damaged(spark, sf_dir)
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def stream_clean_counts(spark, sf_dir):
    """Rows in the lake and in the dead letters, by reason, as the clean job counts them while landing."""
    work, counts = shared_dir(spark, "counts"), {}
    for schema, folder in delivered(spark, sf_dir, "events", work, 2):
        raw = T.damaged_envelopes(readers.file_stream(spark, folder, schema))
        finish(jobs.start_clean(
            raw, f"{work}/checkpoint", f"{work}/lake", on_counts=counts.__setitem__, available_now=True))
    rows = [(reason or "VALID", n) for batch in counts.values() for reason, n in batch.items()]
    return spark.createDataFrame(rows, "reason string, n long").groupBy("reason").agg(F.sum("n").alias("n"))


def clean_topic_dead_letters(spark, sf_dir):
    """Messages of the clean topic that its readers pass over, in a topic with faults by `k`."""
    work = shared_dir(spark, "flat")
    T.damaged_messages(catalog.events(spark, sf_dir)).write.parquet(f"{work}/topic")
    raw = readers.file_stream(spark, f"{work}/topic", "key string, value string")
    finish(jobs.start_flat_dead_letters(raw, CLEAN, f"{work}/rows", f"{work}/checkpoint", available_now=True))
    used = decode.usable_flat(spark.read.parquet(f"{work}/topic"), CLEAN).select(F.lit("USED").alias("reason"))
    rows = spark.read.parquet(f"{work}/rows").select("reason").unionByName(used)
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def dimension_dead_letters(spark, sf_dir):
    """Account changes that change nothing, in a topic with faults by order key."""
    work = shared_dir(spark, "dimension-dead")
    raw = T.damaged_account_envelopes(table_stream(spark, sf_dir, "orders"))
    rejected = decode.rejected_changes(raw, ACCOUNT_ROW, "account_id")
    finish(jobs.sinks.start_rows_sink(rejected, f"{work}/rows", f"{work}/checkpoint", available_now=True))
    return spark.read.parquet(f"{work}/rows").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _dimension(spark, sf_dir, name, changes, state):
    """A dimension's state after three runs that deliver its changes out of order."""
    work = shared_dir(spark, name)
    state = state(f"{work}/state", fold_every=1)
    for schema, folder in delivered(spark, sf_dir, "orders", work, 3):
        source = changes(readers.file_stream(spark, folder, schema))
        finish(jobs.start_dimension(spark, source, state, f"{work}/checkpoint", available_now=True))
    return state


def stream_account_state(spark, sf_dir):
    state = _dimension(spark, sf_dir, "accounts", lambda rows: dims.account_changes(T.account_envelopes(rows)),
                       jobs.account_state)
    return comparable(state.read(spark).select(*dims.ACCOUNT_STATE))


def stream_customer_state(spark, sf_dir):
    state = _dimension(spark, sf_dir, "customers", lambda rows: dims.customer_changes(T.customer_envelopes(rows)),
                       jobs.customer_state)
    return comparable(state.read(spark).select(*dims.CUSTOMER_STATE))


def _behavior(spark, sf_dir):
    """The behaviour job over the events, in two runs on one checkpoint."""
    work = shared_dir(spark, "behavior")
    store = jobs.BehaviorStore(f"{work}/state", fold_every=1)
    for schema, folder in delivered(spark, sf_dir, "events", work, 2):
        session = jobs.state_session(spark)
        clean = T.clean_rows(readers.file_stream(session, folder, schema))
        finish(jobs.start_behavior(spark, clean, store, f"{work}/checkpoint", available_now=True))
    return store


def stream_velocity_1m(spark, sf_dir):
    counts = _behavior(spark, sf_dir).counts(spark)
    return comparable(counts.select("account_id", "window_start", "window_end", "cnt_1m"))


def stream_spend_fail_5m(spark, sf_dir):
    sums = _behavior(spark, sf_dir).sums(spark)
    return comparable(sums.select("account_id", "window_start", "window_end", "sum_5m", "fail_5m"))


def stream_behavior_latest(spark, sf_dir):
    rows = _behavior(spark, sf_dir).rows(spark)
    return comparable(rows.select("account_id", "updated_at", *behavior.FEATURES))


def stream_behavior_fresh(spark, sf_dir):
    """The behaviour rows that have not expired at the time of the last event."""
    now = T.table(spark, sf_dir, "events").agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    rows = _behavior(spark, sf_dir).rows(spark, now=F.lit(now).cast("timestamp"))
    return comparable(rows.select("account_id", "updated_at", "expires_at", *behavior.FEATURES))


def stream_late_rows(spark, sf_dir):
    """Transactions that came behind the watermark. Those with a `k` of 40 to 44 are delivered with the last
    of three runs, whatever their time."""
    work = shared_dir(spark, "late")

    def arrange(parts):
        held = F.coalesce(T.k_of_props().between(40, 44), F.lit(False))
        return [*[part.filter(~held) for part in parts[:-1]],
                reduce(DataFrame.unionByName, [parts[-1], *[part.filter(held) for part in parts[:-1]]])]

    for schema, folder in delivered(spark, sf_dir, "events", work, 3, arrange):
        clean = T.clean_rows(readers.file_stream(spark, folder, schema))
        finish(jobs.start_late_rows(spark, clean, f"{work}/out", f"{work}/checkpoint", available_now=True))
    rows = BatchTable(f"{work}/out/rows").read_all(spark)
    return comparable(rows.select("tx_id", "account_id", "event_time", "watermark", "reason"))


def enrich_in_slices(
    spark: SparkSession, sf_dir: str, sink, windows=behavior.DEFAULT, slices: int = 3, change=None, fold_every: int = 2
) -> None:
    """Replay the events through streaming enrichment: the files of one stretch of time, a run
    on the same checkpoint, the next stretch, and so on. `change` may alter the clean rows."""
    work = shared_dir(spark, "enrich")
    store = enrichment.EnrichmentStore(f"{work}/store", windows, fold_every=fold_every)
    for part in time_slices(catalog.events(spark, sf_dir), slices):
        clean = T.clean_rows(part)
        (change(clean) if change else clean).write.mode("append").parquet(f"{work}/clean")
        source = readers.file_stream(spark, f"{work}/clean", CLEAN)
        finish(enrichment.start_enrichment(
            spark, source, store,
            lambda _: (T.accounts(spark, sf_dir), T.customers(spark, sf_dir)),
            sink, f"{work}/checkpoint", available_now=True,
        ))


def stream_enriched(spark, sf_dir):
    out = BatchTable(shared_dir(spark, "enriched"))
    enrich_in_slices(spark, sf_dir, out.write)
    return comparable(out.read_all(spark))


def stream_enriched_outliers(spark, sf_dir):
    """With rows dated far ahead, long past and not at all, and huge amounts: each row gets what the rows
    delivered with it or before give it, and nobody's state is lost."""
    out = BatchTable(shared_dir(spark, "outliers"))
    enrich_in_slices(spark, sf_dir, out.write, slices=4, change=T.with_outliers, fold_every=1)
    rows = out.read_all(spark)
    return comparable(rows.select("tx_id", "account_id", "event_time", "location", *behavior.FEATURES, "last_location"))


def stream_verdicts(spark, sf_dir):
    out = BatchTable(shared_dir(spark, "verdicts"))
    enrich_in_slices(
        spark, sf_dir,
        lambda rows, batch_id: out.write(rules.verdicts(rows, TEST_LIMITS), batch_id),
        DAY_WINDOWS,
    )
    return catalog.flat_verdicts(out.read_all(spark))


def stream_judged_topic(spark, sf_dir):
    """Rules over enriched JSON, as a consumer of the enriched topic applies them."""
    work = shared_dir(spark, "judged")
    enriched = catalog.enriched(spark, sf_dir, catalog.transactions(spark, sf_dir), DAY_WINDOWS)
    wire = decode.encode(catalog.enrich.wire_format(enriched), "tx_id")
    wire.write.parquet(f"{work}/topic")
    raw = readers.file_stream(spark, f"{work}/topic", "key string, value string")
    verdicts, _ = jobs.judge_topic(raw, TEST_LIMITS)
    finish(jobs.sinks.start_rows_sink(
        verdicts, f"{work}/verdicts", f"{work}/checkpoint", available_now=True
    ))
    return catalog.flat_verdicts(spark.read.parquet(f"{work}/verdicts"))


STREAMS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        stream_clean_lake, stream_dead_letters, stream_account_state, stream_customer_state,
        stream_clean_counts, clean_topic_dead_letters, dimension_dead_letters,
        stream_velocity_1m, stream_spend_fail_5m, stream_behavior_latest, stream_behavior_fresh,
        stream_late_rows, stream_enriched, stream_enriched_outliers, stream_verdicts, stream_judged_topic,
    )
}
