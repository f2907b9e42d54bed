import datetime
import itertools
import os
import random

import pytest
from pyspark.sql import functions as F

from rows import T0, at, expected, frame, tx
from test_enrich import features, skewed
from txrisk import schemas
from txrisk.operators import behavior, decode, dims, enrich, rules
from txrisk.operators.behavior import Windows
from txrisk.sources import readers, sinks
from txrisk.sources.state import BatchTable, BucketedLog, KeyedState
from txrisk.streaming import enrichment, jobs


def no_dimensions(spark):
    return lambda account_ids: (
        spark.createDataFrame([], schemas.ACCOUNT_STATE),
        spark.createDataFrame([], schemas.CUSTOMER_STATE),
    )


class Replay:
    """Batches of clean rows put through streaming enrichment one after the other."""

    def __init__(self, spark, path, store=None, dimensions=None):
        self.spark, self.path = spark, str(path)
        self.store = store or enrichment.EnrichmentStore(f"{path}/store", fold_every=2)
        self.dimensions = dimensions or no_dimensions(spark)
        self.out = BatchTable(f"{path}/out")
        self.sink = self.out.write

    def run(self, rows=None):
        if rows is not None:
            frame(self.spark, rows).coalesce(1).write.mode("append").parquet(f"{self.path}/in")
        source = readers.file_stream(self.spark, f"{self.path}/in", schemas.CLEAN)
        query = enrichment.start_enrichment(
            self.spark, source, self.store, self.dimensions,
            lambda df, i: self.sink(df, i), f"{self.path}/checkpoint", available_now=True,
        )
        query.awaitTermination()

    def features(self):
        return features(self.out.read_all(self.spark))


def in_order(rows):
    return sorted(rows, key=lambda r: (r["event_time"] or T0, r["tx_id"]))


def chunks(rows, n):
    size = -(-len(rows) // n)
    return [rows[i:i + size] for i in range(0, len(rows), size)]


def test_enrichment_equals_batch(spark, tmp_path):
    rows = in_order(skewed(300))
    replay = Replay(spark, tmp_path)
    parts = chunks(rows, 5)
    # A transaction sees the peers at its own time that arrived with it or before.
    for part in parts:
        replay.run(part)
    want = {}
    for i in range(len(parts)):
        seen = list(itertools.chain(*parts[: i + 1]))
        known = expected(seen)
        want.update({r["tx_id"]: known[r["tx_id"]] for r in parts[i]})
    assert replay.features() == want
    assert replay.store.tails.snapshots.ids(spark) and replay.store.rows.snapshots.ids(spark)


def test_late_rows_get_right_values(spark, tmp_path):
    rows = skewed(200, seed=11)
    random.Random(1).shuffle(rows)
    replay = Replay(spark, tmp_path)
    parts = chunks(rows, 3)
    for part in parts:
        replay.run(part)
    want = {}
    for i in range(len(parts)):
        known = expected(list(itertools.chain(*parts[: i + 1])))
        want.update({r["tx_id"]: known[r["tx_id"]] for r in parts[i]})
    assert replay.features() == want


def test_failed_batch_is_repeated_without_a_trace(spark, tmp_path):
    rows = in_order([r for r in skewed(120) if r["event_time"]])
    parts = chunks(rows, 3)
    replay = Replay(spark, tmp_path)
    replay.run(parts[0])

    def write_then_fail(df, batch_id):
        replay.out.write(df, batch_id)
        raise RuntimeError("lost")

    replay.sink = write_then_fail
    with pytest.raises(Exception, match="lost"):
        replay.run(parts[1])
    replay.sink = replay.out.write
    tails_write = replay.store.tails.write
    replay.store.tails.write = lambda *a: (_ for _ in ()).throw(RuntimeError("again"))
    with pytest.raises(Exception, match="again"):
        replay.run()
    replay.store.tails.write = tails_write
    replay.run(parts[2])
    replay.run()  # nothing new
    got = replay.features()
    assert len(got) == replay.out.read_all(spark).count() == len(rows)
    known = expected(rows)
    assert {k: v[3] for k, v in got.items()} == {k: v[3] for k, v in known.items()}


def test_trim_keeps_each_accounts_newest_slots(spark, tmp_path):
    store = enrichment.EnrichmentStore(f"{tmp_path}/store", keep_slots=1, fold_every=1, buckets=2)
    replay = Replay(spark, tmp_path, store)
    rows = [tx(i, i % 3, i * 700, location=f"L{i}") for i in range(24)]
    for part in chunks(rows, 6):
        replay.run(part)
    assert replay.features() == expected(rows)
    # One slot a snapshot, and those of the batches since.
    slots = store.tails.read(spark).groupBy("account_id").count()
    assert max(r["count"] for r in slots.collect()) < 8
    assert min(store.rows.changes.ids(spark)) > 0 and store.rows.read(spark).count() < len(rows)


def test_no_row_takes_anothers_state_away(spark, tmp_path):
    """An account's row and location stay in the same slot, whatever dates other rows have."""
    day = 86_400
    store = enrichment.EnrichmentStore(f"{tmp_path}/store", keep_slots=2, fold_every=1, buckets=2)
    replay = Replay(spark, tmp_path, store)
    batches = [
        [tx(1, 2, 0, 100.0)], [tx(2, 77, 400 * day)], [tx(3, 5, 30)], [tx(4, 77, 40 * 365 * day)],
        [tx(5, 78, -20 * 365 * day), tx(6, 79, None)], [tx(7, 2, 20, 100.0, location="Dubai")],
        [tx(8, 2, 500 * day)], [tx(9, 2, 40, 50.0)],
    ]
    for batch in batches:
        replay.run(batch)
    got = replay.features()
    assert got[7] == (2, 200.0, 0, "Hue") and got[9] == (3, 250.0, 0, "Dubai")
    so_far = []
    for batch in batches:
        so_far += batch
        assert {r["tx_id"]: got[r["tx_id"]] for r in batch}.items() <= expected(so_far).items()


def test_scenario_with_changing_dimensions(spark, tmp_path):
    """Risk and account status change between the fourth and the fifth transaction."""
    state = {"risk": "LOW", "status": "ACTIVE"}

    def dimensions(account_ids):
        return (
            spark.createDataFrame(
                [(2, 1, "WALLET", state["status"], False, T0)], schemas.ACCOUNT_STATE),
            spark.createDataFrame([(1, state["risk"], False, T0)], schemas.CUSTOMER_STATE),
        )

    replay = Replay(spark, tmp_path, dimensions=dimensions)
    first = [tx(1, 2, 0, 200.0), tx(2, 2, 10, 100.0, "FAILED"), tx(3, 2, 20, 52000.0),
             tx(4, 2, 30, 340.0, location="Dubai")]
    replay.run(first)
    state.update(risk="HIGH", status="FROZEN")
    replay.run([tx(5, 2, 40, 50.0)])
    judged = rules.with_alerts(replay.out.read_all(spark)).orderBy("tx_id").collect()
    spend, travel, failures = rules.SPEND, rules.IMPOSSIBLE_TRAVEL, rules.RECENT_FAILURES
    assert [
        (r.tx_count_1m, r.amount_sum_5m, r.failed_tx_5m, r.last_location,
         [a.code for a in r.alerts]) for r in judged
    ] == [
        (1, 200.0, 0, None, []),
        (2, 200.0, 1, "Hue", [failures]),
        (3, 52200.0, 1, "Hue", [spend, failures]),
        (4, 52540.0, 1, "Hue", [spend, travel, failures]),
        (5, 52590.0, 1, "Dubai", [spend, travel, failures]),
    ]
    assert [(r.customer_risk, r.account_status) for r in judged[3:]] == [
        ("LOW", "ACTIVE"), ("HIGH", "FROZEN")
    ]


def write_in_event_order(spark, rows, path, n):
    """Files with rising modification times: a file stream reads the oldest first."""
    for i, part in enumerate(chunks(rows, n)):
        frame(spark, part).coalesce(1).write.mode("append").parquet(path)
        for name in os.listdir(path):
            full = os.path.join(path, name)
            if name.endswith(".parquet") and os.path.getmtime(full) > 1_600_000_000:
                os.utime(full, (1_500_000_000 + i, 1_500_000_000 + i))


def behavior_store(spark, rows, path, n, delay="10 minutes"):
    write_in_event_order(spark, rows, f"{path}/in", n)
    session = jobs.state_session(spark)
    source = readers.file_stream(session, f"{path}/in", schemas.CLEAN, files_per_trigger=1)
    store = jobs.BehaviorStore(f"{path}/state", fold_every=2, buckets=4)
    jobs.start_behavior(
        spark, source, store, f"{path}/checkpoint", delay=delay, available_now=True
    ).awaitTermination()
    return store


def table_rows(df):
    return {tuple(r) for r in df.select(sorted(df.columns)).collect()}


def test_behavior_stream_equals_batch(spark, tmp_path):
    rows = in_order([r for r in skewed(200) if r["event_time"]])
    store = behavior_store(spark, rows, tmp_path, 4)
    df = frame(spark, rows)
    assert table_rows(store.counts(spark)) == table_rows(behavior.tumbling_counts(df))
    assert table_rows(store.sums(spark)) == table_rows(behavior.sliding_spend(df))
    latest = store.rows(spark).drop("expires_at")
    assert table_rows(latest) == table_rows(behavior.latest_behavior(df))
    newest = max(r.updated_at for r in latest.collect())
    now = F.lit(newest + datetime.timedelta(seconds=600))
    assert store.rows(spark, now).count() < latest.count()
    assert table_rows(store.rows(spark, now).drop("expires_at")) == table_rows(behavior.latest_behavior(df, now=now))
    assert store.panes.snapshots.ids(spark)


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    rows = [tx(1, 1, 7200), tx(2, 1, 7260), tx(3, 1, 0), tx(4, 1, 7000)]
    counts = behavior_store(spark, rows, tmp_path, 4).counts(spark)
    starts = {r.window_start.timestamp() - T0.timestamp() for r in counts.collect()}
    # The third row is two hours late; the fourth is late by less than the ten minutes allowed.
    assert starts == {7200, 7260, 6960}
    late = f"{tmp_path}/late"
    source = readers.file_stream(spark, f"{tmp_path}/in", schemas.CLEAN, files_per_trigger=1)
    jobs.start_late_rows(spark, source, late, f"{tmp_path}/late_checkpoint", available_now=True).awaitTermination()
    [row] = BatchTable(f"{late}/rows").read_all(spark).collect()
    assert (row.tx_id, row.reason, row.watermark) == (3, jobs.LATE, at(6660).replace(tzinfo=None))


def test_panes_are_kept_by_number(spark, tmp_path):
    store = jobs.BehaviorStore(str(tmp_path), keep=6, fold_every=1, buckets=2)
    rows = [tx(i, 1, i * 60, 1.0) for i in range(12)] + [tx(99, 1, 10 ** 9), tx(100, 2, 0)]
    for i, part in enumerate(chunks(rows, 7)):
        store.process(spark, behavior.panes(frame(spark, part)), i)
    store.panes.fold(spark, 7)
    kept = sorted((r.account_id, r.pane) for r in store.panes.read(spark).collect())
    assert len(kept) == 7 and (2, at(0).replace(tzinfo=None)) in kept
    assert {r.account_id: r.tx_count_1m for r in store.rows(spark).collect()} == {1: 1, 2: 1}


def test_lake_stream_restarts_without_copies(spark, tmp_path):
    from test_decode import ROW, event

    raw = f"{tmp_path}/raw"

    def run(*values):
        spark.createDataFrame([(v,) for v in values], "value string").write.mode("append").text(raw)
        source = readers.file_stream(spark, raw, "value string", fmt="text")
        jobs.start_clean(
            source, f"{tmp_path}/checkpoint", f"{tmp_path}/lake", f"{tmp_path}/dead", publish,
            rows_per_file=2, on_counts=counts.__setitem__, available_now=True
        ).awaitTermination()
        return spark.read.parquet(f"{tmp_path}/lake").count()

    counts, published = {}, []

    def publish(pairs):
        published.append(pairs.count())

    assert run(event(after=ROW), event("d", before=ROW), "{bad") == 2
    assert counts == {0: {None: 2, "UNDECODABLE": 1}} and published == [2]

    def fail(pairs):
        raise RuntimeError("no broker")

    # The lake has been written when the topic fails; the retry replaces that.
    publish, good = fail, publish
    with pytest.raises(Exception, match="no broker"):
        run(event("u", after=ROW))
    publish = good
    assert run() == 3 and published == [2, 1, 0]  # the last run has an empty file
    assert run(*[event(after={**ROW, "tx_id": i}) for i in range(9)]) == 12
    [date] = [name for name in os.listdir(f"{tmp_path}/lake") if name.startswith("event_date=")]
    files = [f for f in os.listdir(f"{tmp_path}/lake/{date}/batch=3") if f.endswith(".parquet")]
    assert 2 <= len(files) <= 5
    assert [r.reason for r in BatchTable(f"{tmp_path}/dead").read_all(spark).collect()] == ["UNDECODABLE"]
    assert "event_date=2026-02-16" in os.listdir(f"{tmp_path}/lake")


def test_dimension_stream_publishes_and_keeps_state(spark, tmp_path):
    from test_decode import ACCOUNT, event

    published = []
    state = jobs.account_state(f"{tmp_path}/state", fold_every=1, keep_log=True)

    def run(*values):
        spark.createDataFrame([(v,) for v in values], "value string").write.mode("append").text(
            f"{tmp_path}/raw")
        source = readers.file_stream(spark, f"{tmp_path}/raw", "value string", fmt="text")
        jobs.start_dimension(
            spark, dims.account_changes(source), state, f"{tmp_path}/checkpoint",
            publish=lambda df: published.extend(df.collect()), available_now=True,
        ).awaitTermination()
        accounts, customers = jobs.dimension_tables(
            spark, state, jobs.customer_state(f"{tmp_path}/none"))
        assert customers.count() == 0
        return {r.account_id: r.status for r in accounts.collect()}

    assert run(event(after=ACCOUNT, ts_ms=1000)) == {12: "ACTIVE"}
    assert run(event("u", after={**ACCOUNT, "status": "FROZEN"}, ts_ms=2000)) == {12: "FROZEN"}
    assert run(event("d", before={"account_id": 12}, ts_ms=3000),
               event(after={**ACCOUNT, "account_id": 13})) == {12: "DELETED", 13: "ACTIVE"}
    assert state.log(spark).count() == 4
    assert published[0].key == "12" and '"updated_at":"1970-01-01T00:00:01.000Z"' in published[0].value


def test_dimension_tables_of_some_accounts(spark, tmp_path):
    accounts = jobs.account_state(f"{tmp_path}/accounts")
    customers = jobs.customer_state(f"{tmp_path}/customers")
    order = ", ts_ms long, lsn long"
    accounts.write(spark.createDataFrame(
        [(i, i % 3, "CARD", "ACTIVE", False, T0, 1, i) for i in range(9)],
        "account_id int, customer_id int, account_type string, status string, "
        "is_deleted boolean, updated_at timestamp" + order), 0)
    customers.write(spark.createDataFrame(
        [(i, "LOW", False, T0, 1, i) for i in range(9)],
        "customer_id int, risk_level string, is_deleted boolean, updated_at timestamp" + order), 0)
    ids = spark.createDataFrame([(1,), (4,), (5,), (99,)], "account_id int")
    some_accounts, some_customers = jobs.dimension_tables(spark, accounts, customers, ids)
    assert {r.account_id for r in some_accounts.collect()} == {1, 4, 5}
    assert {r.customer_id for r in some_customers.collect()} == {1, 2}


@pytest.mark.parametrize("keep_log, changes", [(False, [4, 5, 6]), (True, list(range(7)))])
def test_keyed_state_reads_as_of_a_batch(spark, tmp_path, keep_log, changes):
    state = KeyedState(str(tmp_path), ["k"], ["v"], fold_every=2, keep_log=keep_log, buckets=1)
    assert state.read(spark) is None
    for i in range(7):
        state.fold(spark, i)
        state.write(spark.createDataFrame([(i % 2, i), (9, -i)], "k int, v int"), i)
    for before in (5, 7, None):
        n = 7 if before is None else before
        rows = {r.k: r.v for r in state.read(spark, before).collect()}
        assert rows == {i % 2: max(j for j in range(n) if j % 2 == i % 2) for i in range(2)} | {9: 0}
    assert state.snapshots.ids(spark) == [4, 6] and state.changes.ids(spark) == changes
    assert state.changes.ids(spark, since=5) == [5, 6]


def test_reads_and_folds_touch_their_buckets_only(spark, tmp_path):
    state = KeyedState(f"{tmp_path}/a", ["k"], ["v"], fold_every=2, buckets=32)
    state.write(spark.range(400).selectExpr("cast(id as int) k", "0 v"), 0)
    for i in range(1, 5):
        state.fold(spark, i)
        state.write(spark.createDataFrame([(7, i), (8, i)], "k int, v int"), i)
    keys = spark.createDataFrame([(7,), (8,), (9,)], "k int")
    buckets = state._buckets_of(keys)
    assert len(buckets) <= 3
    rows = state.read(spark, only=keys)
    assert {(r.k, r.v) for r in rows.collect()} == {(7, 4), (8, 4), (9, 0)}
    files = {name.split("bucket=")[1].split("/")[0] for name in rows.inputFiles()}
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert files <= set(map(str, buckets)) or "PartitionFilters: [bucket" in plan
    assert "PartitionFilters" in plan and "bucket" in plan.split("PartitionFilters")[1].split("]")[0]
    # The other buckets never had two change sets, so they were not rewritten.
    assert set().union(*state.snapshots.buckets(spark).values()) <= buckets
    assert state.read(spark).count() == 400
    with pytest.raises(ValueError, match="16 buckets"):
        KeyedState(f"{tmp_path}/a", ["k"], ["v"], buckets=16).write(keys.selectExpr("k", "1 v"), 9)


def test_folders_stay_bounded(spark, tmp_path):
    state = KeyedState(str(tmp_path), ["k"], ["v"], fold_every=3, buckets=2)
    for i in range(30):
        state.fold(spark, i)
        state.write(spark.createDataFrame([(i % 5, i)], "k int, v int"), i)
    assert {r.k: r.v for r in state.read(spark).collect()} == {k: 25 + k for k in range(5)}
    assert len(state.changes.ids(spark)) <= 2 * 2 * 3 and len(state.snapshots.ids(spark)) <= 4


def test_log_keeps_every_row_once(spark, tmp_path):
    log = BucketedLog(str(tmp_path), "k", fold_every=2, buckets=2)
    for i in range(7):
        log.fold(spark, i)
        log.write(spark.createDataFrame([(1, "same"), (2, "same"), (1, "same")], "k int, v string"), i)
    assert log.read(spark).groupBy("k").count().collect() and log.read(spark).count() == 21
    assert log.read(spark, before=4).count() == 12
    assert log.read(spark, only=spark.createDataFrame([(1,)], "k int")).count() == 14


def test_judged_topic(spark):
    enriched = spark.createDataFrame([(
        '{"tx_id":1,"account_id":2,"failed_tx_5m":1,"unknown":3}',), ("{",)], "value string")
    verdicts, dead = jobs.judge_topic(enriched)
    assert [(r.tx_id, r.verdict) for r in verdicts.collect()] == [(1, rules.ALERT)]
    assert dead.count() == 1


def test_topic_options():
    options = readers.topic_options("broker:9092", readers.CLEAN_TOPIC, max_offsets_per_trigger=5,
                                    failOnDataLoss="false")
    assert options == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "transactions_clean",
        "startingOffsets": "latest", "maxOffsetsPerTrigger": "5", "failOnDataLoss": "false",
    }


def test_lake_files_per_date(spark, tmp_path):
    df = frame(spark, [tx(i, 1, i) for i in range(200)]).repartition(20)
    sinks.write_lake(df, str(tmp_path), files_per_date=2)
    files = [f for f in os.listdir(f"{tmp_path}/event_date=2025-12-29") if f.endswith(".parquet")]
    assert len(files) <= 2


def test_one_failing_query_ends_all(spark, tmp_path):
    """Also of another session than the application's own."""
    session = jobs.state_session(spark)
    rows = session.readStream.format("rate").load()

    def start(name, process):
        return rows.writeStream.foreachBatch(process).option("checkpointLocation", f"{tmp_path}/{name}").start()

    def fail(batch, batch_id):
        raise RuntimeError("no store")

    queries = [start("good", lambda batch, batch_id: None), start("bad", fail)]
    with pytest.raises(Exception, match="no store"):
        jobs.await_any(queries)
    assert not any(query.isActive for query in queries)


def test_whole_accounts_and_slots_give_the_same(spark):
    """Accounts that are worked out whole, and dense ones by slots, with context, several tails of a slot and profiles."""
    rows = in_order(skewed(300)) + [tx(9000, 1, 700, 9.9e15), tx(9001, 1, 701, 9.9e15), tx(9002, 1, 702, -9.9e15)]
    early, late = rows[:120], rows[120:]
    near, df = frame(spark, early), frame(spark, late)
    accounts = spark.createDataFrame([(1, "GOLD"), (2, "BASE")], "account_id int, kind string")
    tails = behavior.slot_tails(near, 900)
    want = behavior.trailing_features(df, context=near, earlier_tails=tails, profiles=accounts)
    known = {r.tx_id: r for r in want.collect()}
    assert len(known) == len(late)
    for dense in ([], [1]):
        got = behavior.trailing_features_by_account(
            df, context=near, earlier_tails=behavior.row_tails(near, 900), profiles=accounts, dense=dense)
        assert got.columns == want.columns and got.dtypes == want.dtypes
        assert {r.tx_id: r for r in got.collect()} == known
    # The rows move once, and no slot is put in order.
    plan = behavior.trailing_features_by_account(df, context=near, earlier_tails=tails)
    plan = plan._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1 and "slot#" not in plan[: plan.index("REPARTITION_BY_COL")]


def test_dense_accounts_of_a_micro_batch_are_cut(spark, tmp_path):
    rows = in_order(skewed(300))
    store = enrichment.EnrichmentStore(f"{tmp_path}/store", fold_every=2, most_rows=20)
    replay = Replay(spark, tmp_path, store)
    for part in chunks(rows, 4):
        replay.run(part)
    assert replay.features() == expected(rows)


def test_rows_are_not_trimmed_for_nothing(spark, tmp_path, monkeypatch):
    """An account with fewer rows than slots are kept loses none, so its rows need no order when folded."""
    rows = [tx(i, i % 3, i * 2000) for i in range(60)]
    trimmed = []
    monkeypatch.setattr(enrichment, "newest_slots", lambda *a: trimmed.append(a) or a[0])
    replay = Replay(spark, tmp_path)
    for part in chunks(rows, 4):
        replay.run(part)
    assert not trimmed and replay.store.tails.snapshots.ids(spark)
    assert replay.features() == expected(rows)
