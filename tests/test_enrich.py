import datetime
import random

import pytest
from pyspark.sql import functions as F

from rows import T0, at, expected, frame, tx
from txrisk import schemas
from txrisk.operators import asof, behavior, enrich, rules
from txrisk.operators.behavior import Windows
from txrisk.operators.slots import dense_cuts

UTC = datetime.timezone.utc


def accounts(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.ACCOUNT_STATE)


def customers(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.CUSTOMER_STATE)


def test_scenario(spark):
    """Five transactions of one account, its customer's risk already raised."""
    rows = [
        tx(1, 2, 0, 200.0), tx(2, 2, 10, 100.0, "FAILED"), tx(3, 2, 20, 52000.0),
        tx(4, 2, 30, 340.0, location="Dubai"), tx(5, 2, 40, 50.0),
    ]
    dims = (accounts(spark, (2, 1, "WALLET", "FROZEN", False, T0)),
            customers(spark, (1, "HIGH", False, T0)))
    enriched = enrich.enrich(frame(spark, rows), *dims)
    assert enriched.columns == list(schemas.ENRICHED_COLUMNS)
    judged = rules.with_alerts(enriched).orderBy("tx_id").collect()
    got = [
        (r.tx_count_1m, r.amount_sum_5m, r.failed_tx_5m, r.last_location,
         [a.code for a in r.alerts]) for r in judged
    ]
    spend, travel, failures = rules.SPEND, rules.IMPOSSIBLE_TRAVEL, rules.RECENT_FAILURES
    assert got == [
        (1, 200.0, 0, None, []),
        (2, 200.0, 1, "Hue", [failures]),
        # 52000 is above the amount limit too, and the customer is HIGH here from the start
        (3, 52200.0, 1, "Hue", [rules.HIGH_RISK_AMOUNT, spend, failures]),
        (4, 52540.0, 1, "Hue", [spend, travel, failures]),
        (5, 52590.0, 1, "Dubai", [spend, travel, failures]),
    ]
    assert {(r.account_status, r.customer_risk) for r in judged} == {("FROZEN", "HIGH")}


def test_missing_dimensions(spark):
    rows = [tx(i, i, 0) for i in range(1, 6)]
    got = enrich.enrich(
        frame(spark, rows),
        accounts(spark, (1, 7, "CARD", "ACTIVE", False, T0), (2, 0, "CARD", "ACTIVE", False, T0),
                 (3, None, "CARD", "ACTIVE", False, T0), (4, 8, "CARD", "DELETED", True, T0)),
        customers(spark, (7, None, False, T0), (0, "HIGH", False, T0), (8, "LOW", True, T0)),
    )
    rows = {r.tx_id: (r.customer_id, r.account_status, r.customer_risk) for r in got.collect()}
    assert rows == {
        1: (7, "ACTIVE", "UNKNOWN"), 2: (0, "ACTIVE", "UNKNOWN"), 3: (None, "ACTIVE", "UNKNOWN"),
        4: (8, "DELETED", "LOW"), 5: (None, None, "UNKNOWN"),
    }


def test_wire_format(spark):
    dims = (accounts(spark, (1, 1, "CARD", "ACTIVE", False, at(0.971))),
            customers(spark, (1, "LOW", False, at(0.058))))
    enriched = enrich.enrich(frame(spark, [tx(1, 1, 27), tx(2, 1, 28.181)]), *dims)
    rows = enrich.wire_format(enriched).orderBy("tx_id").collect()
    assert [r.event_time for r in rows] == ["2025-12-29T11:30:27", "2025-12-29T11:30:28.181000"]
    assert rows[0].event_date == "2025-12-29"
    assert rows[0].account_updated_at == "2025-12-29T11:30:00.971Z"
    assert rows[0].customer_updated_at == "2025-12-29T11:30:00.058Z"
    assert rows[0].enriched_at.endswith("Z") and len(rows[0].enriched_at) == 27


def skewed(n=600, seed=5):
    """A third of the rows on one account; ties, missing accounts and times, bursts, gaps."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        account = 1 if i % 3 == 0 else rng.choice([2, 3, 4, 5, None])
        seconds = rng.choice([rng.randrange(0, 900), rng.randrange(0, 9000), 60 * rng.randrange(9),
                              rng.uniform(0, 4000)])
        rows.append(tx(
            i, account, None if rng.random() < 0.02 else round(seconds, 6),
            rng.choice([None, round(rng.uniform(0, 500), 2)]),
            rng.choice(["SUCCESS", "FAILED", "PENDING", None]),
            rng.choice(["Hue", "Hanoi", "", None]),
            rng.choice(["INSERT", "UPDATE", "DELETE"]),
        ))
    return rows


def features(df):
    names = ("tx_count_1m", "amount_sum_5m", "failed_tx_5m", "last_location")
    return {r.tx_id: tuple(r[n] for n in names) for r in df.collect()}


@pytest.mark.parametrize("slot", [7, 300, 900, 100_000])
def test_trailing_features_against_all_pairs(spark, slot):
    rows = skewed()
    got = behavior.trailing_features(frame(spark, rows), Windows(slot=slot))
    assert features(got) == expected(rows)


@pytest.mark.parametrize("types", [["INSERT"], ["INSERT", "UPDATE"]])
def test_trailing_features_of_some_event_types(spark, types):
    rows = skewed(300, seed=9)
    got = behavior.trailing_features(frame(spark, rows), Windows(slot=300), event_types=types)
    want = expected(rows, types=types)
    assert features(got) == want


def test_window_ends_belong_to_the_window(spark):
    rows = [tx(1, 1, 0, 5.0), tx(2, 1, 60, 7.0), tx(3, 1, 300, 1.0), tx(4, 1, 300.000001, 2.0)]
    got = features(behavior.trailing_features(frame(spark, rows)))
    assert [got[i][:2] for i in (1, 2, 3, 4)] == [(1, 5.0), (2, 12.0), (1, 13.0), (2, 10.0)]


def largest_group(plan_input, windows=behavior.DEFAULT, cuts=None):
    marks = behavior._marks(behavior._entering(plan_input.withColumn("_emit", F.lit(True)), windows, None, cuts), windows)
    return marks.groupBy("account_id", "slot").count().agg(F.max("count")).first()[0]


@pytest.mark.parametrize("windows", [Windows(), Windows(count=5000, spend=20000)])
def test_hot_account_is_split_over_slots(spark, windows):
    """However long the windows are compared with the slots."""
    rows = [tx(i, 1, i * 10) for i in range(900)]
    assert largest_group(frame(spark, rows), windows) <= 3 * 90
    got = features(behavior.trailing_features(frame(spark, rows), windows))
    assert got == expected(rows, windows.count, windows.spend)


def test_rows_without_account_are_spread(spark):
    rows = [tx(i, None, 0, event_type="DELETE") for i in range(500)]
    assert largest_group(frame(spark, rows)) <= 4


def test_impossible_amounts_add_nothing_and_do_not_fail(spark):
    rows = [tx(1, 1, 0, float("inf")), tx(2, 1, 1, float("nan")), tx(3, 1, 2, 1.5)]
    got = features(behavior.trailing_features(frame(spark, rows)))
    assert got[3][:2] == (3, 1.5)
    many = [tx(i, 1, i / 100, 9.9e15) for i in range(40)]
    got = features(behavior.trailing_features(frame(spark, many)))
    assert got[39][1] == pytest.approx(40 * 9.9e15)


def test_fresh_previous_behavior(spark):
    rows = [tx(1, 1, 0, 5.0), tx(2, 1, 599.999999, 7.0), tx(3, 1, 1200, 1.0),
            tx(4, 1, 1799.999998, 1.0), tx(5, 2, 1800, 1.0)]
    got = {
        r.tx_id: (r.previous_found, r.previous_tx_count_1m, r.previous_amount_sum_5m)
        for r in behavior.fresh_previous_behavior(frame(spark, rows)).collect()
    }
    assert got == {1: (False, 0, 0.0), 2: (True, 1, 5.0), 3: (False, 0, 0.0),
                   4: (True, 1, 1.0), 5: (False, 0, 0.0)}


def test_fresh_previous_behavior_does_not_depend_on_slots(spark):
    df = frame(spark, [r for r in skewed(400) if r["event_time"]])

    def result(slot):
        rows = behavior.fresh_previous_behavior(df, Windows(slot=slot))
        return sorted(map(tuple, rows.select(
            "tx_id", "previous_found", "previous_tx_count_1m", "previous_amount_sum_5m",
            "previous_failed_tx_5m",
        ).collect()))

    assert result(900) == result(200_000)


def test_sliding_tables_agree_with_direct_windows(spark):
    df = frame(spark, skewed())
    panes = behavior.sliding_spend(df)
    direct = (
        df.filter("account_id IS NOT NULL AND event_time IS NOT NULL")
        .groupBy("account_id", F.window("event_time", "5 minutes", "1 minute"))
        .agg(F.sum(F.when(F.col("status") == "SUCCESS", F.col("amount")).otherwise(0)).alias("s"),
             F.count(F.when(F.col("status") == "FAILED", 1)).alias("f"))
    )
    got = {(r.account_id, r.window_start): (r.sum_5m, r.fail_5m) for r in panes.collect()}
    want = {(r.account_id, r.window.start): (r.s, r.f) for r in direct.collect()}
    assert got.keys() == want.keys()
    for key, (total, failures) in want.items():
        assert got[key] == (pytest.approx(total or 0.0), failures)


def test_latest_behavior_freshness(spark):
    df = frame(spark, [tx(1, 1, 0), tx(2, 2, 900)])
    now = F.lit(at(960))
    assert [r.account_id for r in behavior.latest_behavior(df, now=now).collect()] == [2]
    assert behavior.latest_behavior(df).count() == 2


def versions_by_hand(facts, versions, strict=False, within=None):
    out = {}
    for fid, key, t in facts:
        fit = [
            v for v in versions
            if key is not None and t is not None and v[0] == key
            and (v[1] < t or (v[1] == t and not strict))
            and (within is None or (t - v[1]).total_seconds() < within)
        ]
        best = max(fit, key=lambda v: (v[1], v[2]), default=None)
        out[fid] = best and best[2]
    return out


@pytest.mark.parametrize("options", [
    {}, {"strict": True}, {"within": 600}, {"strict": True, "within": 50, "slot": 60}, {"slot": 7},
])
def test_asof_join_against_all_pairs(spark, options):
    rng = random.Random(3)
    keys = [1, 1, 1, 2, 3, None]
    facts = [
        (i, rng.choice(keys), None if rng.random() < 0.05 else at(rng.randrange(3000)))
        for i in range(300)
    ]
    versions = [(rng.choice([1, 1, 2, 4]), at(rng.randrange(-500, 3000)), i) for i in range(120)]
    got = asof.asof_join(
        spark.createDataFrame(facts, "id int, k int, t timestamp"),
        spark.createDataFrame(versions, "k int, v timestamp, n int"),
        "k", "t", "v", ["n"], **options,
    )
    want_options = {k: v for k, v in options.items() if k != "slot"}
    want = versions_by_hand(facts, versions, **want_options)
    assert {r.id: r.version and r.version.n for r in got.collect()} == want


def test_a_dense_slot_is_cut(spark):
    """A hundred thousand rows of one account within a slot, most of them within one second."""
    n = 100_000
    seconds = [i * 800 / n for i in range(n // 10)] + [400 + i / n for i in range(n - n // 10)]
    rows = [tx(i, 1, s, 1.0) for i, s in enumerate(seconds)] + [tx(n, 2, 5)]
    df = frame(spark, rows).repartition(8)
    cuts = behavior.dense_account_cuts(df, most_rows=2000).cache()
    assert [r.account_id for r in cuts.collect()] == [1]
    assert largest_group(df) > n
    # Quantiles are approximate.
    assert largest_group(df, cuts=cuts) < 2 * 2000
    plain = behavior.trailing_features(df).select("tx_id", *behavior.FEATURES, "last_location")
    cut = behavior.trailing_features(df, cuts=cuts).select("tx_id", *behavior.FEATURES, "last_location")
    assert cut.exceptAll(plain).count() == 0 and cut.count() == n + 1
    with pytest.raises(ValueError, match="cut"):
        behavior.trailing_features(df, earlier_tails=df, cuts=cuts)


def test_rows_at_one_time_stay_together(spark):
    rows = [tx(i, 1, 0) for i in range(50)] + [tx(50 + i, 1, 1 + i) for i in range(50)]
    df = frame(spark, rows)
    cuts = behavior.dense_account_cuts(df, most_rows=5)
    assert features(behavior.trailing_features(df, cuts=cuts)) == expected(rows)


@pytest.mark.parametrize("within", [1, 60, 100_000])
def test_previous_behavior_on_skewed_rows(spark, within):
    rows = skewed(300)
    windows = Windows(freshness=within)
    got = {
        r.tx_id: (r.previous_found, r.previous_tx_count_1m, r.previous_amount_sum_5m, r.previous_failed_tx_5m)
        for r in behavior.fresh_previous_behavior(frame(spark, rows), windows).collect()
    }
    known, want = expected(rows), {}
    for r in rows:
        earlier = [o for o in rows if r["event_time"] and o["event_time"] and r["account_id"] is not None
                   and o["account_id"] == r["account_id"] and o["event_time"] < r["event_time"]]
        last = max(earlier, key=lambda o: o["event_time"], default=None)
        fresh = last is not None and (r["event_time"] - last["event_time"]).total_seconds() < within
        want[r["tx_id"]] = (True, *known[last["tx_id"]][:3]) if fresh else (False, 0, 0.0, 0)
    assert got == want


def test_asof_within_and_cut(spark):
    """Versions that expire, and slots cut by density, against all pairs."""
    rng = random.Random(6)
    facts = [(i, rng.randint(0, 2), at(rng.randint(0, 3000) / 2)) for i in range(200)] + [(900, None, at(0)), (901, 1, None)]
    versions = [(i, rng.randint(0, 2), at(rng.randint(0, 3000) / 2)) for i in range(150)]
    f = spark.createDataFrame(facts, "id int, k int, t timestamp")
    v = spark.createDataFrame(versions, "vid int, k int, t timestamp")
    cuts = dense_cuts(f, "k", F.unix_micros("t"), 7200, 10)

    def plain(within, strict):
        found = {}
        for i, k, t in facts:
            earlier = [(vt, vid) for vid, vk, vt in versions if vk == k and t and (vt < t or (vt == t and not strict))]
            best = max(earlier, default=None)
            young = best and (within is None or (t - best[0]).total_seconds() < within)
            found[i] = best[1] if young else None
        return found

    for within in (1, 100, 5000):
        for strict in (False, True):
            got = asof.asof_join(f, v, "k", "t", "t", ["vid"], slot=120, strict=strict, within=within)
            assert {r.id: r.version and r.version.vid for r in got.collect()} == plain(within, strict)
    got = asof.asof_join(f, v, "k", "t", "t", ["vid"], slot=7200, cuts=cuts)
    assert {r.id: r.version and r.version.vid for r in got.collect()} == plain(None, False)


def test_asof_shuffles_sparse_keys_once(spark):
    """Facts and versions of keys that a task can hold move once, without slots; dense keys have theirs."""
    rng = random.Random(8)
    facts = [(i, rng.choice([1, 1, 1, 2, 3, None]), at(rng.randrange(-9, 9) * 86400)) for i in range(200)]
    versions = [(rng.choice([1, 1, 2, 4]), at(rng.randrange(-9, 9) * 86400), i) for i in range(80)]
    f = spark.createDataFrame(facts, "id int, k int, t timestamp")
    v = spark.createDataFrame(versions, "k int, v timestamp, n int")
    want = versions_by_hand(facts, versions)
    for most_rows in (1000, 60, 0):
        got = asof.asof_join(f, v, "k", "t", "v", ["n"], most_rows=most_rows)
        plan = got._jdf.queryExecution().executedPlan().toString()
        if most_rows == 1000:
            assert plan.count("Exchange hashpartitioning") == 1
        assert {r.id: r.version and r.version.n for r in got.collect()} == want
