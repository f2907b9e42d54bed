"""What the plans must look like to hold at scale."""

import re

from txrisk import schemas
from txrisk.operators import behavior, decode, enrich
from txrisk.plans import catalog
from txrisk.plans import tables as T


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def nodes(plan, name):
    return re.findall(rf"(?m)^[\s:+*()\d-]*{name}\b.*$", plan)


def test_trailing_features_shuffle_and_sort_rows_once(spark, small):
    plan = physical(behavior.trailing_features(catalog.transactions(spark, small)))
    assert plan.count("REPARTITION_BY_COL") == 1
    left = plan[: plan.index("REPARTITION_BY_COL")]
    assert len(nodes(left, "Sort")) == 1 and len(nodes(left, "Window")) == 2


def test_enrichment_shuffles_transactions_once(spark, small):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = physical(catalog.enriched(spark, small, catalog.transactions(spark, small)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # The wide rows move once; every other exchange is of slot tails or dimensions.
    assert plan.count("REPARTITION_BY_COL") == 1
    joined = [line for line in nodes(plan, "SortMergeJoin") if "slot" in line]
    assert len(joined) == 1
    above = plan[: plan.index("SortMergeJoin")]
    assert "Exchange" not in above and "Python" not in plan


def test_window_tables_combine_before_the_shuffle(spark, small):
    tx = catalog.transactions(spark, small)
    for df in (behavior.tumbling_counts(tx), behavior.sliding_spend(tx),
               behavior.latest_behavior(tx)):
        assert "partial_" in physical(df)
    # Rows are copied into the windows that cover them after they have been combined.
    plan = physical(behavior.sliding_spend(tx))
    assert plan.index("Expand") < plan.rindex("Exchange")


def test_latest_state_combines_before_the_shuffle(spark, small):
    plan = physical(catalog.account_state_latest(spark, small))
    assert "partial_max_by" in plan and "Window" not in plan


def test_scan_reads_needed_columns_only(spark, small):
    tx = catalog.transactions(spark, small)
    plan = physical(behavior.tumbling_counts(tx))
    scan = nodes(plan, "FileScan parquet")[0]
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in scan
    plan = physical(behavior.slot_tails(tx, 900))
    assert "event_type" not in nodes(plan, "FileScan parquet")[0]


def test_lake_dates_prune_folders(spark, small):
    lake = catalog.landed(spark, catalog.transactions(spark, small))
    plan = physical(lake.filter("event_date = DATE'2024-01-05'"))
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_filters_reach_the_scan(spark, small):
    changes = T.signup_account_changes(catalog.events(spark, small))
    assert "EqualTo(event_type,signup)" in physical(changes)


def test_behaviour_reads_the_fields_it_needs(spark):
    """The topic's messages are parsed for six fields, not for all."""
    raw = spark.createDataFrame([("{}",)], "value string")
    plan = physical(behavior.panes(decode.usable_flat(raw, schemas.BEHAVIOR_WIRE)))
    parse = re.search(r"from_json\(StructField\((.*?)\), \(", plan) or re.search(r"from_json\((.*?)value#", plan)
    names = set(re.findall(r"StructField\((\w+),", "StructField(" + parse.group(1)))
    assert names == {*schemas.BEHAVIOR_WIRE.names, schemas.CORRUPT}


def scans(plan):
    return len(nodes(plan, "FileScan parquet"))


def test_features_read_their_input_twice_and_previous_ones_once(spark, small):
    tx = catalog.transactions(spark, small)
    assert scans(physical(behavior.trailing_features(tx))) == 2
    plan = physical(behavior.fresh_previous_behavior(tx))
    assert scans(plan) == 1 and plan.count("Exchange hashpartitioning") == 1
    plan = physical(catalog.behavior_asof_join(spark, small))
    assert scans(plan) == 2 and plan.count("Exchange hashpartitioning") <= 1
    assert scans(physical(catalog.dim_enrich_asof(spark, small))) <= 6
    # Columns that aren't asked for are neither read nor moved.
    plan = physical(behavior.trailing_features(tx).select("tx_id", "tx_count_1m"))
    assert "D" not in re.findall(r"concat\((\w)", plan)
