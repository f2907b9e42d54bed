"""Every registered query against its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry
import oracle
from txrisk.plans import catalog, streams

QUERIES, SQL = entry.queries(), entry.oracle_sql()


def test_queries_without_sql_are_of_the_llm_subpackage():
    assert SQL.keys() <= QUERIES.keys()
    assert not (QUERIES.keys() - SQL.keys()) & (catalog.BATCH.keys() | streams.STREAMS.keys())


@pytest.mark.parametrize("name", SQL)
def test_query(spark, small, name):
    columns, types, rows = oracle.spark_bag(QUERIES[name](spark, small))
    sql_columns, sql_types, sql_rows = oracle.sql_bag(small, SQL[name])
    assert columns == sql_columns
    assert types == {c: oracle.SAME_TYPE[t] for c, t in sql_types.items()}
    assert sum(rows.values()) > 0 and rows == sql_rows


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r.verdict for r in rows} == {"ALERT", "SAFE"}
    fired = {code for r in rows for code in r.codes.split(",") if code}
    assert fired == {
        "HIGH_RISK_AMOUNT", "VELOCITY", "SPEND", "IMPOSSIBLE_TRAVEL", "RECENT_FAILURES"
    }
