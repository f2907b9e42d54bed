import json

import pytest

from test_decode import ACCOUNT, ROW, event
from txrisk import app
from txrisk.operators import rules


def lines(spark, path, *values):
    spark.createDataFrame([(v,) for v in values], "value string").coalesce(1).write.mode(
        "append").text(path)


def test_whole_chain_over_folders(spark, tmp_path):
    """Change events in, verdicts out, each job in turn; then more events, and again."""

    def run(job, source, **options):
        argv = [job, "--input", f"{tmp_path}/{source}", "--checkpoint", f"{tmp_path}/checkpoint",
                "--once"]
        for name, value in options.items():
            argv += [f"--{name}", f"{tmp_path}/{value}"]
        app.run(spark, app.parser().parse_args(argv))

    def chain():
        run("accounts", "accounts", state="state")
        run("customers", "customers", state="state")
        run("clean", "tx", lake="lake")
        run("behavior", "lake", state="state")
        run("enrich", "lake", state="state", output="enriched")
        judged = spark.read.parquet(f"{tmp_path}/enriched_verdicts")
        return {r.tx_id: [a.code for a in r.alerts] for r in judged.collect()}

    def pay(tx_id, seconds, **changes):
        micros = 1771234567890123 + seconds * 1_000_000
        return event(after={**ROW, "tx_id": tx_id, "created_at": micros, **changes}, lsn=tx_id)

    lines(spark, f"{tmp_path}/accounts", event(after={**ACCOUNT, "account_id": 1}))
    lines(spark, f"{tmp_path}/customers", event(after={"customer_id": 4, "risk_level": "LOW"}))
    lines(spark, f"{tmp_path}/tx", pay(1, 0, amount="200.00"),
          pay(2, 10, amount="100.00", status="FAILED"), "broken")
    assert chain() == {1: [], 2: [rules.RECENT_FAILURES]}

    lines(spark, f"{tmp_path}/customers",
          event("u", after={"customer_id": 4, "risk_level": "HIGH"}, ts_ms=1771234577000))
    lines(spark, f"{tmp_path}/tx", pay(3, 20, amount="52000.00", location="Dubai"))
    assert chain() == {
        1: [], 2: [rules.RECENT_FAILURES],
        3: [rules.HIGH_RISK_AMOUNT, rules.SPEND, rules.IMPOSSIBLE_TRAVEL, rules.RECENT_FAILURES],
    }

    lines(spark, f"{tmp_path}/wire", json.dumps({"tx_id": 9, "account_id": 1, "tx_count_1m": 6}))
    run("rules", "wire", output="verdicts")
    [row] = spark.read.parquet(f"{tmp_path}/verdicts").collect()
    assert (row.tx_id, row.verdict) == (9, rules.ALERT)


def test_a_source_and_a_checkpoint_are_needed():
    for argv in (["clean", "--lake", "x", "--checkpoint", "y"],
                 ["clean", "--lake", "x", "--input", "y"],
                 ["enrich", "--input", "x", "--checkpoint", "y", "--state", "z"]):
        with pytest.raises(SystemExit):
            app.parser().parse_args(argv)
