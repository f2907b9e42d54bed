"""The continuous queries as applications: `spark-submit txrisk/app.py <job> ...`.

Each job reads a topic (`--servers`) or, without one, the files of a folder (`--input`): lines of
messages for change events and enriched JSON, the parquet lake for clean transactions.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txrisk import schemas  # noqa: E402
from txrisk.operators import decode, dims, enrich, rules  # noqa: E402
from txrisk.session import build_session  # noqa: E402
from txrisk.sources import readers, sinks  # noqa: E402
from txrisk.sources.state import BatchTable  # noqa: E402
from txrisk.streaming import enrichment, jobs  # noqa: E402


def _messages(spark, args, topic):
    if args.servers:
        return readers.topic_stream(
            spark, args.servers, topic, starting_offsets=args.starting_offsets,
            max_offsets_per_trigger=args.max_offsets,
        )
    return readers.file_stream(spark, args.input, "value string", fmt="text")


def _clean(spark, args, schema=schemas.CLEAN):
    """Clean transactions, of a topic only those that can be used, with the fields of `schema`."""
    if args.servers:
        return decode.usable_flat(_messages(spark, args, readers.CLEAN_TOPIC), schema)
    return readers.file_stream(spark, args.input, schemas.CLEAN).select(*schema.names)


def _clean_dead_letters(spark, args, job):
    """Messages of the clean topic that `job` passes over, if a folder for them is given."""
    if not (args.servers and args.dead_letters):
        return []
    raw = _messages(spark, args, readers.CLEAN_TOPIC)
    return [jobs.start_flat_dead_letters(
        raw, schemas.CLEAN, args.dead_letters, f"{args.checkpoint}/{job}_dead_letters", args.once
    )]


def _publisher(args, topic):
    return (lambda pairs: sinks.write_topic(pairs, args.servers, topic)) if args.servers else None


def clean(spark, args):
    raw = _messages(spark, args, readers.TRANSACTION_CHANGES)
    return [jobs.start_clean(
        raw, f"{args.checkpoint}/clean", args.lake, args.dead_letters,
        _publisher(args, readers.CLEAN_TOPIC), args.precision, available_now=args.once,
    )]


def _dimension(spark, args, name, topic, state_topic, changes, state, row):
    raw = _messages(spark, args, topic)
    queries = [jobs.start_dimension(
        spark, changes(raw), state, f"{args.checkpoint}/{name}", _publisher(args, state_topic), args.once,
    )]
    if args.dead_letters:
        rejected = decode.rejected_changes(raw, row, state.by)
        queries.append(sinks.start_rows_sink(
            rejected, args.dead_letters, f"{args.checkpoint}/{name}_dead_letters", args.once))
    return queries


def _kept(args):
    return {"keep_log": args.keep_log, "buckets": args.buckets}


def accounts(spark, args):
    return _dimension(
        spark, args, "accounts", readers.ACCOUNT_CHANGES, readers.ACCOUNT_STATE_TOPIC,
        dims.account_changes, jobs.account_state(f"{args.state}/accounts", **_kept(args)), schemas.ACCOUNT_ROW,
    )


def customers(spark, args):
    return _dimension(
        spark, args, "customers", readers.CUSTOMER_CHANGES, readers.CUSTOMER_STATE_TOPIC,
        dims.customer_changes, jobs.customer_state(f"{args.state}/customers", **_kept(args)), schemas.CUSTOMER_ROW,
    )


def behavior(spark, args):
    store = jobs.BehaviorStore(
        f"{args.state}/behavior", keep=args.keep_panes, keep_log=args.keep_log, buckets=args.buckets)
    session = jobs.state_session(spark)
    return [jobs.start_behavior(
        spark, _clean(session, args, schemas.BEHAVIOR_WIRE), store, f"{args.checkpoint}/behavior",
        event_types=args.event_types, available_now=args.once,
    ), *_clean_dead_letters(spark, args, "behavior")]


def enriched(spark, args):
    store = enrichment.EnrichmentStore(f"{args.state}/enrichment", buckets=args.buckets)
    account_state = jobs.account_state(f"{args.state}/accounts", buckets=args.buckets)
    customer_state = jobs.customer_state(f"{args.state}/customers", buckets=args.buckets)
    limit = _thresholds(args)
    out, judged = BatchTable(args.output), BatchTable(f"{args.output}_verdicts")
    publish = _publisher(args, readers.ENRICHED_TOPIC)

    def sink(rows, batch_id):
        # Written once; the verdicts and the topic are made from what was written.
        out.write(rows, batch_id)
        written = out.read(spark, [batch_id])
        judged.write(rules.verdicts(written, limit), batch_id)
        if publish:
            publish(decode.encode(enrich.wire_format(written), "tx_id"))

    return [enrichment.start_enrichment(
        spark, _clean(spark, args), store,
        lambda ids: jobs.dimension_tables(spark, account_state, customer_state, ids),
        sink, f"{args.checkpoint}/enriched", event_types=args.event_types, available_now=args.once,
    ), *_clean_dead_letters(spark, args, "enrich")]


def _thresholds(args):
    return rules.Thresholds(args.max_amount, args.max_tx_count, args.max_spend, args.max_failures)


def judge(spark, args):
    verdicts, dead = jobs.judge_topic(_messages(spark, args, readers.ENRICHED_TOPIC), _thresholds(args))
    queries = [sinks.start_rows_sink(
        verdicts, args.output, f"{args.checkpoint}/verdicts", args.once
    )]
    if args.dead_letters:
        queries.append(sinks.start_rows_sink(
            dead, args.dead_letters, f"{args.checkpoint}/undecodable", args.once
        ))
    return queries


# job -> (function, options it needs, options it may have)
JOBS = {
    "clean": (clean, ["lake"], ["dead-letters", "precision"]),
    "accounts": (accounts, ["state"], ["dead-letters", "keep-log", "buckets"]),
    "customers": (customers, ["state"], ["dead-letters", "keep-log", "buckets"]),
    "behavior": (behavior, ["state"], ["dead-letters", "keep-log", "buckets", "keep-panes", "event-types"]),
    "enrich": (enriched, ["state", "output"], ["dead-letters", "buckets", "event-types", "thresholds"]),
    "rules": (judge, ["output"], ["dead-letters", "thresholds"]),
}


def _option(job, name):
    if name == "precision":
        job.add_argument("--precision", choices=["micros", "second"], default="micros")
    elif name == "keep-log":
        job.add_argument("--keep-log", action="store_true", help="keep changes that snapshots contain")
    elif name == "buckets":
        job.add_argument("--buckets", type=int, default=16, help="parts of the state, the same for all jobs")
    elif name == "keep-panes":
        job.add_argument("--keep-panes", type=int, default=24 * 60, help="newest panes kept of an account")
    elif name == "event-types":
        job.add_argument("--event-types", nargs="+", help="events that count as behaviour; default: all")
    elif name == "thresholds":
        default = rules.DEFAULT
        job.add_argument("--max-amount", type=float, default=default.amount)
        job.add_argument("--max-tx-count", type=int, default=default.tx_count)
        job.add_argument("--max-spend", type=float, default=default.spend)
        job.add_argument("--max-failures", type=int, default=default.failures)
    else:
        job.add_argument(f"--{name}")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__)
    commands = top.add_subparsers(dest="job", required=True)
    for name, (_, needed, optional) in JOBS.items():
        job = commands.add_parser(name)
        source = job.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="brokers; topics are read and written")
        source.add_argument("--input", help="folder of files to read instead")
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--max-offsets", type=int, help="most messages per micro-batch")
        job.add_argument("--once", action="store_true", help="stop when the source is read up")
        for option in needed:
            job.add_argument(f"--{option}", required=True)
        job.add_argument("--starting-offsets", default="latest", help="where a topic is begun, without a checkpoint")
        for option in optional:
            _option(job, option)
    return top


def run(spark, args) -> None:
    queries = JOBS[args.job][0](spark, args)
    if args.once:
        for query in queries:
            query.awaitTermination()
    else:
        jobs.await_any(queries)


if __name__ == "__main__":
    arguments = parser().parse_args()
    run(build_session(f"txrisk-{arguments.job}"), arguments)
