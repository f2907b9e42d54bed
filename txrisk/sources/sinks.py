"""Sinks. Every streaming sink takes its checkpoint folder; none has a default."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def _start(writer, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = writer.option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def start_topic_sink(
    pairs: DataFrame, servers: str, topic: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """(key, value) rows to a topic, at least once."""
    writer = pairs.writeStream.format("kafka").outputMode("append")
    writer = writer.option("kafka.bootstrap.servers", servers).option("topic", topic)
    return _start(writer, checkpoint, available_now)


def write_topic(pairs: DataFrame, servers: str, topic: str) -> None:
    """(key, value) rows of one micro-batch to a topic."""
    writer = pairs.write.format("kafka")
    writer.option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def spread_by_date(rows: DataFrame, files_per_date: int) -> DataFrame:
    """Bring a date's rows into a bounded number of files, spread by transaction so that neither
    a busy day nor a busy account is one writer."""
    return rows.repartition("event_date", F.pmod(F.xxhash64("tx_id"), F.lit(files_per_date)))


def write_lake(clean: DataFrame, path: str, files_per_date: int | None = None) -> None:
    rows = spread_by_date(clean, files_per_date) if files_per_date else clean
    rows.write.mode("append").partitionBy("event_date").parquet(path)


def write_lake_batch(clean: DataFrame, path: str, batch_id: int, rows_per_file: int) -> None:
    """The clean rows of a micro-batch to the lake, in a folder of each event date's folder.

    A retry replaces those folders. Each date has as many writers as its rows ask for, so that
    neither a busy day nor a busy account is one writer; a quiet day is one file, and no file has more than
    `rows_per_file`. `clean` is read twice: its dates are counted first, one number a date.
    """
    # A row a date, and times outside the years 1 to 9999 have been rejected: small enough to send.
    dates = clean.groupBy(F.col("event_date").alias("_date")).agg(
        F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_files"))
    salt = F.pmod(F.xxhash64("tx_id", "lsn"), F.col("_files"))
    rows = clean.join(F.broadcast(dates), F.col("event_date").eqNullSafe(F.col("_date"))).select(
        *clean.columns, F.lit(batch_id).cast("bigint").alias("batch"), salt.alias("_salt"))
    (
        rows.repartition("event_date", "_salt").drop("_salt").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", rows_per_file)
        .partitionBy("event_date", "batch").parquet(path)
    )


def start_rows_sink(
    rows: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Rows of a stateless stream (verdicts, dead letters) to parquet, exactly once."""
    writer = rows.writeStream.format("parquet").outputMode("append").option("path", path)
    return _start(writer, checkpoint, available_now)


def start_batches(
    rows: DataFrame,
    process,
    checkpoint: str,
    mode: str = "append",
    available_now: bool = False,
) -> StreamingQuery:
    """Call `process(batch, batch_id)` for every micro-batch."""
    writer = rows.writeStream.foreachBatch(process).outputMode(mode)
    return _start(writer, checkpoint, available_now)
