"""Stream sources. All give at least a `value` column or the columns of the given schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# --- fixed values: topic names -----------------------------------------------------------------
TRANSACTION_CHANGES = "cdc.banking.public.transactions"
CUSTOMER_CHANGES = "cdc.banking.public.customer"
ACCOUNT_CHANGES = "cdc.banking.public.account"
CLEAN_TOPIC = "transactions_clean"
ENRICHED_TOPIC = "transactions_enriched"
CUSTOMER_STATE_TOPIC = "customer_dim_state"
ACCOUNT_STATE_TOPIC = "account_dim_state"
# -------------------------------------------------------------------------------------------------


def topic_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    **more: str,
) -> dict[str, str]:
    """Reader options. `max_offsets_per_trigger` bounds a micro-batch after an outage."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return {**options, **more}


def topic_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A topic as a stream. Needs Spark's Kafka connector on the class path."""
    reader = spark.readStream.format("kafka")
    return reader.options(**topic_options(servers, topic, **options)).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    only: str | None = None,
) -> DataFrame:
    """Files of a folder as a stream, oldest first; `only` is a pattern of file names."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if only:
        reader = reader.option("pathGlobFilter", only)
    return reader.load(path)
