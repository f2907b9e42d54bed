"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "txrisk", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings this package is tuned for; `conf` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Call sites are not recorded for each column expression; plans are built faster.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event times are UTC instants; dates and wall-clock casts must not depend on the host zone."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession, name: str, fresh: bool = True) -> str:
    """A folder under the cluster's shared checkpoint folder: a fresh one, or the one of that name.

    `spark.checkpoint.dir` names a folder all executors can reach. Where the session has none, a
    temporary one is made and set in local mode; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="txrisk-")
        spark.sparkContext.setCheckpointDir(base)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex}" if fresh else name)


def landed(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the shared folder and read again: what uses it more than once doesn't work it out again."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
