"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from txrisk.session import shared_dir


def own_name(df: DataFrame, name: str) -> str:
    """`name`, with underscores added until no column of `df` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_column(name: str) -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def id_hash(name: str) -> Column:
    """crc32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary"))


class Numbers(dict):
    """Numbers things as they are first asked for; `fresh` has those since it was last emptied."""

    def __init__(self) -> None:
        super().__init__()
        self.fresh: list = []

    def __missing__(self, key) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the cluster's shared folder and read again: lineage ends there."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The Parquet table at `path`, empty where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def blocks(batches: Iterator, text_index: int, limit: int = 8_000_000) -> Iterator[tuple[list, list[str]]]:
    """Arrow batches cut into blocks of about `limit` characters; a longer text is a block of its own.

    Yields the other columns, as Arrow slices, and the texts.
    """
    for batch in batches:
        texts = batch.column(text_index).to_pylist()
        start = size = 0
        for end, text in enumerate(texts):
            if size and size + len(text) > limit:
                yield batch.slice(start, end - start), texts[start:end]
                start, size = end, 0
            size += len(text)
        if start < len(texts):
            yield batch.slice(start), texts[start:]
