"""The next row in an order over a whole table, without putting the table into one task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, Window

from txrisk.llm.common import own_name

ROWS_A_BLOCK = 5_000
# Bounds are sent to every task; beyond so many, blocks have more rows instead.
MOST_BLOCKS = 20_000
NO_ID = -(1 << 63)


class Descending:
    """`df` in descending order of an integer id, cut into blocks that each end with the first rows of the next.

    Null ids come last, rows with equal ids in the order of `tie`. After the last row comes the first.
    """

    def __init__(self, df: DataFrame, id_col: str, tie: str) -> None:
        self.block, self.ahead, self.key = (own_name(df, name) for name in ("next_block", "next_ahead", "next_key"))
        self.tie = tie
        keyed = df.withColumn(self.key, F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)))
        rows = keyed.count()
        n = min(MOST_BLOCKS, -(-rows // ROWS_A_BLOCK))
        shares = [i / n for i in range(1, n)]
        bounds = keyed.agg(F.percentile_approx(self.key, shares, max(10_000, 10 * n))).first()[0] if shares else []
        bounds = np.unique(np.array(bounds or [], np.int64))

        @F.pandas_udf("int")
        def block_of(ids: pd.Series) -> pd.Series:
            return pd.Series(np.searchsorted(bounds, ids.to_numpy(), side="left").astype(np.int32))

        blocked = keyed.withColumn(self.block, block_of(self.key)).withColumn(self.ahead, F.lit(False))
        heads = sorted(map(tuple, keyed.select(self.key).withColumn(self.block, block_of(self.key))
                           .groupBy(self.block).agg(F.max(self.key)).collect()))  # a row a block
        # The first rows of a block follow the last of the block above; those of the highest follow the very last.
        targets = [(key, heads[(i + 1) % len(heads)][0]) for i, (_, key) in enumerate(heads)]
        head, to = own_name(blocked, "next_head"), own_name(blocked, "next_to")
        table = df.sparkSession.createDataFrame(targets, f"{head} long, {to} int")
        ahead = (keyed.join(F.broadcast(table), F.col(self.key) == F.col(head))
                 .withColumn(self.block, F.col(to)).withColumn(self.ahead, F.lit(True)).drop(head, to))
        self.rows = blocked.unionByName(ahead)

    def next(self, column: str) -> Column:
        """The value of `column` in the next row."""
        order = Window.partitionBy(self.block).orderBy(self.ahead, F.desc(self.key), self.tie)
        return F.lead(column).over(order)

    def only(self, df: DataFrame) -> DataFrame:
        """The rows of the table itself, once each."""
        return df.filter(~F.col(self.ahead)).drop(self.block, self.ahead, self.key)
