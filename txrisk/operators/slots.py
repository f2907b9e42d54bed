"""Time slots: how per-key ordered work is split so that no key is one task.

An ordered computation over one account (previous row, trailing sum, as-of version) would put a
whole account into one window partition, and one account may hold a third of all rows. Instead
the partition key is (account, slot), a slot being a fixed stretch of event time. What a slot
needs from earlier time is brought in by a second, small pass: each (account, slot) is reduced to
one row (its sums, its last row) by a map-side combined aggregate, and only those rows are put in
order per account.

Times are epoch microseconds held in a bigint, and a slot is named by its first microsecond. Where a
key is so dense that one slot is too much for a task, `dense_cuts` finds times to cut that key's slots at.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MICROS = 1_000_000


def slot_start(at: Column, seconds: int) -> Column:
    return at - F.pmod(at, F.lit(seconds * MICROS))


def slot_of(at: Column, seconds: int, cuts: Column | None = None) -> Column:
    """The slot of a time: a stretch of `seconds`, or a piece of one that begins at one of the key's `cuts`."""
    start = slot_start(at, seconds)
    if cuts is None:
        return start
    return F.greatest(start, F.array_max(F.filter(cuts, lambda cut: cut <= at)))


MOST_ROWS = 250_000


def dense_keys(most_rows: int, *keys: DataFrame) -> list:
    """The keys with more than `most_rows` rows in the tables of one column together, which are too much for a task:
    at most as many as that goes into the rows. Counts are combined before the shuffle."""
    every = reduce(DataFrame.union, [rows.toDF("key") for rows in keys]).filter("key is not null")
    counts = every.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return sorted(row["key"] for row in counts.filter(F.col("n") > most_rows).collect())


PIECES = 256


def dense_cuts(
    rows: DataFrame, key: str, at: Column, seconds: int, most_rows: int
) -> DataFrame:
    """(key, cuts): where to cut the slots that hold more than `most_rows` rows of a key, in order.

    Cut points are quantiles of the rows' own times, so pieces have about `most_rows` rows however the
    rows lie within the slot, short of more than that at one and the same time; a slot is cut into
    at most `PIECES`, beyond which pieces grow with it. Keys without such a slot have no row. Counts
    and quantiles are aggregates combined before the shuffle.
    """
    placed = rows.select(F.col(key), at.alias("_at")).filter(F.col(key).isNotNull() & F.col("_at").isNotNull())
    placed = placed.withColumn("_slot", slot_start(F.col("_at"), seconds))
    dense = placed.groupBy(key, "_slot").agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > most_rows)
    shares = [i / PIECES for i in range(1, PIECES)]
    grid = (
        placed.join(dense.select(key, "_slot"), [key, "_slot"], "left_semi").groupBy(key, "_slot")
        .agg(F.percentile_approx("_at", shares, 10 * PIECES).alias("_grid"), F.count(F.lit(1)).alias("_rows"))
    )
    pieces = F.least(F.ceil(F.col("_rows") / most_rows), F.lit(PIECES)).cast("int")
    cuts = F.transform(
        F.sequence(F.lit(1), pieces - 1), lambda i: F.get("_grid", F.floor(i * PIECES / pieces).cast("int") - 1))
    return (
        grid.select(key, F.explode(cuts).alias("_cut"))
        .groupBy(key).agg(F.sort_array(F.collect_set("_cut")).alias("cuts"))
    )


def with_cuts(rows: DataFrame, key: str, cuts: DataFrame | None, name: str = "_cuts") -> DataFrame:
    """`rows` with the cuts of their key; without `cuts`, as they are."""
    if cuts is None:
        return rows
    table = cuts.select(F.col(key).alias("_cut_key"), F.col("cuts").alias(name))
    return rows.join(table, F.col(key) == F.col("_cut_key"), "left").drop("_cut_key")


def carry_in(
    slots: DataFrame, key: str, tail: str = "tail", sums: Sequence[str] = (), slot: str = "slot"
) -> DataFrame:
    """Replace, in each row, `tail` by the last non-null tail and `sums` by the totals of the
    key's earlier slots. A slot may have more than one row; it has a bounded number, so a window
    partition here is bounded by the number of slots in the data's time range.
    """
    earlier = (
        Window.partitionBy(key).orderBy(slot).rangeBetween(Window.unboundedPreceding, -1)
    )
    carried = {tail: F.last(tail, ignorenulls=True).over(earlier)}
    carried.update({name: F.sum(name).over(earlier) for name in sums})
    return slots.withColumns(carried)
