"""As-of join: the version of a keyed row that was valid at a fact's time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.operators.slots import MICROS, MOST_ROWS, carry_in, dense_keys, slot_of, with_cuts

DAY = 24 * 3600


def asof_join(
    facts: DataFrame,
    versions: DataFrame,
    key: str,
    fact_time: str,
    version_time: str,
    version_order: Sequence[str] = (),
    slot: int = DAY,
    strict: bool = False,
    within: int | None = None,
    spread_by: Sequence[str] = (),
    cuts: DataFrame | None = None,
    most_rows: int = MOST_ROWS,
) -> DataFrame:
    """Left join each fact to the latest version of its key at or before the fact's time.

    Adds `version`, a struct of the version's columns, null when there is none. Versions at the
    same time are ordered by `version_order`. `strict` leaves out versions at the fact's own time;
    `within` leaves out versions that many seconds old or older.

    Facts and versions are put in one ordered pass per (key, slot). No range condition and no pairs
    are ever formed, and a hot key is spread over its slots. A key that has at most `most_rows` facts and versions is
    one slot, and nothing is brought into it; which have more is counted first. The version valid at a slot's start is added to it
    as one more row; with `within`, versions are added to the next slot too while they are young enough, and
    slots are at least that long, so facts and versions are read once each. Facts without a key or a
    time cannot match and are spread by the hash of `spread_by` (default: all their columns).
    `cuts`, from `dense_cuts` over the facts' or all rows' keys and times, split slots that are too dense.
    """
    if within is not None:
        if cuts is not None:
            raise ValueError("slots are only cut where versions don't expire")
        slot = max(slot, within)

    # Where versions expire, or there are cuts, every key has its slots.
    whole = within is None and cuts is None
    dense = dense_keys(most_rows, facts.select(key), versions.select(key)) if whole else []
    hot = F.col("_key").isin(*dense)

    def place(at):
        slots = slot_of(at, slot, None if cuts is None else F.col("_cuts"))
        if not whole:
            return slots
        return F.when(F.col(key).isin(*dense), slots).otherwise(0) if dense else F.lit(0).cast("bigint")

    versions_ = with_cuts(versions, key, cuts)
    v_at = F.unix_micros(F.col(version_time).cast("timestamp"))
    v = versions_.filter(F.col(version_time).isNotNull() & F.col(key).isNotNull()).select(
        F.col(key).alias("_key"), v_at.alias("_at"), place(v_at).alias("_slot"),
        F.struct(*versions.columns).alias("version"),
        F.struct(v_at.alias("at"), *version_order).alias("_order"),
    )
    facts_ = with_cuts(facts, key, cuts)
    f_at = F.unix_micros(F.col(fact_time).cast("timestamp"))
    spread = -1 - F.pmod(F.xxhash64(*(spread_by or facts.columns)), F.lit(1 << 16))
    matchable = F.col(key).isNotNull() & f_at.isNotNull()
    f = facts_.select(
        *facts.columns, F.col(key).alias("_key"), F.coalesce(f_at, F.lit(0)).alias("_at"),
        F.when(matchable, place(f_at)).otherwise(spread).alias("_slot"),
        matchable.alias("_ok"),
    )
    if within is not None:
        following = F.col("_slot") + slot * MICROS
        young = F.when(F.col("_at") + within * MICROS > following, following)
        v = v.withColumn("_slot", F.explode(F.array_compact(F.array("_slot", young))))
        carried = None
    elif whole:
        carried = _brought_in(f.filter(hot), v.filter(hot)) if dense else None
    else:
        carried = _brought_in(f, v)

    fact_side, version_side = (0, 1) if strict else (1, 0)
    merged = f.withColumn("_side", F.lit(fact_side))
    for side in (v, carried):
        if side is not None:
            merged = merged.unionByName(side.withColumn("_side", F.lit(version_side)), allowMissingColumns=True)
    so_far = (
        Window.partitionBy("_key", "_slot").orderBy("_at", "_side", "_order")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    found = (
        merged.withColumn("version", F.last("version", ignorenulls=True).over(so_far))
        .filter(F.col("_side") == fact_side)
    )
    valid = F.col("_ok")
    if within is not None:
        age = F.col("_at") - F.unix_micros(F.col(f"version.{version_time}").cast("timestamp"))
        valid = valid & (age < within * MICROS)
    return found.select(*facts.columns, F.when(valid, F.col("version")).alias("version"))


def _brought_in(f: DataFrame, v: DataFrame) -> DataFrame:
    """The version valid at the start of each (key, slot) that holds facts, as a row just before it."""
    # Last version per (key, slot), and which (key, slot) hold facts: one combined aggregate.
    asked = f.filter("_ok").select("_key", "_slot")
    tails = (
        v.select("_key", "_slot", "version", "_order", F.lit(False).alias("_asks"))
        .unionByName(asked.withColumn("_asks", F.lit(True)), allowMissingColumns=True)
        .groupBy("_key", "_slot")
        .agg(F.max_by("version", "_order").alias("tail"), F.max("_asks").alias("_asks"))
    )
    return (
        carry_in(tails, "_key", slot="_slot")
        .filter(F.col("_asks") & F.col("tail").isNotNull())
        .select("_key", (F.col("_slot") - 1).alias("_at"), "_slot", F.col("tail").alias("version"))
    )
