"""Sources mixed to target weights by Pfair scheduling.

Each source's documents, in an order of their own, are cut into blocks. With weight w the i-th block (from
1) of a source is released at slot floor((i-1)/w) and due at slot ceil(i/w); in each slot the released
block with the earliest deadline goes next. As the weights sum to one this keeps every source, at every
slot, less than one block from its target share.

Weights are whole shares, so the schedule repeats after as many slots as there are shares. Only one such
round is laid out, on the driver: its length is the number of shares, at most `MOST_SHARES`, whatever the
data. Each document finds its slot from its number in its source. Of more sources than a round can name, the smallest share
a place in it, and are dealt out within that place in Spark. When a source has no blocks left, the
others go on in a new phase with their shares, so nothing is dropped and none repeated.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, functions as F, Window

from txrisk.llm.common import own_name

MOST_SHARES = 10_000
MOST_SOURCES = 1_000
# Weights found from the documents are rounded to so many shares.
SHARES = 1_000
OTHERS = "others"
# Documents of a source are numbered in so many parts at once.
PARTS = 1024


def round_of(shares: dict[str, int]) -> dict[str, list[int]]:
    """The slots, from 0, that each source has in one round of sum(shares) slots."""
    total = sum(shares.values())
    slots: dict[str, list[int]] = {name: [] for name in shares}
    waiting = [(0, name) for name in sorted(shares)]  # by release
    heapq.heapify(waiting)
    ready: list[tuple[int, str]] = []  # by deadline
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, name = heapq.heappop(waiting)
            block = len(slots[name]) + 1
            heapq.heappush(ready, (-(-block * total // shares[name]), name))
        _, name = heapq.heappop(ready)
        slots[name].append(slot)
        if len(slots[name]) < shares[name]:
            heapq.heappush(waiting, (len(slots[name]) * total // shares[name], name))
    return slots


def phases(shares: dict[str, int], blocks: dict[str, int]) -> list[dict]:
    """Phases of the schedule, each until a source has no blocks left.

    A phase has its first slot, its round and, by source, the first block it takes.
    """
    found, start, done = [], 0, dict.fromkeys(shares, 0)
    while active := {name: share for name, share in shares.items() if blocks.get(name, 0) > done[name]}:
        total, slots = sum(active.values()), round_of(active)

        def slot(name: str, block: int) -> int:
            return block // active[name] * total + slots[name][block % active[name]]

        length = 1 + min(slot(name, blocks[name] - done[name] - 1) for name in active)
        found.append({"start": start, "total": total, "slots": slots, "first": {name: done[name] for name in active}})
        for name in active:
            done[name] += length // total * active[name] + sum(s < length % total for s in slots[name])
        start += length
    return found


def numbered(docs: DataFrame, keys: list[str], group: str, number: str, part: Column | None = None,
             order: list[str] | None = None) -> DataFrame:
    """`docs` with each row's number, from 0, within `group`: by hashes of `keys`, or by `order`.

    Rows of a group are dealt out over parts, which are numbered from the counts of the parts before; an
    order of one's own needs a `part` that never falls along it.
    """
    part_, before = own_name(docs, "part"), own_name(docs, "before")
    hashed = F.xxhash64(*keys)
    parted = docs.withColumn(part_, F.pmod(hashed, F.lit(PARTS)) if part is None else part)
    counts = parted.groupBy(group, part_).agg(F.count("*").alias(before))
    earlier = Window.partitionBy(group).orderBy(part_).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn(before, F.coalesce(F.sum(before).over(earlier), F.lit(0)))
    place = F.row_number().over(Window.partitionBy(group, part_).orderBy(*(order or [hashed, *keys])))
    return (parted.withColumn(number, place - 1).join(counts, [group, part_])
            .withColumn(number, F.col(number) + F.col(before)).drop(part_, before))


def mix(docs: DataFrame, shares: dict[str, int] | None = None, source_col: str = "source", id_col: str = "doc_id",
        block_docs: int = 32, position: str = "position", smoothing: float = 0.7, most_sources: int = MOST_SOURCES) -> DataFrame:
    """`docs` with each row's place in the mix in a column `position`, which replaces any of that name.

    Places are unique, `block_docs` a slot; a short last block of a source leaves places unused.

    `shares` are the target weights of sources in whole shares. Sources that aren't named, null among
    them, are one source, `others`, of one share if not named itself. Without `shares` the weight of each source, null
    being one, is its number of documents to the power `smoothing`, in thousandths. Sources of less than that, and those beyond
    the `most_sources` largest, have their weights together in the round, and go within that by release times: see `_interleaved`.
    Rows that agree in id, source and text length may take each other's places. The columns used on the way get names that
    `docs` doesn't have.
    """
    docs = docs.drop(position)
    source, block, number = (own_name(docs, name) for name in ("mix_source", "mix_block", "mix_number"))
    keys = [name for name in (id_col, source_col) if name in docs.columns]
    # A source's name can't be that of the rest: it has a sign before it.
    own = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))
    together = shares is not None
    if together:
        shares = {OTHERS: shares.get(OTHERS, 1), **{f"={name}": share for name, share in shares.items() if name != OTHERS}}
    else:
        counts = docs.groupBy(own.alias("name")).count().withColumn("weight", F.pow("count", F.lit(smoothing)))
        mass, number_of = counts.agg(F.sum("weight"), F.count("*")).first()
        # Sources of a share or more: no more than there are shares.
        large = counts.filter(F.col("weight") * SHARES >= F.lit(mass)).orderBy(F.desc("count"), "name")
        weights = {row["name"]: row["weight"] for row in large.limit(most_sources - 1).collect()}
        if number_of > len(weights):
            weights[OTHERS] = mass - sum(weights.values())
        shares = {name: max(1, round(SHARES * weight / mass)) for name, weight in weights.items()}
    if shares and (sum(shares.values()) > MOST_SHARES or len(shares) > MOST_SOURCES or min(shares.values()) < 1):
        raise ValueError(f"shares must be 1 or more, sum to {MOST_SHARES} at most and name {MOST_SOURCES} sources at most")
    spark = docs.sparkSession
    named = own.isin([name for name in shares if name != OTHERS])
    known = docs.withColumn(source, F.when(named, own).otherwise(OTHERS))
    blocks = {row["name"]: -(-row["count"] // block_docs)
              for row in known.groupBy(F.col(source).alias("name")).count().collect()}  # a row a named source

    plan = phases(shares, blocks)
    steps = spark.createDataFrame(
        [(k, name, phase["first"][name], phase["start"], phase["total"], phase["slots"][name])
         for k, phase in enumerate(plan) for name in phase["first"]],
        "phase int, name string, first long, start long, total long, slots array<int>")
    # A source's phases in one row, bounded as the shares are.
    steps = F.broadcast(steps.groupBy("name").agg(F.array_sort(F.collect_list(
        F.struct("first", "start", "total", "slots"))).alias("steps")))
    if together or OTHERS not in blocks:
        rows = numbered(known, keys, source, number)
    else:
        rest = _interleaved(known.filter(F.col(source) == OTHERS), own, keys, source, number, block_docs, smoothing)
        rows = numbered(known.filter(F.col(source) != OTHERS), keys, source, number).unionByName(rest)
    rows = rows.withColumn(block, F.floor(F.col(number) / block_docs))
    name, steps_ = own_name(rows, "mix_name"), own_name(rows, "mix_steps")
    placed = rows.join(steps.select(F.col("name").alias(name), F.col("steps").alias(steps_)), F.col(source) == F.col(name))
    step = F.element_at(F.filter(steps_, lambda s: s["first"] <= F.col(block)), -1)
    within, share = F.col(block) - step["first"], F.size(step["slots"])
    slot = step["start"] + F.floor(within / share) * step["total"] + F.get(step["slots"], F.pmod(within, share).cast("int"))
    place = slot * block_docs + F.pmod(F.col(number), F.lit(block_docs))
    return placed.select(*docs.columns, place.cast("long").alias(position))


def _interleaved(rows: DataFrame, own: Column, keys: list[str], group: str, number: str, block_docs: int, smoothing: float) -> DataFrame:
    """The rows of the many small sources, numbered so that each source keeps its weight among them.

    Block i of a source with weight w has its time between release i/w and deadline (i+1)/w, at a point within that
    is the source's own, so that equal sources don't come all at once. Blocks go by these times; a source is within a block of
    its weight at any of them, and nothing of this is worked out on the driver.
    """
    member, at, many, time, part = (own_name(rows, name) for name in ("mix_member", "mix_at", "mix_many", "mix_time", "mix_key"))
    rows = numbered(rows.withColumn(member, own), keys, member, at)
    sizes = rows.groupBy(F.col(member).alias(part)).agg(F.count("*").alias(many))
    offset = F.pmod(F.xxhash64(member), F.lit(1 << 20)) / (1 << 20)
    rows = rows.join(sizes, F.col(member) == F.col(part)).drop(part).withColumn(
        time, (F.floor(F.col(at) / block_docs) + offset) / F.pow(many, F.lit(smoothing)))
    last = rows.agg(F.max(time)).first()[0]
    part_of = F.floor(F.col(time) * (PARTS / last)) if last else F.lit(0)
    return numbered(rows, keys, group, number, part_of, [time, member, at]).drop(member, at, many, time)


def in_order(mixed: DataFrame, position: str = "position") -> DataFrame:
    """`mixed` dealt out by ranges of `position` and sorted, so that written files hold the mix in order."""
    return mixed.repartitionByRange(position).sortWithinPartitions(position).drop(position)
