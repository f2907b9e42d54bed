"""Near-duplicate groups by SimHash, found with multi-index hashing.

A fingerprint has 64 bits and two segments of 32. Fingerprints at two or fewer differing bits differ
in at most one bit of one segment, so each looks up, for both segments, its own segment value and the
values one bit away, and the whole distance is checked in the join. Of two values one bit apart only
the one with the bit set asks for the other; every pair is still found.

Segment values that more than `crowded` distinct fingerprints share (large groups of near copies)
would give as many pairs as the square of the group. Fingerprints that meet such a value are linked
without pairs: two fingerprints are within two bits exactly when some value is within one bit of
both, so each joins the groups of the 65 values around it, and a group's members link to its least.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from txrisk.llm.common import blocks, own_name, stored, text_column

SEED = 42
MOST_BITS = 2
SEGMENT_BITS = 32
CROWDED = 64
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str, shingle_words: int = 3) -> int:
    """64-bit SimHash, signed; of words without case A-Z, each shingle as often as it occurs."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    ends = ends[shingle_words - 1:] if len(words) > shingle_words else ends[-1:]
    counts = np.zeros(64, np.int64)
    for at in range(0, len(ends), SHINGLES_AT_ONCE):
        part = slice(at, at + SHINGLES_AT_ONCE)
        shingles = map(joined.__getitem__, map(slice, starts[part].tolist(), ends[part].tolist()))
        hashes = b"".join(map(xxhash.xxh64_digest, shingles, repeat(SEED)))
        bits = np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64)
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(ends)).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 3) -> DataFrame:
    """(id, digest, fingerprint) of each row; null texts count as empty. `digest` tells equal ids apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in blocks(batches, 2):
            values = pa.array([fingerprint(text, shingle_words) for text in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), values],
                                             ["id", "digest", "fingerprint"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"),
                       F.xxhash64(text_column(text_col)).alias("digest"), text_column(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, digest long, fingerprint long")


def _segments() -> Column:
    low = F.col("fingerprint").bitwiseAND(F.lit((1 << SEGMENT_BITS) - 1))
    high = F.shiftrightunsigned("fingerprint", SEGMENT_BITS)
    return F.array(*(F.struct(F.lit(i).alias("segment"), value.alias("value"))
                     for i, value in enumerate((low, high))))


def links(distinct: DataFrame, crowded: int = CROWDED) -> DataFrame:
    """(a, b): links that join up all of the distinct fingerprints within two bits of each other."""
    table = distinct.select("fingerprint", F.inline(_segments()))
    full = table.groupBy("segment", "value").count().filter(F.col("count") > crowded).select("segment", "value")
    full = stored(full, "simhash-crowded")

    ones = F.filter(F.sequence(F.lit(0), F.lit(SEGMENT_BITS - 1)),
                    lambda bit: F.col("value").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bit)) != 0)
    cleared = F.transform(ones, lambda bit: F.col("value") - F.call_function("shiftleft", F.lit(1).cast("long"), bit))
    probes = table.select(
        "segment", F.col("fingerprint").alias("a"), F.col("value").alias("own"),
        F.explode(F.concat(F.array("value"), cleared)).alias("value"))
    sparse = table.join(full, ["segment", "value"], "left_anti").select(
        F.col("segment").alias("of"), F.col("value").alias("held"), F.col("fingerprint").alias("b"))
    once = (F.col("own") != F.col("value")) | (F.col("a") < F.col("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_BITS
    pairs = probes.join(sparse, (F.col("segment") == F.col("of")) & (F.col("value") == F.col("held"))
                        & once & (F.col("a") != F.col("b")) & near).select("a", "b")

    meeting = probes.join(full, ["segment", "value"], "left_semi").select("a").distinct()
    around = F.array(F.col("a"), *(F.col("a").bitwiseXOR(F.lit(_signed(1 << bit))) for bit in range(64)))
    balls = meeting.select("a", F.explode(around).alias("centre"))
    least = (balls.groupBy("centre").agg(F.min("a").alias("b"), F.max("a").alias("most"))
             .filter("b < most").drop("most"))
    stars = balls.join(least, "centre").filter("a != b").select("a", "b")
    return pairs.union(stars).distinct()


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) of every node in (a, b) edges; the root is the component's least node.

    Large-star and small-star in turn until the edges are stars around the least nodes. Each round is a
    table in the shared folder, so a lost executor costs one round at most.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a != b").distinct(), "links")
    before = None
    for _ in range(most_rounds):
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        large = large.filter("a != b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(least, "a").select(F.explode(F.array(
            F.struct("a", F.col("root").alias("b")), F.struct(F.col("b").alias("a"), F.col("root").alias("b")))).alias("e"))
        edges = stored(small.select("e.a", "e.b").filter("a != b").distinct(), "links")
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if now == before:
            # Roots are the edges' lesser ends; each is its own root.
            roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root"))
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots).distinct()
        before = now
    raise RuntimeError(f"components not found within {most_rounds} rounds")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3,
                    crowded: int = CROWDED) -> DataFrame:
    """(id, digest, fingerprint, component, representative): one row for each row of `docs`.

    `component` is the least id that links reach. `representative` is true for the row that stands for
    its component: the least id's, and of several with that id the one of the least digest. A component
    whose ids are all null has a null component, and the rows of its least digest stand for it. Texts
    without words have fingerprint zero and are linked like any other.
    """
    rows = stored(fingerprints(docs, id_col, text_col, shingle_words), "simhash")
    # Nulls come last: an id beats none.
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest"))
    per_print = stored(rows.groupBy("fingerprint").agg(first.alias("first")), "simhash-distinct")
    roots = components(links(per_print.select("fingerprint"), crowded))
    rooted = per_print.join(roots, per_print["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    found = rooted.drop("first").join(firsts, "root").select("fingerprint", "first")
    return rows.join(found, "fingerprint").select(
        "id", "digest", "fingerprint", F.col("first.id").alias("component"),
        (F.col("id").eqNullSafe(F.col("first.id")) & (F.col("digest") == F.col("first.digest"))).alias("representative"))


def keep_representatives(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows that, by `found`, another row of their group stands for."""
    id_, digest = own_name(docs, "gone_id"), own_name(docs, "gone_digest")
    gone = found.filter(~F.col("representative")).select(F.col("id").alias(id_), F.col("digest").alias(digest)).distinct()
    same = (F.xxhash64(text_column(text_col)) == F.col(digest)) & F.col(id_col).cast("long").eqNullSafe(F.col(id_))
    return docs.join(gone, same, "left_anti")
