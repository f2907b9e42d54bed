"""Exact duplicates by a 128-bit content hash.

Rows are grouped by hash and bytes: the hash deals rows out and is compared first, the aggregation
compares the bytes of texts whose hashes are equal, so texts that only share a hash stay apart. Copies
are combined in each task before anything is shuffled, and a text crosses the network once a task, however
often it occurs. Rows then find their group by hash and a second, independent digest: no text moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from txrisk.llm.common import own_name, text_column


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """(hash, sha256, keep_id, group_size): one row for each distinct text."""
    best = {"smallest": F.min, "largest": F.max}[keep](id_col)
    rows = docs.select(F.col(id_col), text_column(text_col).alias("text"))
    return (rows.withColumn("hash", F.unhex(F.md5(F.col("text").cast("binary"))))
            .groupBy("hash", "text").agg(best.alias("keep_id"), F.count("*").alias("group_size"))
            .select("hash", F.sha2("text", 256).alias("sha256"), "keep_id", "group_size"))


def mark(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """(id, keep_id, group_size, kept, sha256): one row for each row of `docs`.

    Null texts count as empty. Exactly one row of each group is kept, also where several have its id, or where all
    ids are null.
    """
    found = groups(docs, id_col, text_col, keep)
    rows = docs.select(F.col(id_col).alias("id"), F.unhex(F.md5(text_column(text_col).cast("binary"))).alias("hash"),
                       F.sha2(text_column(text_col), 256).alias("sha256"))
    rows = rows.join(found, ["hash", "sha256"])
    stands = F.col("id").eqNullSafe(F.col("keep_id"))
    # Only rows with the kept id are told apart; the others are spread, so that no group meets in one task.
    rows = rows.withColumn("salt", F.when(stands, F.lit(0)).otherwise(F.xxhash64("id"))).repartition("sha256", "salt")
    place = F.row_number().over(Window.partitionBy("sha256", "salt").orderBy("hash"))
    return rows.select("id", "keep_id", "group_size", (stands & (place == 1)).alias("kept"), "sha256")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest") -> DataFrame:
    """`docs` with one row of each group of equal texts; of rows with the same id and text, any one stays."""
    hash_, sha, key = (own_name(docs, name) for name in ("hash", "sha256", "id_key"))

    def keyed(id_: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(id_).cast("string")), F.lit(""))

    found = groups(docs, id_col, text_col, keep).select(
        F.col("hash").alias(hash_), F.col("sha256").alias(sha), keyed("keep_id").alias(key))
    rows = (docs.withColumn(hash_, F.unhex(F.md5(text_column(text_col).cast("binary"))))
            .withColumn(sha, F.sha2(text_column(text_col), 256)).withColumn(key, keyed(id_col)))
    # By id too: the rows of a large group are dealt out, and the kept one alone finds its group.
    return rows.join(found, [hash_, sha, key]).dropDuplicates([hash_, sha, key]).select(*docs.columns)
