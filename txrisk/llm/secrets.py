"""Secrets in texts, and who owns them.

Candidates are found by pattern. Each is known by the hash of its value, and hashes are counted over the whole
corpus by distinct repositories and owners: a value that many owners have is a widely copied example, one that
a single owner has may be live. Runs of mixed letters and digits that no pattern names (`opaque`) are reported
only where they look live.

Everything is DataFrame functions. A pattern's matches and the gaps between them are taken in one pass each; the places of
matches are running sums of their lengths, in a window over each text's own matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, Window

from txrisk.llm.common import stored, text_column

# The patterns and least lengths of the kinds, in their order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"
OPAQUE = r"[A-Za-z0-9+/_=-]{20,}"
# kind, pattern, group of the value, least length of the value, whether asked for by itself
KINDS = [("assign", ASSIGN, 2, 12, True), ("access", ACCESS, 0, 18, True), ("hex", HEX, 0, 16, True),
         ("opaque", OPAQUE, 0, 20, False)]

# A value with so many owners or more is widely copied.
COPIED_OWNERS = 3
# … or so many repositories of one owner: a sample key that one source copies everywhere is no secret of anyone's.
COPIED_REPOSITORIES = 100


def _matches(text: Column) -> Column:
    """An array with, for each kind, its matches and the lengths of the gaps before them."""
    rows = []
    for number, (_, pattern, group, _, _) in enumerate(KINDS):
        whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        value = whole if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        gaps = F.transform(F.split(text, pattern, -1), F.length)
        some = F.arrays_zip(whole.alias("match"), value.alias("value"), F.slice(gaps, 1, F.size(whole)).alias("gap"))
        # The split is made only where something matches.
        rows.append(F.struct(F.lit(number).alias("kind"), F.when(text.rlike(pattern), some).alias("found")))
    return F.array(*rows)


def candidates(kept: DataFrame) -> DataFrame:
    """(row, repository, owner, kind, own, start, end, hash) of each candidate among the matches `found` of rows.

    Places are in code points, ends exclusive.
    """
    keys = ["row", "repository", "owner"]
    kinds = kept.select(*keys, F.inline("found"))
    each = kinds.select(*keys, "kind", F.posexplode("found").alias("place", "one"))
    each = each.select(*keys, "kind", "place", F.col("one.gap").alias("gap"), F.length("one.match").alias("length"),
                       F.length("one.value").alias("size"), F.sha2("one.value", 256).alias("hash"),
                       _mixed(F.col("one.value")).alias("mixed"))
    order = Window.partitionBy("row", "kind").orderBy("place")
    placed = each.withColumn("end", F.sum(F.col("gap") + F.col("length")).over(order))
    least = F.element_at(F.array(*(F.lit(kind[3]) for kind in KINDS)), F.col("kind") + 1)
    own = F.element_at(F.array(*(F.lit(kind[4]) for kind in KINDS)), F.col("kind") + 1)
    placed = placed.filter((F.col("size") >= least) & (own | F.col("mixed"))).withColumn("own", own)
    placed = placed.withColumn("start", F.col("end") - F.col("length"))
    # A run that overlaps a named kind says nothing new.
    by_start = Window.partitionBy("row").orderBy("start")
    before = F.max(F.when(F.col("own"), F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(F.col("own"), F.col("start"))).over(by_start.rowsBetween(1, Window.unboundedFollowing))
    placed = placed.withColumn("covered", F.coalesce(before > F.col("start"), F.lit(False)) | F.coalesce(after < F.col("end"), F.lit(False)))
    return placed.filter(F.col("own") | ~F.col("covered")).select(*keys, "kind", "own", "start", "end", "hash")


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[a-z]") & value.rlike("[A-Z]")


def ownership(found: DataFrame) -> DataFrame:
    """(hash, repositories, owners, copied) over (hash, repository, owner) of all candidates.

    A value is copied if `COPIED_OWNERS` owners have it, or one in `COPIED_REPOSITORIES` of its repositories. Nulls are one repository and one owner each. Counted in steps, each combined before it is shuffled, so that a value in a
    third of all texts is spread by its repositories first.
    """
    by_repository = found.groupBy("hash", "owner", "repository").agg(F.count("*").alias("times"))
    by_owner = by_repository.groupBy("hash", "owner").agg(F.count("*").alias("repositories"))
    copied = (F.count("*") >= COPIED_OWNERS) | (F.max("repositories") >= COPIED_REPOSITORIES)
    return by_owner.groupBy("hash").agg(
        F.sum("repositories").alias("repositories"), F.count("*").alias("owners"), copied.alias("copied"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository_col: str = "doc_id",
         owner_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """Findings by row and by value.

    By row of `docs`: id, row, and `spans`, an array of (start, kind, end, own, live) in order. Null texts count as empty,
    and rows with equal ids stay apart. By value: hash, repositories, owners, copied; a repository is one of an owner.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
                       F.col(repository_col).cast("string").alias("repository"), F.col(owner_col).cast("string").alias("owner"),
                       text_column(text_col).alias("text"))
    # Row numbers must not change between uses, nor the patterns be tried twice.
    kept = stored(rows.withColumn("found", F.filter(_matches(F.col("text")), lambda k: k["found"].isNotNull()))
                  .drop("text"), "secret-matches")
    found = stored(candidates(kept), "secret-candidates")
    values = ownership(found)
    live = found.join(values.select("hash", "copied"), "hash").withColumn("live", ~F.col("copied")).filter("own or live")
    per_row = live.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end", "own", "live"))).alias("spans"))
    empty = F.array().cast(per_row.schema["spans"].dataType)
    spans = kept.select("row", "id").join(per_row, "row", "left").withColumn("spans", F.coalesce("spans", empty))
    return spans.select("id", "row", "spans"), values


def as_text(spans: Column) -> Column:
    """kind:start:end of spans, joined by commas."""
    names = F.array(*(F.lit(kind[0]) for kind in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")
