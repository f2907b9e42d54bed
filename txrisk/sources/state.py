"""Tables written one micro-batch at a time, and keyed state kept in them.

A retried micro-batch has the id of the failed attempt. It replaces what that attempt wrote and
reads only what earlier batches wrote, so a retry gives the same result as a first attempt. All of
it is files in shared storage: losing an executor loses nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "bucket"


def _file_system(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _matching(spark: SparkSession, pattern: str) -> list[str]:
    files, where = _file_system(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(where) or []]


def _delete(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


class BatchTable:
    """Rows by micro-batch, in folders `batch=<id>`. Belongs to one streaming checkpoint: ids
    start again with a new checkpoint, and so must the table."""

    def __init__(self, path: str, part: str = "batch"):
        self.path = path
        self.part = part

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/{self.part}={batch_id:012d}"

    def write(self, rows: DataFrame, batch_id: int, by: Sequence[str] = ()) -> None:
        """Replace what the batch has; `by` names columns that make folders within its own."""
        rows.write.mode("overwrite").partitionBy(*by).parquet(self._folder(batch_id))

    def ids(self, spark: SparkSession, since: int | None = None) -> list[int]:
        """Batches that were written completely, from `since` on: Spark's committer marks them."""
        marks = _matching(spark, f"{self.path}/{self.part}=*/_SUCCESS")
        ids = (int(mark.split("/")[-2].split("=")[1]) for mark in marks)
        return sorted(i for i in ids if since is None or i >= since)

    def buckets(self, spark: SparkSession) -> dict[int, set[int]]:
        """The buckets in which each complete batch has rows."""
        found: dict[int, set[int]] = {i: set() for i in self.ids(spark)}
        for path in _matching(spark, f"{self.path}/{self.part}=*/{BUCKET}=*"):
            batch, bucket = (int(name.split("=")[1]) for name in path.split("/")[-2:])
            if batch in found:
                found[batch].add(bucket)
        return found

    def drop_before(self, spark: SparkSession, batch_id: int) -> None:
        for old in self.ids(spark):
            if old < batch_id:
                _delete(spark, self._folder(old))

    def drop_buckets(self, spark: SparkSession, gone: Iterable[tuple[int, int]]) -> None:
        """Remove the rows of (batch, bucket); a batch without any rows left goes as a whole."""
        left = self.buckets(spark)
        for batch, bucket in gone:
            _delete(spark, f"{self._folder(batch)}/{BUCKET}={bucket}")
            left[batch].discard(bucket)
            if not left[batch]:
                _delete(spark, self._folder(batch))

    def read(self, spark: SparkSession, ids: Sequence[int]) -> DataFrame | None:
        if not ids:
            return None
        return spark.read.parquet(*[self._folder(i) for i in ids])

    def read_buckets(self, spark: SparkSession, parts: dict[int, set[int]]) -> DataFrame | None:
        """Rows of the given buckets of each batch, with columns for both. Other buckets aren't read."""
        if not parts:
            return None
        wanted = sorted(set().union(*parts.values()))
        whole = spark.read.option("basePath", self.path).parquet(*[self._folder(i) for i in parts])
        rows = whole.filter(F.col(BUCKET).isin(wanted))
        if any(parts[i] != set(wanted) for i in parts):
            pairs = [(F.col(self.part) == i) & F.col(BUCKET).isin(sorted(parts[i])) for i in parts]
            some = pairs[0]
            for pair in pairs[1:]:
                some = some | pair
            rows = rows.filter(some)
        return rows

    def read_all(self, spark: SparkSession) -> DataFrame | None:
        return self.read(spark, self.ids(spark))


class BucketedLog:
    """Rows of micro-batches dealt out to `buckets` by a hash of their column `by`.

    A micro-batch writes its own rows only, and a read of some keys opens the folders of their
    buckets. When a bucket has rows of `fold_every` batches since it was last folded, they are put
    together with that snapshot into a new one, and `trim` may drop rows; other buckets are left as
    they are. Snapshots are named by the first batch they leave out.

    Of a bucket's snapshots the last two are kept, and of the log what came after the first of these,
    unless `keep_log`. `trim_due` may tell from the rows, as they lie in the log, that there is nothing for
    `trim` to drop. Number of buckets and `layout` are fixed when the store is first written.
    """

    def __init__(
        self,
        path: str,
        by: str,
        fold_every: int = 20,
        trim: Callable[[DataFrame], DataFrame] | None = None,
        keep_log: bool = False,
        buckets: int = 16,
        layout: str = "",
        trim_due: Callable[[DataFrame], bool] | None = None,
    ):
        self.path = path
        self.by = by
        self.fold_every = fold_every
        self.trim = trim
        self.trim_due = trim_due
        self.keep_log = keep_log
        self.n_buckets = buckets
        self.layout = f"{buckets} buckets by {by} {layout}".strip()
        self.changes = BatchTable(f"{path}/changes")
        self.snapshots = BatchTable(f"{path}/snapshots", part="before")
        self._checked = False

    def _check_layout(self, spark: SparkSession) -> None:
        if self._checked:
            return
        files, where = _file_system(spark, f"{self.path}/layout")
        if files.exists(where):
            stream = files.open(where)
            found = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            if found != self.layout:
                raise ValueError(f"{self.path} was written with {found}, not {self.layout}")
        else:
            stream = files.create(where)
            stream.write(bytearray(self.layout.encode()))
            stream.close()
        self._checked = True

    def bucket(self, column: Column | None = None) -> Column:
        key = F.col(self.by) if column is None else column
        return F.pmod(F.xxhash64(key.cast("string")), F.lit(self.n_buckets)).cast("int")

    def _buckets_of(self, keys: DataFrame) -> set[int]:
        """The buckets that hold these keys: at most as many numbers as there are buckets."""
        return {row[0] for row in keys.select(self.bucket()).distinct().collect()}

    def _parts(self, spark: SparkSession, before: int | None):
        """(last usable snapshot of each bucket, later change sets and their buckets)."""
        last: dict[int, int] = {}
        for i, buckets in sorted(self.snapshots.buckets(spark).items()):
            if before is None or i <= before:
                last.update(dict.fromkeys(buckets, i))
        changes = {}
        for i, buckets in self.changes.buckets(spark).items():
            later = {b for b in buckets if i >= last.get(b, 0)}
            if later and (before is None or i < before):
                changes[i] = later
        return last, changes

    def _merged(self, spark: SparkSession, last, changes, buckets: set[int] | None = None, reduced: bool = True):
        def wanted(some: set[int]) -> set[int]:
            return some if buckets is None else some & buckets

        by_snapshot: dict[int, set[int]] = {}
        for bucket, i in last.items():
            if wanted({bucket}):
                by_snapshot.setdefault(i, set()).add(bucket)
        later = {i: wanted(some) for i, some in changes.items() if wanted(some)}
        tables = [self.changes.read_buckets(spark, later),
                  self.snapshots.read_buckets(spark, by_snapshot)]
        tables = [t.drop(table.part, BUCKET) for t, table in zip(tables, (self.changes, self.snapshots))
                  if t is not None]
        if not tables:
            return None
        rows = tables[0] if len(tables) == 1 else tables[0].unionByName(tables[1])
        return self._reduce(rows) if reduced else rows

    def _reduce(self, rows: DataFrame) -> DataFrame:
        return rows

    def read(
        self,
        spark: SparkSession,
        before: int | None = None,
        only: DataFrame | None = None,
        buckets: set[int] | None = None,
        reduced: bool = True,
    ) -> DataFrame | None:
        """The rows as of the start of batch `before` (default: now). None if nothing was written
        to the buckets read.

        `only` limits the read to the values of its columns: buckets of none of them aren't opened,
        rows of other keys are dropped in the scan's stage when `only` is small enough for Spark
        to broadcast. `buckets` are those of `only`, if they are known already. Without `reduced`
        a key may have several rows, as they lie in the log.
        """
        if only is not None and buckets is None:
            buckets = self._buckets_of(only)
        rows = self._merged(spark, *self._parts(spark, before), buckets, reduced)
        if rows is None:
            return None
        if only is not None:
            rows = rows.join(only.distinct(), only.columns, "left_semi")
        return rows.drop("_batch")

    def log(self, spark: SparkSession) -> DataFrame | None:
        """All changes still kept, one row each."""
        rows = self.changes.read_buckets(spark, self.changes.buckets(spark))
        return None if rows is None else rows.drop("_batch", self.changes.part, BUCKET)

    def batch(self, spark: SparkSession, batch_id: int) -> DataFrame | None:
        """What one micro-batch wrote."""
        parts = {batch_id: self.changes.buckets(spark).get(batch_id)}
        rows = self.changes.read_buckets(spark, parts) if parts[batch_id] else None
        return None if rows is None else rows.drop("_batch", self.changes.part, BUCKET)

    def _write(self, table: BatchTable, rows: DataFrame, i: int) -> None:
        # A bucket is a file or, where it is large, a few.
        table.write(rows.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET), i, [BUCKET])

    def write(self, rows: DataFrame, batch_id: int) -> None:
        self._check_layout(rows.sparkSession)
        rows = rows.withColumn("_batch", F.lit(batch_id).cast("bigint"))
        self._write(self.changes, rows, batch_id)

    def fold(self, spark: SparkSession, before: int) -> bool:
        """Fold the buckets in which enough has gathered earlier than `before`."""
        last, changes = self._parts(spark, before)
        sets = [bucket for buckets in changes.values() for bucket in buckets]
        due = {bucket for bucket in set(sets) if sets.count(bucket) >= self.fold_every}
        if not due:
            return False
        rows = self._merged(spark, last, changes, due)
        trim = self.trim
        if trim and self.trim_due and not self.trim_due(self._merged(spark, last, changes, due, reduced=False)):
            trim = None
        self._write(self.snapshots, trim(rows) if trim else rows, before)
        # A reader may still be using the previous snapshots and the changes after them.
        self.snapshots.drop_buckets(spark, [
            (i, b) for i, buckets in self.snapshots.buckets(spark).items() for b in buckets & due
            if i < last.get(b, 0)])
        if not self.keep_log:
            self.changes.drop_buckets(spark, [
                (i, b) for i, buckets in self.changes.buckets(spark).items() for b in buckets & due
                if i < last.get(b, 0)])
        return True


class KeyedState(BucketedLog):
    """The last row of each key, by `order`; of rows that are equal in it, the later batch's."""

    def __init__(self, path: str, keys: Sequence[str], order: Sequence[str], **options):
        super().__init__(path, keys[0], **options)
        self.keys = list(keys)
        self.order = list(order)

    def _reduce(self, rows: DataFrame) -> DataFrame:
        rest = [c for c in rows.columns if c not in self.keys]
        last = F.max_by(F.struct(*rest), F.struct(*self.order, "_batch")).alias("last")
        reduced = rows.groupBy(*self.keys).agg(last)
        return reduced.select(*self.keys, *[f"last.{c}" for c in rest])
