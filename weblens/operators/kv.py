"""Keyed counter and cell tables on Parquet.

A counter table is a log of deltas; the value of a key is the sum of its deltas. A batch is written into a folder of
its own and counts from its commit marker on; a replayed batch is written beside the old one and its marker replaces
the old marker. The deltas of closed days are folded into a base of one sorted file per day. A cell table is a log
of versioned values; the value of a key is the one with the highest version. Both are partitioned by the first eight
characters of the key, its day, so that a scan or a lookup opens the files of its days only.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from weblens import schemas
from weblens.sources.commits import append_marker, delete_folders, folders, read_or_empty, read_or_none

# The cell that holds a click counter.
FAMILY = "info"
QUALIFIER = "click_count"

DAY_LENGTH = 8

# Days of a lookup that may be broadcast: some 20 MB as a hashed relation.
BROADCAST_DAYS = 100_000


# Fixed value: the day of the keys that have none, NULL and the empty key.
NO_DAY = "-"


def day_of(key: Column | str) -> Column:
    day = F.substring(key, 1, DAY_LENGTH)
    return F.when(day != "", day).otherwise(F.lit(NO_DAY))


def _of_prefix(log: DataFrame, prefix: str) -> DataFrame:
    """The rows whose key starts with ``prefix``; other days are not read."""
    if not prefix:
        return log
    return log.filter(F.col("key_day").startswith(prefix[:DAY_LENGTH]) & F.col("row_key").startswith(prefix))


def _of_days(log: DataFrame, days: DataFrame) -> DataFrame:
    """The rows of ``days`` (key_day, known to be few); Spark prunes the partitions by them at run time."""
    return log.join(F.broadcast(days), "key_day", "left_semi")


def _write(df: DataFrame, folder: str) -> None:
    """One file per day of the keys, or several where AQE splits a large day, whatever the input's partitions."""
    (df.withColumn("key_day", day_of("row_key")).hint("rebalance", F.col("key_day"))
     .sortWithinPartitions("key_day", "row_key")
     .write.mode("overwrite").partitionBy("key_day").parquet(folder))


def _as_cells(values: DataFrame, family: str, qualifier: str) -> DataFrame:
    return values.select("row_key", F.lit(family).alias("cf"), F.lit(qualifier).alias("qualifier"),
                         "value")


@dataclass(frozen=True)
class Commits:
    """The markers of counter batches; tables that share them show a batch in all of them or in none."""

    spark: SparkSession
    path: str

    def next_attempt(self, stream_id: str, batch_id: int) -> int:
        """One above the last committed attempt; what an uncommitted one left is overwritten."""
        known = read_or_none(self.spark, f"{self.path}/stream_id={stream_id}/batch_id={batch_id}", schemas.BATCH_COMMIT)
        return 1 if known is None else known.agg(F.coalesce(F.max("attempt"), F.lit(0))).first()[0] + 1

    def commit(self, stream_id: str, batch_id: int, attempt: int, lines: int | None = None, rejects: int | None = None) -> None:
        row = self.spark.range(1, numPartitions=1).select(
            F.lit(attempt).alias("attempt"), F.lit(lines).cast("bigint").alias("lines"), F.lit(rejects).cast("bigint").alias("rejects"))
        append_marker(row, f"{self.path}/stream_id={stream_id}/batch_id={batch_id}")

    def batches(self) -> DataFrame:
        """(stream_id, batch_id, attempt, lines, rejects): the attempt that counts, and the lines of its batch."""
        return (read_or_empty(self.spark, self.path, schemas.BATCH_COMMIT).groupBy("stream_id", "batch_id")
                .agg(F.max(F.struct("attempt", "lines", "rejects")).alias("_last")).select("stream_id", "batch_id", "_last.*"))


@dataclass(frozen=True)
class CounterTable:
    """Counters under ``path``; ``commits`` is the folder of the markers, the table's own unless given."""

    spark: SparkSession
    path: str
    family: str = FAMILY
    qualifier: str = QUALIFIER
    commits: str | None = None

    @property
    def markers(self) -> Commits:
        return Commits(self.spark, self.commits or f"{self.path}/commits")

    def increment(self, deltas: DataFrame, stream_id: str, batch_id: int) -> None:
        """Add ``deltas`` (row_key, delta). The same stream and batch again replaces its first write.

        Use a new ``stream_id`` with every new checkpoint, since batch numbers then start again.
        """
        if self.commits:
            raise ValueError("tables with common commits are incremented together")
        increment_together({self: deltas}, stream_id, batch_id)

    def _stage(self, deltas: DataFrame, stream_id: str, batch_id: int, attempt: int) -> None:
        _write(deltas.select("row_key", F.col("delta").cast("bigint").alias("delta")),
               f"{self.path}/log/stream_id={stream_id}/batch_id={batch_id}/attempt={attempt}")

    def _parts(self, batches: DataFrame | None,
               only: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> tuple[DataFrame, DataFrame, DataFrame | None]:
        """Committed deltas that are not folded, the valid base, and the markers of folds (None without any).

        ``only`` restricts both, right above their scans, where it can prune their partitions. Markers are listed before the folders they speak of, so every folder a marker names is found.
        """
        folds = read_or_none(self.spark, f"{self.path}/folds", schemas.FOLDED)
        if batches is None:
            batches = self.markers.batches()
        log = only(read_or_empty(self.spark, f"{self.path}/log", schemas.COUNTER_DELTA)).join(
            batches.select("stream_id", "batch_id", "attempt"), ["stream_id", "batch_id", "attempt"], "left_semi")
        base = only(read_or_empty(self.spark, f"{self.path}/base", schemas.COUNTER_BASE))
        if folds is None:
            return log, base, None
        newest = folds.filter("key_day IS NOT NULL").groupBy("key_day").agg(F.max("generation").alias("generation"))
        through = folds.filter("stream_id IS NOT NULL").select("generation", "stream_id", F.col("batch_id").alias("_through"))
        base = base.join(newest, ["key_day", "generation"], "left_semi").select(*base.columns)
        log = (log.join(newest, "key_day", "left").join(through, ["generation", "stream_id"], "left")
               .filter(F.col("_through").isNull() | (F.col("batch_id") > F.col("_through"))).select(*log.columns))
        return log, base, folds

    def _sums(self, log: DataFrame, base: DataFrame) -> DataFrame:
        rows = log.select("row_key", "delta").union(base.select("row_key", "value"))
        return _as_cells(rows.groupBy("row_key").agg(F.sum("delta").alias("value")), self.family, self.qualifier)

    def totals(self, prefix: str = "", batches: DataFrame | None = None) -> DataFrame:
        """The counters of keys that start with ``prefix``. ``batches`` (``markers.batches()``, taken once) shows
        several tables as of the same batches."""
        log, base, _ = self._parts(batches, lambda rows: _of_prefix(rows, prefix))
        return self._sums(log, base)

    def of_days(self, days: DataFrame, batches: DataFrame | None = None) -> DataFrame:
        """The counters of ``days`` (key_day, few); files of other days are not read."""
        log, base, _ = self._parts(batches, lambda rows: _of_days(rows, days))
        return self._sums(log, base)

    def fold(self, before: str) -> bool:
        """Fold what is committed for the days below ``before`` into their base; returns whether there was any.

        Totals stay the same before, while and after: the new base counts from its marker on, which also says up to
        which batch of every stream it holds the days' deltas. A batch that is replayed later does not count
        for those days again; a later batch with clicks of such a day is added to the base as it is read, and
        by the next fold.
        """
        batches = self.markers.batches()
        log, base, folds = self._parts(batches)
        closed = log.filter(F.col("key_day") < before)
        days = closed.select("key_day").distinct()
        if days.isEmpty():
            return False
        generation = 1 if folds is None else folds.agg(F.max("generation")).first()[0] + 1
        touched = base.join(days, "key_day", "left_semi").select("row_key", "value")
        sums = touched.union(closed.select("row_key", "delta")).groupBy("row_key").agg(F.sum("value").alias("value"))
        _write(sums, f"{self.path}/base/generation={generation}")
        none = F.lit(None)
        held = batches.groupBy("stream_id").agg(F.max("batch_id").alias("batch_id"))
        append_marker(
            days.select(F.lit(generation).alias("generation"), "key_day", none.cast("string").alias("stream_id"), none.cast("bigint").alias("batch_id"))
            .union(held.select(F.lit(generation), none, "stream_id", "batch_id")), f"{self.path}/folds")
        return True

    def sweep(self) -> int:
        """Delete folders that no marker needs any more: folded or replaced deltas, replaced bases. Returns how many.

        Not while a reader that began before the last fold or replay may still run.
        """
        log, base, _ = self._parts(None)
        here = ["stream_id", "batch_id", "attempt", "key_day"]
        last = self.markers.batches().select("stream_id", "batch_id", F.col("attempt").alias("_last"))
        place = ["generation", "key_day"]
        old: list[str] = []
        if (found := read_or_none(self.spark, f"{self.path}/log", schemas.COUNTER_DELTA)) is not None:
            old += folders(found.select(*here, "_metadata.file_path").join(last, ["stream_id", "batch_id"])
                           .filter("attempt <= _last").join(log.select(*here).distinct(), here, "left_anti"))
        if (found := read_or_none(self.spark, f"{self.path}/base", schemas.COUNTER_BASE)) is not None:
            old += folders(found.select(*place, "_metadata.file_path").join(base.select(*place).distinct(), place, "left_anti"))
        return delete_folders(self.spark, old)


def increment_together(deltas: Mapping[CounterTable, DataFrame], stream_id: str, batch_id: int,
                       counted: Mapping[str, int] | None = None) -> None:
    """Add a batch to several counter tables with the same markers: a reader sees it in all of them or in none.

    ``counted`` (lines, rejects) is kept with the batch."""
    markers = {table.markers for table in deltas}
    if len(markers) != 1:
        raise ValueError("tables that are written together need the same folder of commits")
    (marker,) = markers
    attempt = marker.next_attempt(stream_id, batch_id)
    for table, rows in deltas.items():
        table._stage(rows, stream_id, batch_id, attempt)
    marker.commit(stream_id, batch_id, attempt, **(counted or {}))


@dataclass(frozen=True)
class CellTable:
    spark: SparkSession
    path: str
    family: str = FAMILY
    qualifier: str = QUALIFIER

    def _epoch(self, stream_id: str) -> int:
        """The epoch of a stream, from its row in the registry: one above all others when it first writes here.

        Only that first write reads the rows of other streams."""
        registry = f"{self.path}/streams"
        mine = read_or_none(self.spark, f"{registry}/stream_id={stream_id}", schemas.CELL_STREAM)
        if mine is not None and (row := mine.select(F.min("epoch")).first())[0] is not None:
            return row[0]
        epoch = 1 + (read_or_empty(self.spark, registry, schemas.CELL_STREAM).agg(F.max("epoch")).first()[0] or 0)
        append_marker(self.spark.range(1, numPartitions=1).select(F.lit(epoch).cast("bigint").alias("epoch")), f"{registry}/stream_id={stream_id}")
        return epoch

    def put(self, cells: DataFrame, version: int, stream_id: str = "direct") -> None:
        """Set ``cells`` (row_key, value); they win over lower versions of the same stream, and over all streams
        that wrote here before this one began. The same stream and version again replaces its first write.

        With a column ``segment`` a cell has a part per segment, each with its own versions; its value is their sum.
        Versions start again with a new checkpoint: give it a new ``stream_id``. No cells, no write. ``cells`` are
        computed once, and kept while they are written.
        """
        segment = F.col("segment").cast("string") if "segment" in cells.columns else F.lit("")
        rows = cells.select("row_key", segment.alias("segment"), F.col("value").cast("bigint").alias("value"))
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not rows.isEmpty():
                _write(rows, f"{self.path}/cells/epoch={self._epoch(stream_id)}/stream_id={stream_id}/version={version}")
        finally:
            rows.unpersist()

    def _log(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/cells", schemas.CELL_VERSION)

    def _newest(self, log: DataFrame) -> DataFrame:
        parts = log.groupBy("row_key", "epoch", "segment").agg(F.max(F.struct("version", "value")).alias("_part"))
        sums = parts.groupBy("row_key", "epoch").agg(F.sum("_part.value").alias("value"))
        return _as_cells(sums.groupBy("row_key").agg(F.max_by("value", "epoch").alias("value")), self.family, self.qualifier)

    def totals(self, prefix: str = "") -> DataFrame:
        """The cells of keys that start with ``prefix``."""
        return self._newest(_of_prefix(self._log(), prefix))

    def of_days(self, days: DataFrame) -> DataFrame:
        """The cells of ``days`` (key_day, few); files of other days are not read."""
        return self._newest(_of_days(self._log(), days))


def lookup(table: CounterTable | CellTable, keys: DataFrame, default: int = 0) -> DataFrame:
    """One row per distinct key in ``keys`` (row_key): its value, or ``default`` where there is none.

    Only the days of the keys are read: Spark prunes the table's partitions by them while the query runs. Keys of
    more than BROADCAST_DAYS days (counted) are joined with the whole table. Both sides are unique and
    partitioned by key through their aggregates, so the join itself moves no rows, and a key that is asked for a
    million times still joins once.
    """
    wanted = keys.select("row_key").distinct()
    # True for every key: Spark prunes partitions by the other side of a join only where that side is filtered.
    chosen = wanted.filter(F.length(F.coalesce("row_key", F.lit(""))) >= 0)
    days = chosen.select(day_of("row_key").alias("key_day")).distinct()
    few = days.limit(BROADCAST_DAYS + 1).count() <= BROADCAST_DAYS
    cells = table.of_days(days) if few else table.totals()
    return (wanted.join(cells.select("row_key", "value"), "row_key", "left")
            .select("row_key", F.coalesce("value", F.lit(default).cast("bigint")).alias("value")))


def scan_prefix(table: CounterTable | CellTable, prefix: str) -> DataFrame:
    """Cells whose row key starts with ``prefix``, each as JSON text."""
    cell = F.to_json(F.struct("row_key", "cf", "qualifier", "value"))
    return table.totals(prefix).select("row_key", cell.alias("cell"))
