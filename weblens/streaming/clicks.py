"""Click counters from a stream of click-log lines.

Per micro-batch: parse, count once per (day, course, referrer host), and derive the deltas of both
counter tables from those counts. Totals are sums of deltas, so late clicks still reach their own day
and no state is kept in the engine. A batch shows in both tables or in none, and its lines and rejects are stored
with it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from weblens import schemas
from weblens.functions.text import composite_key, referrer_host
from weblens.operators.clean import accepted, parse_clicks
from weblens.operators.kv import CellTable, CounterTable, increment_together

TRIGGER = "60 seconds"
METRICS = "clicks"

# What one batch may admit, so that a backlog is worked off in batches of bounded size.
MAX_FILES = 1000
MAX_OFFSETS = 50_000_000

# Days whose running totals stay in the state.
KEEP_DAYS = 2

# --- sources: DataFrames with a ``value`` column ------------------------------------------------


def kafka_lines(spark: SparkSession, servers: str, topics: Sequence[str],
                options: dict[str, str] | None = None, max_offsets: int | None = MAX_OFFSETS) -> DataFrame:
    """Message values of several topics, at most ``max_offsets`` a batch. Needs the Kafka connector on the class path."""
    admitted = {"maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else {}
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", ",".join(topics))
            .options(**{**admitted, **(options or {})})
            .load()
            .select(F.col("value").cast("string").alias("value")))


def file_lines(spark: SparkSession, folder: str, max_files: int | None = MAX_FILES) -> DataFrame:
    """Lines of the text files that appear in ``folder``, at most ``max_files`` a batch."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


# --- counts -------------------------------------------------------------------------------------

def click_counts(clicks: DataFrame) -> DataFrame:
    return (clicks.select(F.substring("time", 1, 8).alias("day"), "courseId",
                          referrer_host("referer").alias("host"))
            .groupBy("day", "courseId", "host").agg(F.count(F.lit(1)).alias("clicks")))


def tagged_counts(parsed: DataFrame) -> DataFrame:
    """``click_counts`` of the good lines (``good``), and one row with the number of the others."""
    good = F.col("reason").isNull()
    keys = {"day": F.substring("time", 1, 8), "courseId": F.col("courseId"), "host": referrer_host("referer")}
    return (parsed.select(good.alias("good"), *[F.when(good, key).alias(name) for name, key in keys.items()])
            .groupBy("good", *keys).agg(F.count(F.lit(1)).alias("clicks")))


def course_deltas(counts: DataFrame) -> DataFrame:
    """Clicks per ``<yyyyMMdd>_<course>``."""
    return (counts.groupBy("day", "courseId").agg(F.sum("clicks").alias("delta"))
            .select(composite_key("day", "courseId").alias("row_key"), "delta"))


def referrer_deltas(counts: DataFrame) -> DataFrame:
    """Clicks per ``<yyyyMMdd>_<host>_<course>``; clicks without a referrer host are left out."""
    return (counts.filter(F.col("host") != "")
            .select(composite_key("day", "host", "courseId").alias("row_key"),
                    F.col("clicks").alias("delta")))


def parsed_clicks(lines: DataFrame) -> DataFrame:
    """Lines of the stream, parsed; lines and rejects per batch show in its progress as ``clicks``."""
    return parse_clicks(lines).observe(
        METRICS, F.count(F.lit(1)).alias("lines"), F.count("reason").alias("rejects"))


def counter_writer(courses: CounterTable, referrers: CounterTable,
                   stream_id: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function that feeds both tables from parsed lines. Replaying a batch changes nothing."""
    def write(parsed: DataFrame, batch_id: int) -> None:
        both = tagged_counts(parsed).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rejected = F.when(F.col("good"), 0).otherwise(F.col("clicks"))
            counted = both.agg(F.coalesce(F.sum("clicks"), F.lit(0)).alias("lines"),
                               F.coalesce(F.sum(rejected), F.lit(0)).alias("rejects")).first().asDict()
            counts = both.filter("good")
            increment_together({courses: course_deltas(counts), referrers: referrer_deltas(counts)}, stream_id, batch_id, counted)
        finally:
            both.unpersist()

    return write


def start_click_counters(lines: DataFrame, courses: CounterTable, referrers: CounterTable,
                         checkpoint: str, stream_id: str, once: bool = False) -> StreamingQuery:
    """Start the job: every 60 seconds, or with ``once`` until all present data is processed."""
    writer = (parsed_clicks(lines).writeStream
              .foreachBatch(counter_writer(courses, referrers, stream_id))
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if once
            else writer.trigger(processingTime=TRIGGER)).start()


# --- alternative: totals kept as engine state ---------------------------------------------------

def running_course_totals(lines: DataFrame, keep_days: int = KEEP_DAYS, now: Column | None = None) -> DataFrame:
    """(row_key, segment, value): clicks per day and course, as streaming state that is dropped once a day is closed.

    A click of the last ``keep_days`` days counts under its own time. Any other one (late, unreadable and so at
    epoch 0, or in the future) counts under the time it arrives, ``now``, in a segment of its own; so no click is
    ever behind the watermark, the watermark never runs ahead, and the state holds only the counters touched within
    those days. The value of a key is the sum of its segments, which is how late clicks are added to
    a total whose state is gone.
    """
    now = F.current_timestamp() if now is None else now
    clicks = accepted(parse_clicks(lines), schemas.CLICK).withColumn("_now", now)
    at = F.try_to_timestamp("time", F.lit("yyyyMMddHHmmss"))
    recent = (at <= F.col("_now")) & (at > F.col("_now") - F.make_interval(days=F.lit(keep_days)))
    clock = F.when(recent, at).otherwise(F.col("_now"))
    # One day more than a recent click can be old when it arrives.
    timed = clicks.select("time", "courseId", clock.alias("clock")).withWatermark("clock", f"{keep_days + 1} days")
    return (timed.groupBy(F.window("clock", "1 day"), F.substring("time", 1, 8).alias("day"), "courseId")
            .agg(F.count(F.lit(1)).alias("value"))
            .select(composite_key("day", "courseId").alias("row_key"),
                    F.date_format("window.start", "yyyyMMdd").alias("segment"), "value"))


def start_running_totals(lines: DataFrame, totals: CellTable, checkpoint: str,
                         once: bool = False, keep_days: int = KEEP_DAYS, now: Column | None = None) -> StreamingQuery:
    """Upsert every changed total; a later batch wins over an earlier one, a later checkpoint over all
    before it."""
    stream_id = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]
    writer = (running_course_totals(lines, keep_days, now).writeStream.outputMode("update")
              .foreachBatch(lambda batch, batch_id: totals.put(batch, batch_id, stream_id))
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if once
            else writer.trigger(processingTime=TRIGGER)).start()
