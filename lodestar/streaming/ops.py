"""Structured Streaming operators (survey §2.18, K1-K9).

The same frame->frame functions serve batch and stream (K4). Sinks are
files or ``foreachBatch`` writers in the shared checkpoint folder — never
the driver-memory sink — and every query has a ``checkpointLocation`` so
a restarted job resumes exactly where it stopped (K5). Tests drive the
queries with ``availableNow``; production uses ``processingTime`` (K3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestar.streaming.state import HotState
from lodestar.tables import SCHEMAS


def event_stream(spark: SparkSession, path: str, files_per_batch: int | None = None,
                 glob: str | None = None) -> DataFrame:
    """File source over a landing folder (a Kafka source is a config
    change: ``format("kafka")`` + ``from_json`` of the value)."""
    r = spark.readStream.schema(SCHEMAS["events"])
    if files_per_batch:
        r = r.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(path)


def bus_event_stream(spark: SparkSession, servers: str, topic: str,
                     starting: str = "latest") -> DataFrame:
    """The same event frame from a Kafka topic whose values are JSON
    events (needs the spark-sql-kafka package on the cluster; not available
    offline, so tests use ``event_stream``). Every downstream operator is
    unchanged (K4)."""
    raw = (spark.readStream.format("kafka")
                .option("kafka.bootstrap.servers", servers)
                .option("subscribe", topic)
                .option("startingOffsets", starting)
                .load())
    parsed = F.from_json(F.col("value").cast("string"), SCHEMAS["events"])
    return raw.select(parsed.alias("e")).select("e.*")


def alerts(events: DataFrame, kind: str = "signup") -> DataFrame:
    """K1/K4: keep one operation type and shape an alert row (works on a
    batch or a streaming frame alike)."""
    return events.where(F.col("event_type") == kind).select(
        "event_id", "user_id", "ts",
        F.concat(F.lit("new "), F.col("event_type"), F.lit(" by user "),
                 F.col("user_id").cast("string")).alias("message"),
        F.get_json_object("props", "$.k").cast("int").alias("k"))


def windowed_counts(events: DataFrame, width: str = "1 hour", watermark: str = "2 hours") -> DataFrame:
    """K9: tumbling event-time window per type, late data bounded by the
    watermark (append mode emits each window once, when it closes).
    Watermarks need a zoned TIMESTAMP: the wall-clock event time is read
    in the session zone (pinned to UTC by ``get_session``)."""
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return (events.withWatermark("ts", watermark)
                  .groupBy(F.window("ts", width).alias("w"), "event_type")
                  .agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")))


def last_watermark(query: StreamingQuery):
    """The event-time watermark a query has reached, from its own progress
    (None before the first event)."""
    marks = [p["eventTime"]["watermark"] for p in query.recentProgress
             if p["eventTime"].get("watermark")]
    return max(marks) if marks else None


def rows_of(query: StreamingQuery) -> int:
    """Input rows a query has read since it started, from its progress."""
    return sum(p["numInputRows"] for p in query.recentProgress)


def open_windows(landed: DataFrame, watermark: str | None, width: str = "1 hour") -> DataFrame:
    """K9: final flush of ``windowed_counts`` in a batch: the windows that the
    ended stream still held open at its ``watermark``. Only events of these
    windows are read (the time filter reaches the scan)."""
    if watermark is not None:
        mark = F.lit(watermark).cast("timestamp")
        landed = landed.where(F.col("ts").cast("timestamp") > mark - F.expr(f"INTERVAL {width}"))
    whole = windowed_counts(landed, width, "0 seconds")
    return whole if watermark is None else whole.where(F.col("w.end") > mark)


def hourly_baseline(history: DataFrame, width: str = "1 hour") -> DataFrame:
    """K9: batch mart of what is usual per event type: mean and deviation of
    the windows' counts, and of the values (NULL deviation: one window only)."""
    h = windowed_counts(history, width).groupBy("event_type").agg(
        F.avg("n").alias("mean_n"), F.stddev_samp("n").alias("std_n"))
    v = history.groupBy("event_type").agg(F.avg("value").alias("mean_value"),
                                          F.stddev_samp("value").alias("std_value"))
    return h.join(v, "event_type")


def rule_alerts(windows: DataFrame, baseline: DataFrame, z: float = 2.0) -> DataFrame:
    """K9 rule monitoring: closed live windows (a stream or a batch) joined to
    the baseline mart, one row per broken rule: count above or below ``z``
    deviations, mean value off by ``z`` standard errors, or a type without
    baseline. The mart has one row per event type; each micro-batch reads it
    anew, so a recomputed mart takes effect without a restart."""
    j = windows.join(baseline, "event_type", "left")
    off = F.abs(F.col("total") / F.col("n") - F.col("mean_value"))
    rules = {
        "count_high": F.col("n") > F.col("mean_n") + z * F.col("std_n"),
        "count_low": F.col("n") < F.col("mean_n") - z * F.col("std_n"),
        "value_shift": off > z * F.col("std_value") / F.sqrt("n"),
        "unknown_type": F.col("mean_n").isNull(),
    }
    broken = F.array_compact(F.array(*[F.when(c, F.lit(r)) for r, c in rules.items()]))
    return j.select(F.col("w.start").alias("window_start"), "event_type", "n", "total",
                    F.explode(broken).alias("rule"))


def latest_state(events: DataFrame) -> DataFrame:
    """K6: latest event per user (hot state), an ordinary aggregate that
    the state store keeps per key."""
    m = F.max(F.struct("ts", "event_id", "event_type", "value")).alias("m")
    return events.groupBy("user_id").agg(m).select(
        "user_id", F.col("m.ts").alias("ts"), F.col("m.event_id").alias("event_id"),
        F.col("m.event_type").alias("event_type"), F.col("m.value").alias("value"))


def run_to_files(df: DataFrame, out: str, checkpoint: str, mode: str = "append",
                 fmt: str = "parquet", available_now: bool = True,
                 interval: str = "5 seconds", partition_by=()) -> StreamingQuery:
    """Start a file sink; ``available_now`` processes what is there and
    stops (tests, backfills); otherwise a micro-batch every ``interval``."""
    w = (df.writeStream.format(fmt).outputMode(mode)
           .option("checkpointLocation", checkpoint).option("path", out))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def run_idempotent(df: DataFrame, out: str, checkpoint: str, available_now: bool = False,
                   interval: str = "1 second", after_batch=None) -> StreamingQuery:
    """K3/K5: every micro-batch writes a folder of its own (``batch=N``), so a
    batch that was written but not committed before a stop is written over
    when the restart replays it: exactly once. ``after_batch`` (batch id) runs
    between the write and the commit, for metrics."""
    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={epoch}")
        if after_batch:
            after_batch(epoch)

    w = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def run_changes(df: DataFrame, state: HotState, checkpoint: str, available_now: bool = True,
                interval: str = "5 seconds") -> StreamingQuery:
    """K6/K7 at scale: update-mode aggregate; every micro-batch hands only the
    keys it changed to the state, so its cost is the number of changed keys,
    and compaction keeps a read's cost at the size of the state."""
    w = (df.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
           .foreachBatch(state.apply))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def score_stream(events: DataFrame, model, out: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """K8: apply a batch-trained ``PipelineModel`` to a streaming frame."""
    return run_to_files(model.transform(events).select("event_id", "prediction"), out,
                        checkpoint, available_now=available_now)
