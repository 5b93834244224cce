"""Streaming queries (K-series): each builds a landing folder from
``events``, runs a Structured Streaming job to completion (availableNow)
into files in the shared checkpoint folder and returns the sink read back
as a batch DataFrame."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lodestar.session import cut_lineage, scratch_dir
from lodestar.streaming import ops as K
from lodestar.streaming.state import HotState
from lodestar.tables import SCHEMAS, Tables


def _land(spark, sf, name):
    """K2 landing zone: the events table as files by event time, as many as
    the session shuffles into (a stand-in for the bus), so the stream sees
    many micro-batches."""
    base = scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    Tables(spark, sf).events.repartitionByRange(n, "ts").write.parquet(f"{base}/landing")
    return base


#: Arrivals of the events table: thirds of its time span.
PHASES = 3


def _phases(events):
    """``events`` with ``_own``, the third of the time span an event lies in."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    ends = events.agg(F.min(us).alias("lo"), F.max(us).alias("hi"))
    lo, hi = ends.select("lo").scalar(), ends.select("hi").scalar()
    return events.withColumn("_own", F.floor((us - lo) * PHASES / (hi - lo + 1)))


def _run_arrivals(spark, arrivals, base, start):
    """Lands the rows of one arrival after the other (column ``_phase``); the
    query that ``start`` gives is started anew on its checkpoint after each
    and stops when it has read all. The last query is returned."""
    fixed = cut_lineage(arrivals)
    for p in range(PHASES):
        fixed.where(F.col("_phase") == p).drop("_phase", "_own").write.mode("append").parquet(
            f"{base}/landing")
        q = start(K.event_stream(spark, f"{base}/landing"))
        q.awaitTermination()
    return q


def _register():
    from lodestar.plans.registry import query

    @query("k_alert_stream", "K1 K3 K4 S21 F19", sql="""
    SELECT event_id, user_id, ts, 'new ' || event_type || ' by user ' || CAST(user_id AS VARCHAR) AS message,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
    FROM events WHERE event_type = 'signup'""")
    def k_alert_stream(spark, sf):
        base = _land(spark, sf, "k1")
        s = K.event_stream(spark, f"{base}/landing", files_per_batch=4)
        q = K.run_to_files(K.alerts(s), f"{base}/out", f"{base}/ckpt")
        q.awaitTermination()
        return spark.read.parquet(f"{base}/out")

    @query("k_restart_exactly_once", "K5 K3", sql="""
    SELECT count(*) AS n_alerts, count(DISTINCT event_id) AS n_distinct, count(*) AS n_read,
           TRUE AS stopped_midway
    FROM events WHERE event_type = 'signup'""")
    def k_restart_exactly_once(spark, sf):
        """A stop between two micro-batches: the query runs under a
        processing-time trigger, one file a batch, and breaks after it has
        written its second batch and before that batch is committed. More
        files land, and the restarted query replays the open batch before it
        reads them. ``n_read`` is the batches' own count of rows."""
        base = scratch_dir(spark, f"k5-{uuid.uuid4().hex}")
        e = Tables(spark, sf).events.where(F.col("event_type") == "signup")
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        early = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
        e.where(early).repartition(max(3, n), "event_id").write.parquet(f"{base}/landing")

        def start(after=None):
            s = K.event_stream(spark, f"{base}/landing", files_per_batch=1 if after else 1000)
            return K.run_idempotent(K.alerts(s), f"{base}/out", f"{base}/ckpt",
                                    interval="100 milliseconds", after_batch=after)

        def stop(epoch):
            if epoch == 1:
                raise RuntimeError("stopped after the write of a batch")

        q = start(stop)
        try:
            q.awaitTermination()
            midway = False
        except StreamingQueryException:
            midway = True
        e.where(~early).write.mode("append").parquet(f"{base}/landing")
        q = start()
        q.processAllAvailable()
        # batch 0 was committed by the first run, all others are the second's
        read = K.rows_of(q) + spark.read.parquet(f"{base}/out/batch=0").count()
        q.stop()
        out = spark.read.parquet(f"{base}/out")
        return out.agg(F.count(F.lit(1)).alias("n_alerts"),
                       F.countDistinct("event_id").alias("n_distinct"),
                       F.lit(read).cast("long").alias("n_read"),
                       F.lit(midway).alias("stopped_midway"))

    @query("k_ingest_partitioned", "K2 S13 S20", sql="""
    SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1""")
    def k_ingest_partitioned(spark, sf):
        base = _land(spark, sf, "k2")
        s = K.event_stream(spark, f"{base}/landing", files_per_batch=6)
        s = s.withColumn("day", F.to_date("ts"))
        K.run_to_files(s, f"{base}/out", f"{base}/ckpt", partition_by=["day"]).awaitTermination()
        back = spark.read.parquet(f"{base}/out")
        return back.groupBy("day").agg(F.count(F.lit(1)).alias("n"),
                                       F.round(F.sum("value"), 4).alias("total"))

    @query("k_windowed_counts", "K9 K3", sql="""
    SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total
    FROM events GROUP BY 1, 2""")
    def k_windowed_counts(spark, sf):
        """Append mode: a window is emitted once the watermark (max event
        time - 2 h) passes its end. After the stream has ended a batch over
        the last landed events closes the windows that were still open."""
        base = scratch_dir(spark, f"k9-{uuid.uuid4().hex}")
        e = _phases(Tables(spark, sf).events)
        q = _run_arrivals(spark, e.withColumn("_phase", F.col("_own")), base, lambda s: K.run_to_files(
            K.windowed_counts(s, "1 hour", "2 hours"), f"{base}/out", f"{base}/ckpt"))
        landed = spark.read.schema(SCHEMAS["events"]).parquet(f"{base}/landing")
        last = K.open_windows(landed, K.last_watermark(q), "1 hour")
        back = spark.read.schema(last.schema).parquet(f"{base}/out").unionByName(last)
        return back.select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type",
                           "n", F.round("total", 4).alias("total"))

    @query("k_rule_alerts", "K9 K3 K1", sql="""
    WITH m AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
         o AS (SELECT e.*, (epoch_us(ts) - lo) * 3 // (hi - lo + 1) AS own,
                      date_trunc('hour', ts) AS window_start FROM events e, m),
         a AS (SELECT *, least(own + CASE WHEN event_id % 50 = 0 THEN 1 ELSE 0 END, 2) AS phase FROM o),
         marks AS (SELECT p.phase, max(epoch_us(ts)) // 1000 - 7200000 AS mark
                   FROM a, range(1, 3) p(phase) WHERE a.phase < p.phase GROUP BY p.phase),
         live AS (SELECT a.* FROM a LEFT JOIN marks USING (phase)
                  WHERE mark IS NULL OR epoch_us(window_start + INTERVAL 1 HOUR) > mark * 1000),
         w AS (SELECT window_start, event_type, count(*) AS n, sum(value) AS total FROM live GROUP BY 1, 2),
         hist AS (SELECT * FROM o WHERE own = 0),
         bn AS (SELECT event_type, avg(n) AS mean_n, stddev_samp(n) AS std_n
                FROM (SELECT event_type, window_start, count(*) AS n FROM hist GROUP BY 1, 2) GROUP BY 1),
         bv AS (SELECT event_type, avg(value) AS mean_value, stddev_samp(value) AS std_value
                FROM hist GROUP BY 1),
         j AS (SELECT w.*, mean_n, std_n, mean_value, std_value
               FROM w LEFT JOIN (SELECT * FROM bn JOIN bv USING (event_type)) USING (event_type)),
         r AS (SELECT *, 'count_high' AS rule FROM j WHERE n > mean_n + 2 * std_n
               UNION ALL SELECT *, 'count_low' FROM j WHERE n < mean_n - 2 * std_n
               UNION ALL SELECT *, 'value_shift' FROM j
                         WHERE abs(total / n - mean_value) > 2 * std_value / sqrt(n)
               UNION ALL SELECT *, 'unknown_type' FROM j WHERE mean_n IS NULL)
    SELECT window_start, event_type, n, round(total, 4) AS total, rule FROM r""")
    def k_rule_alerts(spark, sf):
        """Live windows against a batch baseline (the first third of the time
        span), rule filter, alert sink. Every fiftieth event arrives a phase
        late: behind the watermark, so it counts only where its window is
        still open. Windows open at the end go through the same rules in a
        batch."""
        base = scratch_dir(spark, f"k9r-{uuid.uuid4().hex}")
        e = _phases(Tables(spark, sf).events)
        K.hourly_baseline(e.where("_own = 0")).write.parquet(f"{base}/mart")
        mart = spark.read.parquet(f"{base}/mart")
        late = F.when(F.col("event_id") % 50 == 0, F.lit(1)).otherwise(F.lit(0))
        arrivals = e.withColumn("_phase", F.least(F.col("_own") + late, F.lit(PHASES - 1)))
        q = _run_arrivals(spark, arrivals, base, lambda s: K.run_to_files(
            K.rule_alerts(K.windowed_counts(s, "1 hour", "2 hours"), mart),
            f"{base}/alerts", f"{base}/ckpt"))
        landed = spark.read.schema(SCHEMAS["events"]).parquet(f"{base}/landing")
        last = K.rule_alerts(K.open_windows(landed, K.last_watermark(q), "1 hour"), mart)
        alerts = spark.read.schema(last.schema).parquet(f"{base}/alerts").unionByName(last)
        return alerts.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                             "event_type", "n", F.round("total", 4).alias("total"), "rule")

    @query("k_latest_state", "K6 W2", sql="""
    SELECT user_id, ts, event_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1""")
    def k_latest_state(spark, sf):
        base = _land(spark, sf, "k6")
        s = K.event_stream(spark, f"{base}/landing", files_per_batch=8)
        now = K.latest_state(s)
        state = HotState(spark, f"{base}/state", now.schema, ["user_id"])
        K.run_changes(now, state, f"{base}/ckpt").awaitTermination()
        return state.read()

    @query("k_lambda_merge", "K7 U1", sql="""
    SELECT event_type, count(*) AS n FROM events GROUP BY 1""")
    def k_lambda_merge(spark, sf):
        """Batch layer (history before the cut) + speed layer (stream after
        it), merged at serve time and re-aggregated by key."""
        base = _land(spark, sf, "k7")
        cut = F.lit("2024-01-20").cast("timestamp_ntz")
        hist = Tables(spark, sf).events.where(F.col("ts") < cut)
        batch_mart = hist.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        s = K.event_stream(spark, f"{base}/landing", files_per_batch=8).where(F.col("ts") >= cut)
        speed = s.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
        state = HotState(spark, f"{base}/speed", speed.schema, ["event_type"])
        K.run_changes(speed, state, f"{base}/ckpt").awaitTermination()
        merged = batch_mart.unionByName(state.read())
        return merged.groupBy("event_type").agg(F.sum("n").alias("n"))

    @query("k_score_stream", "K8 M1 E4")
    def k_score_stream(spark, sf):
        """Model trained in batch (purchase vs other from value/hour), then
        applied to the event stream; rows-only check."""
        from pyspark.ml import Pipeline
        from pyspark.ml.classification import LogisticRegression
        from pyspark.ml.feature import SQLTransformer, VectorAssembler
        base = _land(spark, sf, "k8")
        e = Tables(spark, sf).events
        feats = SQLTransformer(statement="SELECT *, CAST(hour(ts) AS DOUBLE) AS hr, "
                                         "CAST(event_type = 'purchase' AS DOUBLE) AS label FROM __THIS__")
        pipe = Pipeline(stages=[feats, VectorAssembler(inputCols=["value", "hr"], outputCol="features"),
                                LogisticRegression(maxIter=20)])
        model = pipe.fit(e)
        s = K.event_stream(spark, f"{base}/landing", files_per_batch=8)
        K.score_stream(s, model, f"{base}/out", f"{base}/ckpt").awaitTermination()
        return spark.read.parquet(f"{base}/out").groupBy("prediction").agg(
            F.count(F.lit(1)).alias("n"))


_register()
