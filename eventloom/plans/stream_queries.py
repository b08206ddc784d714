"""Queries that run a real streaming query over the events table and return what it wrote.

The oracle is the batch definition over the rows a stream can have finished: append mode
emits a window once the watermark (newest event minus the delay) has passed its end.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventloom.operators import monitoring, windows
from eventloom.plans.catalog import ORACLES, Tables, query
from eventloom.plans.core import _ENRICHED, SESSIONS_SQL
from eventloom.plans.log_queries import _FIRED, fired_alerts
from eventloom.sinks import buckets
from eventloom.sinks import tables as sinks
from eventloom.sources import events as event_sources
from eventloom.sources import testdata
from eventloom.streaming import delivery, jobs, stateful

_CLOSED = "(SELECT max(event_timestamp) - INTERVAL 5 SECOND FROM user_events)"


def event_stream(t: Tables) -> DataFrame:
    """The user event stream over the events table; times are instants for the watermark."""
    events = testdata.events_of(testdata.raw_event_stream(t.spark, t.sf_dir))
    return events.withColumns(
        {c: F.col(c).cast("timestamp") for c in ("event_timestamp", "processing_time")}
    )


def in_slices(t: Tables, run: Callable[[DataFrame], None], slices: int = 3) -> None:
    """Feeds the same rows in consecutive time spans: the files of a span arrive, the job runs
    over what is new and stops, and the next span finds it restarted on its checkpoint.

    The events are derived once, in tasks of a bounded size however the table's files are cut, into one
    folder per span; a span arrives when its folder is moved to where the stream looks.
    """
    staged, path = t.scratch("staged"), t.scratch("slices")
    events = testdata.events_of(testdata.spread(t.raw_events, f"{t.sf_dir}/events.parquet"))
    events = events.withColumns(
        {c: F.col(c).cast("timestamp") for c in ("event_timestamp", "processing_time")}
    )
    day = F.date_diff("event_timestamp", F.lit(testdata.START).cast("date"))
    part = F.least(F.call_function("div", day * slices, F.lit(30)), F.lit(slices - 1))
    spans = events.withColumn("span", part.cast("int")).where(F.col("span").between(0, slices - 1))
    spans.write.partitionBy("span").parquet(staged)
    for i in range(slices):
        _arrive(t, f"{staged}/span={i}", f"{path}/span-{i}", events.schema)
        run(t.spark.readStream.schema(events.schema).parquet(f"{path}/span-*"))


def _arrive(t: Tables, staged: str, path: str, schema: T.StructType) -> None:
    """Moves a folder of finished files; for a span without rows an empty file arrives."""
    hadoop = t.spark._jvm.org.apache.hadoop.fs
    source, target = hadoop.Path(staged), hadoop.Path(path)
    files = source.getFileSystem(t.spark._jsc.hadoopConfiguration())
    if not files.exists(source):
        t.spark.createDataFrame([], schema).write.parquet(path)
    elif not (files.mkdirs(target.getParent()) and files.rename(source, target)):
        raise OSError(f"{staged} could not be moved to {path}")


def run_table(t: Tables, df: DataFrame, name: str) -> DataFrame:
    path = t.scratch(name)
    jobs.start_table(df, path, f"{path}-checkpoint", once=True).awaitTermination()
    return t.spark.read.schema(df.schema).parquet(path)


def run_slices(t: Tables, name: str, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What one job wrote that was started again for each slice of the events."""
    path, schemas = t.scratch(name), []

    def run(stream: DataFrame) -> None:
        out = build(stream)
        schemas.append(out.schema)
        jobs.start_table(out, path, f"{path}-checkpoint", once=True).awaitTermination()

    in_slices(t, run)
    return t.spark.read.schema(schemas[0]).parquet(path)


def run_batches(
    t: Tables, df: DataFrame, write: Callable[[DataFrame, int], None], path: str, mode: str = "append"
) -> None:
    jobs.start_batches(df, write, f"{path}-checkpoint", once=True, mode=mode).awaitTermination()


@query("user_activity_hourly_stream", f"""
    SELECT user_id, window_start, window_end, total_events, unique_sessions, purchase_count,
      total_revenue FROM hourly WHERE window_end <= {_CLOSED}""")
def _(t: Tables):
    out = run_table(t, jobs.hourly_stream(event_stream(t)), "hourly")
    return out.select(
        "user_id", "window_start", "window_end", "total_events", "unique_sessions",
        "purchase_count", "total_revenue",
    )


@query("user_activity_sliding_stream", f"""
    SELECT user_id, window_start, events_last_5min, unique_event_types, event_types_array,
      activity_level FROM sliding WHERE window_end <= {_CLOSED}""")
def _(t: Tables):
    out = run_table(t, jobs.sliding_stream(event_stream(t)), "sliding")
    return out.drop("window_end")


@query("user_analytics_daily_stream", f"""
    SELECT * REPLACE (round(activity_growth_rate, 6) AS activity_growth_rate) FROM daily
    WHERE date_window + INTERVAL 1 DAY <= {_CLOSED}""")
def _(t: Tables):
    """Totals from the stream; segment, previous day and growth on the finished table."""
    totals = run_table(t, jobs.daily_stream(event_stream(t)), "daily")
    return windows.with_daily_trend(totals)


@query("session_gap_window_stream", f"""
    WITH g AS (SELECT user_id, event_timestamp AS ts, CASE WHEN event_timestamp
            - lag(event_timestamp) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS first
          FROM user_events WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp)),
      n AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS session_events
    FROM n GROUP BY user_id, s HAVING max(ts) + INTERVAL 30 MINUTE <= {_CLOSED}""")
def _(t: Tables):
    return run_table(t, jobs.gap_session_stream(event_stream(t)), "gaps")


@query("perf_monitor_stream", """
    SELECT count(*) AS processed_records, count(DISTINCT user_id) AS unique_users,
      date_trunc('minute', processing_time) + INTERVAL 1 MINUTE AS measurement_time
    FROM user_events GROUP BY 3
    HAVING date_trunc('minute', processing_time) + INTERVAL 1 MINUTE
      <= (SELECT max(processing_time) - INTERVAL 5 SECOND FROM user_events)""")
def _(t: Tables):
    out = run_table(t, jobs.monitor_stream(event_stream(t)), "monitor")
    return out.select("processed_records", "unique_users", "measurement_time")


@query("wm_bounded", f"""
    SELECT date_trunc('hour', event_timestamp) AS window_start, count(*) AS events
    FROM user_events GROUP BY 1
    HAVING date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR <= {_CLOSED}""")
def _(t: Tables):
    """Counts per hour under a five-second bound on disorder."""
    events = jobs.with_event_time(event_stream(t), delay="5 seconds")
    counted = events.groupBy(F.window("event_timestamp", "1 hour")).agg(
        F.count(F.lit(1)).alias("events")
    )
    out = run_table(t, counted.select(F.col("window.start").alias("window_start"), "events"), "wm")
    return out


@query("window_trigger", """
    SELECT date_trunc('day', event_timestamp)::TIMESTAMP AS window_start, count(*) AS events
    FROM user_events GROUP BY 1""")
def _(t: Tables):
    """Update mode: windows are emitted while open; the last state of each is the result."""
    path = t.scratch("trigger")

    def run(stream: DataFrame) -> None:
        counted = (
            jobs.with_event_time(stream)
            .groupBy(F.window("event_timestamp", "1 day"))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(F.col("window.start").alias("window_start"), "events")
        )
        run_batches(t, counted, sinks.append_changes(path), path, mode="update")

    in_slices(t, run)
    return sinks.current_rows(t.spark, path, ["window_start"], ["events"])


@query("late_split_stream", """
    SELECT event_id, date_sub('second', event_timestamp, processing_time) AS late_by_seconds,
      CASE WHEN date_sub('second', event_timestamp, processing_time) > 5 THEN 'late' END AS error_reason
    FROM user_events""")
def _(t: Tables):
    path = t.scratch("late")
    run_batches(
        t, event_stream(t), jobs.late_writer(f"{path}/on_time", f"{path}/late"), path
    )
    columns = "event_id bigint, late_by_seconds bigint, error_reason string"
    sides = [t.spark.read.schema(columns).parquet(f"{path}/{side}") for side in ("on_time", "late")]
    return sides[0].unionByName(sides[1]).drop("batch")


@query("dedup_stream", "SELECT event_id, user_id, event_type FROM user_events")
def _(t: Tables):
    """Every event sent twice within the watermark; one of each survives."""
    doubled = event_stream(t).withColumn("_copy", F.explode(F.array(F.lit(0), F.lit(1)))).drop("_copy")
    out = run_table(t, jobs.dedup_stream(doubled), "dedup")
    return out.select("event_id", "user_id", "event_type")


@query("user_enrichment_stream", f"""
    SELECT {_ENRICHED} FROM enriched WHERE event_timestamp <= least(
      (SELECT max(event_timestamp) FROM user_events WHERE event_type <> 'error'),
      (SELECT max(valid_from) FROM users)) - INTERVAL 5 SECOND""")
def _(t: Tables):
    """Two streams that arrive in the same slices; event time is that of the slower one."""
    path, arrived = t.scratch("versions"), []
    versions = t.users.withColumn("valid_from", F.col("valid_from").cast("timestamp"))
    day = F.date_diff("valid_from", F.lit(testdata.START).cast("date"))
    part = F.least(F.call_function("div", day * 3, F.lit(30)), F.lit(2))

    def build(stream: DataFrame) -> DataFrame:
        versions.where(part == len(arrived)).write.mode("append").parquet(path)
        arrived.append(part)
        changes = t.spark.readStream.schema(versions.schema).parquet(path)
        return stateful.enrich_versions_stream(stream, changes)

    return run_slices(t, "enriched", build)


@query("user_enrichment_finished_history", f"SELECT {_ENRICHED} FROM enriched")
def _(t: Tables):
    return run_table(t, jobs.enrich_stream(event_stream(t), t.users), "enriched")


@query("user_enrichment_growing_history", f"SELECT {_ENRICHED} FROM enriched")
def _(t: Tables):
    """Each micro-batch joins the version table as it is when the batch runs."""
    path = t.scratch("growing")
    write = jobs.enrich_writer(lambda: t.users, path)
    in_slices(t, lambda stream: run_batches(t, stream, write, path))
    return t.spark.read.parquet(path).drop("batch")


@query("stream_stream_join_stream", """
    SELECT p.event_id AS purchase_id, p.user_id, p.event_timestamp AS purchase_time,
      v.event_id AS view_id, v.event_timestamp AS view_time
    FROM (SELECT * FROM user_events WHERE event_type = 'purchase') p
    ASOF JOIN (SELECT * FROM user_events WHERE event_type = 'view') v
      ON p.user_id = v.user_id AND p.event_timestamp >= v.event_timestamp
    WHERE p.event_timestamp - v.event_timestamp <= INTERVAL 1 HOUR
      AND date_trunc('minute', p.event_timestamp) + INTERVAL 1 MINUTE <= (
        SELECT max(event_timestamp) - INTERVAL 5 SECOND - INTERVAL 1 HOUR FROM user_events)""")
def _(t: Tables):
    """Purchases of the last hour are still open: the join holds the watermark back by its interval."""
    out = jobs.attribute_stream(event_stream(t), event_stream(t))
    return run_table(t, out, "attributed")


_ANOMALIES_SO_FAR = """
    SELECT event_id, a.user_id, a.event_timestamp, a.event_type, events_last_hour, events_last_day,
      anomaly_flag, risk_score
    FROM anomalies_natural a JOIN user_events u
      ON a.user_id = u.user_id AND a.event_timestamp = u.event_timestamp
      AND a.event_type = u.event_type
    WHERE a.event_timestamp <= (SELECT max(event_timestamp) - INTERVAL 5 SECOND FROM user_events)"""


@query("user_anomaly_stream", _ANOMALIES_SO_FAR)
def _(t: Tables):
    return run_slices(t, "anomalies", lambda stream: stateful.anomaly_stream(stream, keep=("event_id",)))


@query("user_anomaly_stream_folders", _ANOMALIES_SO_FAR)
def _(t: Tables):
    """The batch operator over the folders of the last day, for users too busy for one task."""
    path = t.scratch("anomaly")
    write = jobs.anomaly_writer(t.spark, path)
    in_slices(t, lambda stream: run_batches(t, stream, write, f"{path}/job"))
    return t.spark.read.parquet(f"{path}/flagged").drop("batch")


@query("user_sessions_stream", SESSIONS_SQL)
def _(t: Tables):
    """Partial totals per micro-batch, added up on reading."""
    path = t.scratch("sessions")
    write = jobs.session_parts_writer(path)
    in_slices(t, lambda stream: run_batches(t, stream, write, path))
    return jobs.current_sessions(t.spark, path)


@query("state_ttl", """
    SELECT * FROM sessions WHERE date_trunc('day', session_start) + INTERVAL 1 DAY
      <= (SELECT max(event_timestamp) - INTERVAL 1 DAY FROM user_events)""")
def _(t: Tables):
    """Session state that expires a day behind the newest event."""
    parts = run_table(t, jobs.session_stream(event_stream(t)), "ttl")
    return windows.describe_sessions(windows.merge_sessions(parts))


_SENT = f"""
    WITH RECURSIVE {_FIRED},
      grid AS (SELECT DISTINCT "rule", fired_at FROM fired),
      sent AS (
        SELECT "rule", min(fired_at) AS fired_at FROM grid GROUP BY 1
        UNION ALL
        SELECT s."rule", (SELECT min(g.fired_at) FROM grid g WHERE g."rule" = s."rule"
          AND g.fired_at >= s.fired_at + INTERVAL 15 MINUTE) AS fired_at
        FROM sent s WHERE s.fired_at IS NOT NULL)
    SELECT "rule", fired_at FROM sent WHERE fired_at IS NOT NULL"""


@query("alert_cooldown_stream", _SENT)
def _(t: Tables):
    """The alerts arrive day by day in three parts, at a job that is restarted between them."""
    path, out = t.scratch("fired"), t.scratch("sent")
    fired = fired_alerts(t).select("rule", F.col("fired_at").cast("timestamp").alias("fired_at"))
    day = F.date_diff("fired_at", F.lit(testdata.START).cast("date"))
    for part in range(3):
        fired.where(F.least(F.call_function("div", day, F.lit(10)), F.lit(2)) == part).write.mode("append").parquet(path)
        alerts = stateful.cooldown_stream(t.spark.readStream.schema(fired.schema).parquet(path))
        jobs.start_table(alerts, out, f"{out}-checkpoint", once=True).awaitTermination()
    return t.spark.read.schema(alerts.schema).parquet(out)


@query("alert_cooldown_stream_folders", _SENT)
def _(t: Tables):
    path = t.scratch("alerts")
    fired = fired_alerts(t).select("rule", F.col("fired_at").cast("timestamp").alias("fired_at"))
    fired.distinct().write.parquet(path)
    stream = t.spark.readStream.schema("rule string, fired_at timestamp").parquet(path)
    out = f"{path}-out"
    run_batches(t, stream, jobs.cooldown_writer(t.spark, out), out)
    return t.spark.read.parquet(out).drop("batch")


@query("state_ttl_per_key", f"""
    WITH g AS (SELECT user_id, event_type, event_timestamp AS ts, CASE WHEN event_timestamp
            - lag(event_timestamp) OVER w <= INTERVAL 1 DAY THEN 0 ELSE 1 END AS first
          FROM user_events WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp)),
      n AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM g)
    SELECT user_id, min(ts) AS first_event, max(ts) AS last_event, count(*) AS events,
      count(*) FILTER (event_type = 'purchase') AS purchases
    FROM n GROUP BY user_id, s HAVING max(ts) + INTERVAL 1 DAY < {_CLOSED}""")
def _(t: Tables):
    """A user's totals live until the user has been idle for a day, however long that takes."""
    return run_slices(t, "idle", lambda stream: stateful.idle_totals_stream(stream, 86400))


def _alerts(t: Tables, alert: Callable[[DataFrame], DataFrame], keys: list[str]) -> DataFrame:
    """The log lines arrive in two parts, day by day, at a job that is restarted between them."""
    path = t.scratch("log-lines")
    out = f"{path}-out"
    logs = t.logs.withColumn("ts", F.col("ts").cast("timestamp"))
    day = F.date_diff("ts", F.lit(testdata.START).cast("date"))
    for early in (True, False):
        logs.where((day < 15) == F.lit(early)).write.mode("append").parquet(path)
        stream = jobs.alert_stream(t.spark.readStream.schema(logs.schema).parquet(path), alert)
        run_batches(t, stream, jobs.batch_writer(out), out, mode="update")
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    return jobs.current_alerts(t.spark.read.schema(schema).parquet(out), keys)


@query("alert_consumer_lag_stream")
def _(t: Tables):
    return _alerts(t, monitoring.consumer_lag_alert, ["window_start", "consumer_group", "topic"])


@query("alert_connector_failure_stream")
def _(t: Tables):
    alert = partial(monitoring.connector_failure_alert, source=monitoring.CONNECTORS)
    return _alerts(t, alert, ["window_start", "connector_name"])


@query("alert_error_rate_stream")
def _(t: Tables):
    alert = partial(monitoring.error_rate_alert, source=monitoring.CONNECTORS)
    return _alerts(t, alert, ["timeslice"])


@query("alert_job_failure_stream")
def _(t: Tables):
    return _alerts(t, monitoring.job_failure_alert, ["window_start", "job_name", "job_id"])


@query("alert_checkpoint_failure_stream")
def _(t: Tables):
    alert = partial(monitoring.checkpoint_failure_alert, threshold=1)
    return _alerts(t, alert, ["timeslice", "job_name"])


# Every window of the finished input has been written, so the oracles are those of the batch form.
for _name in ("consumer_lag", "connector_failure", "error_rate", "job_failure"):
    ORACLES[f"alert_{_name}_stream"] = ORACLES[f"alert_{_name}"]
ORACLES["alert_checkpoint_failure_stream"] = ORACLES["alert_checkpoint_failure_lowered"]


@query("exactly_once", "SELECT event_id, user_id FROM user_events")
def _(t: Tables):
    """A job stopped and started again on its checkpoint writes each event once."""
    path = t.scratch("once")

    def run(stream: DataFrame) -> None:
        for _attempt in range(2):
            out = stream.select("event_id", "user_id")
            jobs.start_table(out, path, f"{path}-checkpoint", once=True).awaitTermination()

    in_slices(t, run)
    return t.spark.read.schema("event_id bigint, user_id bigint").parquet(path)


@query("recovery", f"""
    SELECT user_id, window_start, total_events FROM hourly WHERE window_end <= {_CLOSED}""")
def _(t: Tables):
    """Windowed state survives restarts between the slices of the input."""
    path = t.scratch("recovery")

    def run(stream: DataFrame) -> None:
        hourly = jobs.hourly_stream(stream)
        jobs.start_table(hourly, path, f"{path}-checkpoint", once=True).awaitTermination()

    in_slices(t, run, slices=2)
    out = t.spark.read.schema("user_id bigint, window_start timestamp, total_events bigint")
    return out.parquet(path)


@query("exactly_once_two_outputs", """
    SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN 'event_type' END AS error_reason
    FROM user_events""")
def _(t: Tables):
    """The job dies in every slice between the two outputs of its batch, and is started again."""
    path = t.scratch("two-outputs")

    def classify(batch: DataFrame) -> DataFrame:
        slim = batch.select("event_id", "event_type")
        return slim.withColumn("error_reason", F.when(F.col("event_type") == "error", "event_type"))

    def run(stream: DataFrame) -> None:
        def die(_stage: str) -> None:
            raise ConnectionError("the job dies between its outputs")

        for between in (die, None):
            write = jobs.split_writer(f"{path}/good", f"{path}/bad", classify, between)
            try:
                run_batches(t, stream, write, path)
            except StreamingQueryException:
                if between is None:
                    raise

    in_slices(t, run)
    columns = "event_id bigint, event_type string, error_reason string"
    sides = [t.spark.read.schema(columns).parquet(f"{path}/{side}") for side in ("good", "bad")]
    return sides[0].unionByName(sides[1]).drop("batch")


def _rewrite(t: Tables, files: list[str]) -> None:
    """Puts a record that must not be read into files of these names."""
    hadoop = t.spark._jvm.org.apache.hadoop.fs
    for name in files:
        path = hadoop.Path(name)
        out = path.getFileSystem(t.spark._jsc.hadoopConfiguration()).create(path, True)
        out.write(bytearray(b'{"event_id": -1}\n'))
        out.close()


@query("src_object_store_continuous", """
    SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, event_timestamp, session_id, payload
    FROM user_events""")
def _(t: Tables):
    """Files arrive in two parts, two a trigger, and are archived; between the runs those of the first
    part are written anew under their names."""
    path, out = t.scratch("objects"), t.scratch("ingested")
    early = F.day("event_timestamp") <= 15
    for part, rows in enumerate((t.user_events.where(early), t.user_events.where(~early))):
        folder = f"{path}/topics/part-{part}"
        sinks.write_lines(rows.repartition(5, "event_id"), folder)
        files = [r[0] for r in t.spark.read.text(folder).select(F.input_file_name()).distinct().collect()]
        stream = event_sources.object_store(
            t.spark, path, event_sources.EVENT_SCHEMA, streaming=True, topics_dir="topics", files_per_trigger=2,
            archive=f"{path}-archive",
        )
        columns = stream.select("event_id", "user_id", "event_type", "event_timestamp", "session_id", "payload")
        jobs.start_table(columns, out, f"{out}-checkpoint", once=True).awaitTermination()
        if part == 0:
            _rewrite(t, files)
    return t.spark.read.schema(columns.schema).parquet(out)


@query("sink_upsert_buckets", """
    SELECT user_id, ver, user_name, user_tier, CASE WHEN ver = 1 THEN country END AS country
    FROM users_latest WHERE user_id % 13 <> 5""")
def _(t: Tables):
    """A stream of changes into copy-on-write buckets: first versions, then second ones with a new
    column and with deletions, then the last batch once more."""
    path, users = t.scratch("buckets"), t.users
    columns = ["user_id", "ver", "user_name", "user_tier"]
    write = buckets.bucket_writer(path, ["user_id"], ["ver"], deleted="gone", buckets=16)
    write(users.where("ver = 0").select(*columns).withColumn("gone", F.lit(False)), 0)
    leaving = (F.col("user_id") % 13 == 5).alias("gone")
    second = users.where("ver = 1").select(*columns, "country", leaving)
    write(second, 1)
    write(second.withColumn("user_name", F.lit("twice")), 1)
    return buckets.read_buckets(t.spark, path).select(*columns, "country")


_BATCH_SLICE = "least(date_diff('day', DATE '2024-01-01', CAST(event_timestamp AS DATE)) * 3 // 30, 2)"


@query("split_dlq_retries", """
    SELECT event_id, CASE WHEN event_id % 4999 = 17 THEN 'refused' END AS error_reason,
      CASE WHEN event_id % 4999 = 17 THEN 3 END AS attempts FROM user_events""")
def _(t: Tables):
    """A sink that refuses some records: after three attempts they alone are set apart."""
    path = t.scratch("delivered")

    def constrained(rows: pa.RecordBatch) -> pa.RecordBatch:
        """Refuses records as they come to be written, naming the first."""
        ids = rows.column("event_id")
        left = pc.subtract(ids, pc.multiply(pc.divide(ids, 4999), 4999))
        refused = ids.filter(pc.equal(left, 17))
        if len(refused):
            raise ValueError(f"event {refused[0]} refused")
        return rows

    write = delivery.delivering_writer(
        delivery.FolderSink(f"{path}/good", accept=constrained), delivery.FolderSink(f"{path}/bad"), backoff_seconds=0.01
    )
    slim = event_stream(t).select("event_id", "event_type")
    run_batches(t, slim, write, path)
    columns = "event_id bigint, error_reason string, attempts int"
    good, bad = [t.spark.read.schema(columns).parquet(f"{path}/{side}") for side in ("good", "bad")]
    told = F.col("error_reason").contains(F.concat(F.lit("event "), F.col("event_id").cast("string"), F.lit(" refused")))
    bad = bad.withColumn("error_reason", F.when(told, "refused").otherwise(F.col("error_reason")))
    return good.unionByName(bad).select("event_id", "error_reason", "attempts")


@query("sink_metrics_observed", f"""
    SELECT {_BATCH_SLICE} AS batch, count(*) AS "rows", count(*) FILTER (event_type = 'error') AS errors,
      max(event_timestamp) AS newest FROM user_events GROUP BY 1""")
def _(t: Tables):
    """Figures of every micro-batch, gathered by the job that writes it."""
    path = t.scratch("observed")
    checks = {
        "rows": F.count(F.lit(1)), "errors": F.count_if(F.col("event_type") == "error"),
        "newest": F.max("event_timestamp"),
    }
    write = delivery.observed_writer(jobs.batch_writer(f"{path}/out"), f"{path}/metrics", checks)
    in_slices(t, lambda stream: run_batches(t, stream, write, path))
    rows = t.spark.read.schema("rows long, errors long, newest timestamp, batch long").parquet(f"{path}/metrics")
    return rows.select("batch", "rows", "errors", "newest")

