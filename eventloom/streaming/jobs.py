"""Continuous forms of the operators.

Windowed aggregates run unchanged on a stream with a watermark. What Structured Streaming
cannot express (frames over event time, as-of lookups into a growing history) runs as the
batch operator inside ``foreachBatch``, with every output folder named by its batch, so that
a batch repeated after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from eventloom.functions.exprs import MICROS, micros
from eventloom.operators import flow, monitoring, windows
from eventloom.operators.anomaly import DAY, anomaly_detection
from eventloom.operators.asof import busy_keys, latest_per_key
from eventloom.operators.enrich import (
    EVENT_COLUMNS,
    USER_COLUMNS,
    derive,
    enrich_events,
    keep_event_types,
)
from eventloom.operators.transforms import good_rows, rejected_rows
from eventloom.sources.events import with_event_time

DELAY = "5 seconds"
CHECKPOINT_EVERY = "30 seconds"


# --- running queries -----------------------------------------------------------------------

def start_table(
    df: DataFrame, path: str, checkpoint: str, mode: str = "append", once: bool = False,
    every: str = CHECKPOINT_EVERY,
) -> StreamingQuery:
    """Exactly-once parquet sink; ``once`` processes what is available and stops."""
    writer = (
        df.writeStream.format("parquet").outputMode(mode)
        .option("checkpointLocation", checkpoint).option("path", path)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def start_batches(
    df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False,
    mode: str = "append", every: str = CHECKPOINT_EVERY,
) -> StreamingQuery:
    writer = (
        df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


# --- windowed aggregates -------------------------------------------------------------------

def hourly_stream(events: DataFrame, delay: str = DELAY) -> DataFrame:
    return windows.hourly_activity(with_event_time(events, delay=delay))


def sliding_stream(events: DataFrame, delay: str = DELAY, **options) -> DataFrame:
    return windows.sliding_activity(with_event_time(events, delay=delay), **options)


def daily_stream(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Daily totals; ``windows.with_daily_trend`` adds the comparison on the finished table."""
    return windows.daily_totals(with_event_time(events, delay=delay))


def gap_session_stream(events: DataFrame, gap: str = "30 minutes", delay: str = DELAY) -> DataFrame:
    return windows.gap_sessions_window(with_event_time(events, delay=delay), gap)


def session_stream(events: DataFrame, ttl: str = "1 day") -> DataFrame:
    """Finished sessions. A session's state lives until the watermark, which trails by the
    time to live, has passed the day of its events; a plain ``groupBy`` would keep it for ever.

    Sessions that span days come out as one part per day; ``merge_sessions`` adds them up.
    """
    timed = with_event_time(events, delay=ttl)
    day = F.window("event_timestamp", "1 day")
    parts = (
        windows.with_purchase(timed)
        .groupBy("user_id", "session_id", day)
        .agg(
            F.min("event_timestamp").alias("session_start"),
            F.max("event_timestamp").alias("session_end"),
            F.count(F.lit(1)).alias("session_events"),
            F.array_sort(F.collect_set("event_type")).alias("_types"),
            F.sum("_revenue").alias("session_value"),
            F.count_if(F.col("event_type") == "purchase").alias("_purchases"),
        )
    )
    return parts.drop("window")


def session_parts_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Sessions as they are so far, without state: each batch appends its partial totals and
    ``current_sessions`` adds them up. Old batch folders are dropped by age."""

    def write(batch: DataFrame, batch_id: int) -> None:
        windows.session_parts(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def current_sessions(spark: SparkSession, path: str, **limits) -> DataFrame:
    parts = spark.read.option("basePath", path).parquet(path).drop("batch")
    return windows.describe_sessions(windows.merge_sessions(parts), **limits)


def monitor_stream(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Per minute of arrival. Without an arrival column the clock of the batch is used."""
    if "processing_time" not in events.columns:
        events = events.withColumn("processing_time", F.current_timestamp())
    return windows.performance_monitor(with_event_time(events, "processing_time", delay))


# --- duplicates, late rows, rejects --------------------------------------------------------

def dedup_stream(events: DataFrame, key: str = "event_id", delay: str = "10 minutes") -> DataFrame:
    """Drops repeats of a key that arrive within the watermark delay of each other."""
    return with_event_time(events, delay=delay).dropDuplicatesWithinWatermark([key])


def split_writer(
    good_path: str, reject_path: str, classify: Callable[[DataFrame], DataFrame],
    between: Callable[[str], None] | None = None,
) -> Callable[[DataFrame, int], None]:
    """One pass over a batch into two outputs; ``classify`` adds ``error_reason``.

    ``between`` is called between the outputs, for instance to inject a fault. A batch that fails
    there is run again as a whole and replaces what it had written.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        split = classify(batch).persist()
        try:
            good_rows(split).write.mode("overwrite").parquet(f"{good_path}/batch={batch_id}")
            if between:
                between(f"batch {batch_id}")
            rejected_rows(split).write.mode("overwrite").parquet(f"{reject_path}/batch={batch_id}")
        finally:
            split.unpersist()

    return write


def late_writer(
    on_time_path: str, late_path: str, delay_seconds: int = 5
) -> Callable[[DataFrame, int], None]:
    """Late rows go to a table of their own before any window can drop them."""

    def classify(batch: DataFrame) -> DataFrame:
        tagged = flow.late_split(batch, delay_seconds)
        reason = F.when(F.col("is_late"), "late")
        return tagged.withColumn("error_reason", reason).drop("is_late")

    return split_writer(on_time_path, late_path, classify)


# --- joins ---------------------------------------------------------------------------------

def with_validity(users: DataFrame) -> DataFrame:
    """Versions with the time the next one starts."""
    by_version = Window.partitionBy("user_id").orderBy("valid_from")
    return users.withColumn("valid_to", F.lead("valid_from").over(by_version))


def enrich_stream(events: DataFrame, users: DataFrame, how: str = "inner") -> DataFrame:
    """Stream against a finished version history. At most one version matches an event.

    The join looks at all versions of an event's user, so this is for users with few versions;
    ``enrich_writer`` has no such limit.
    """
    versions = with_validity(users).select(
        F.col("user_id").alias("_user"),
        F.col("valid_from").cast("timestamp").alias("_from"),
        F.col("valid_to").cast("timestamp").alias("_to"),
        *USER_COLUMNS,
    )
    at = F.col("event_timestamp")
    valid = (at >= F.col("_from")) & (F.col("_to").isNull() | (at < F.col("_to")))
    arrival = [c for c in ("processing_time",) if c in events.columns]
    kept = keep_event_types(events).select(*EVENT_COLUMNS, *arrival)
    return derive(kept.join(versions, (F.col("user_id") == F.col("_user")) & valid, how))


def enrich_writer(
    read_users: Callable[[], DataFrame], path: str, how: str = "inner", **options
) -> Callable[[DataFrame, int], None]:
    """Stream against a history that grows: each batch joins the versions known by then.

    Only the users that are busy in a batch are cut into time slots.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        users = read_users()
        busy = busy_keys(batch, users, "user_id")
        enriched = enrich_events(batch, users, how, **{"busy": busy, **options})
        enriched.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def attribute_stream(
    events: DataFrame, purchases: DataFrame, within: str = "1 hour", delay: str = DELAY
) -> DataFrame:
    """Two streams: each purchase with the user's latest view at most an hour before it.

    The interval join holds an hour of views as state; the aggregate then keeps the latest
    view per purchase and emits it once the watermark, which the join holds back by ``within``, has
    passed the purchase's minute: purchases of the last hour are still open.
    """
    views = with_event_time(events, delay=delay).where(F.col("event_type") == "view").select(
        F.col("user_id").alias("_user"),
        F.col("event_id").alias("view_id"),
        F.col("event_timestamp").alias("view_time"),
    )
    bought = with_event_time(purchases, delay=delay).where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"),
        "user_id",
        F.col("event_timestamp").alias("purchase_time"),
    )
    near = (F.col("view_time") <= F.col("purchase_time")) & (
        F.col("view_time") >= F.col("purchase_time") - F.expr(f"INTERVAL {within}")
    )
    pairs = bought.join(views, (F.col("user_id") == F.col("_user")) & near)
    newest = pairs.groupBy(
        F.window("purchase_time", "1 minute"), "purchase_id", "user_id",
    ).agg(
        F.max("purchase_time").alias("purchase_time"),
        F.max(F.struct("view_time", "view_id")).alias("_view"),
    )
    return newest.select(
        "purchase_id", "user_id", "purchase_time", "_view.view_id", "_view.view_time"
    )


# --- anomalies over event time -------------------------------------------------------------

def anomaly_writer(
    spark: SparkSession, root: str, delay_seconds: int = 5, **options
) -> Callable[[DataFrame, int], None]:
    """Continuous anomaly detection: an event is judged when the watermark has passed it.

    Under ``root``: ``events`` holds accepted events by day and batch, ``watermark`` one row
    per batch, ``late`` the events behind the watermark on arrival, ``flagged`` the result. A
    batch reads the folders of the last day of events only and runs the batch operator;
    ``purge_dated`` may drop older folders.
    """
    marks = "watermark bigint, batch bigint"  # microseconds: no clock zone of the driver's

    def previous_watermark(batch_id: int) -> int | None:
        if batch_id == 0:
            return None
        rows = spark.read.schema(marks).parquet(f"{root}/watermark")
        return rows.where(F.col("batch") < batch_id).agg(F.max("watermark")).first()[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        before = previous_watermark(batch_id)
        at = F.col("event_timestamp")
        columns = ("event_id", "user_id", "event_timestamp", "event_type", "payload")
        slim = batch.select(*columns).persist()
        try:
            judge(slim, batch_id, before, at)
        finally:
            slim.unpersist()

    def judge(slim: DataFrame, batch_id: int, before: int | None, at: Column) -> None:
        seen = F.lit(False) if before is None else micros(at) <= before
        accepted = slim.where(~seen).withColumns(
            {"event_date": F.to_date(at), "batch": F.lit(batch_id)}
        )
        (
            accepted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy("event_date", "batch").parquet(f"{root}/events")
        )
        slim.where(seen).write.mode("overwrite").parquet(f"{root}/late/batch={batch_id}")

        newest = slim.agg(micros(F.max(at))).first()[0]
        reached = None if newest is None else newest - delay_seconds * MICROS
        now = max((w for w in (before, reached) if w is not None), default=None)
        spark.createDataFrame([(now,)], "watermark bigint").write.mode("overwrite").parquet(
            f"{root}/watermark/batch={batch_id}"
        )
        if now is None or now == before:
            return
        horizon = None if before is None else before - DAY * MICROS
        known = _days(spark, f"{root}/events", slim.schema, horizon, now)
        known = known.where((F.col("batch") <= batch_id) & (micros(at) <= now))
        if horizon is not None:
            known = known.where(micros(at) >= horizon)
        judged = anomaly_detection(known, keep=("event_id",), **options)
        if before is not None:
            judged = judged.where(micros(at) > before)
        judged.write.mode("overwrite").parquet(f"{root}/flagged/batch={batch_id}")

    return write


def _days(
    spark: SparkSession, path: str, schema: T.StructType, first: int | None, last: int
) -> DataFrame:
    """Event folders from the UTC day of ``first`` to that of ``last``; only those are listed."""
    full = T.StructType(
        [*schema.fields, T.StructField("event_date", T.DateType()), T.StructField("batch", T.LongType())]
    )
    reader = spark.read.schema(full).option("basePath", path)
    if first is None:
        return reader.parquet(path)
    day = DAY * MICROS
    days = [date(1970, 1, 1) + timedelta(days=n) for n in range(first // day, last // day + 1)]
    return reader.parquet(f"{path}/event_date={{{','.join(map(str, days))}}}")


# --- alerts --------------------------------------------------------------------------------

def alert_stream(
    logs: DataFrame, alert: Callable[[DataFrame], DataFrame], delay: str = DELAY
) -> DataFrame:
    """A windowed log alert on a stream of ``(ts, source_category, raw)`` lines.

    For update mode with ``batch_writer``: a window's row comes with each micro-batch that
    changes it, so an alert does not wait for its window to close. The watermark only bounds
    the state. ``current_alerts`` reads the newest row per window back; a window that once
    fired stays, with the last figures that met the condition.
    """
    return alert(with_event_time(logs, "ts", delay))


def current_alerts(written: DataFrame, keys: list[str]) -> DataFrame:
    return latest_per_key(written, keys, ["batch"]).drop("batch")


# --- alert cool-down -----------------------------------------------------------------------

def cooldown_writer(spark: SparkSession, path: str, minutes: int = 15) -> Callable[[DataFrame, int], None]:
    """Cool-down over a stream of evaluated alerts ``(rule, fired_at)``.

    What was sent before is read from the earlier batches' output: at most one row per rule
    and pause.
    """
    schema = "rule string, fired_at timestamp, batch bigint"

    def write(batch: DataFrame, batch_id: int) -> None:
        last = None
        if batch_id > 0:
            sent = spark.read.schema(schema).parquet(path).where(F.col("batch") < batch_id)
            last = sent.groupBy("rule").agg(F.max("fired_at").alias("last_sent"))
        out = monitoring.cooldown(batch, minutes, max_per_hour=None, last_sent=last)
        out.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write
