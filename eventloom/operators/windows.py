"""Time-window aggregates over the event stream, the same code for tables and streams.

Distinct counts are built in two steps - one row per (key, window, value), then the window -
which is exact, combines on the map side, keeps no per-group set, and is legal on streams.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions import classify, exprs
from eventloom.functions.exprs import MICROS
from eventloom.operators.skew import slot_of


def _of_type(name: str) -> Column:
    return F.count_if(F.col("event_type") == name)


def _bounds() -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def with_purchase(events: DataFrame) -> DataFrame:
    """Parses the JSON amount once per row.

    ``_amount`` is NULL for events that are no purchase, ``_revenue`` zero.
    """
    is_purchase = F.col("event_type") == "purchase"
    zero = F.lit(0).cast("decimal(10,2)")
    return events.withColumn("_amount", exprs.purchase_only_amount()).withColumn(
        "_revenue", F.when(is_purchase, F.col("_amount")).otherwise(zero)
    )


def hourly_activity(events: DataFrame, size: str = "1 hour") -> DataFrame:
    per_session = (
        with_purchase(events)
        .groupBy("user_id", F.window("event_timestamp", size), "session_id")
        .agg(
            F.count(F.lit(1)).alias("_events"),
            _of_type("purchase").alias("_purchases"),
            _of_type("view").alias("_views"),
            _of_type("click").alias("_clicks"),
            _of_type("login").alias("_logins"),
            F.sum("_revenue").alias("_revenue"),
            F.sum("_amount").alias("_paid"),
            F.count("_amount").alias("_payments"),
        )
    )
    grouped = per_session.groupBy("user_id", "window").agg(
        F.sum("_events").alias("total_events"),
        F.count("session_id").alias("unique_sessions"),
        F.sum("_purchases").alias("purchase_count"),
        F.sum("_views").alias("view_count"),
        F.sum("_clicks").alias("click_count"),
        F.sum("_logins").alias("login_count"),
        F.sum("_revenue").cast("decimal(20,2)").alias("total_revenue"),
        F.try_divide(F.sum("_paid"), F.sum("_payments")).cast("decimal(14,6)")
        .alias("avg_purchase_amount"),
    )
    return grouped.select(
        "user_id",
        *_bounds(),
        "total_events",
        "unique_sessions",
        "purchase_count",
        "view_count",
        "click_count",
        "login_count",
        "total_revenue",
        "avg_purchase_amount",
        exprs.percent(F.col("purchase_count"), F.col("total_events")).alias("conversion_rate"),
    )


def event_counts_hourly(events: DataFrame) -> DataFrame:
    """The documented small form of the hourly table."""
    return (
        events.groupBy("user_id", F.window("event_timestamp", "1 hour"))
        .agg(F.count(F.lit(1)).alias("event_count"), _of_type("purchase").alias("purchase_count"))
        .select("user_id", *_bounds(), "event_count", "purchase_count")
    )


def _seconds(span: str) -> int:
    """Seconds of ``"5 minutes"`` and the like."""
    number, unit = span.split()
    return int(number) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.removesuffix("s")]


def _stream_hops(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """Windows with their pane counts, as an aggregate."""
    return panes.groupBy("user_id", F.window("window", size, slide)).agg(
        F.sum("_n").alias("events_last_5min"),
        F.collect_list(F.struct("event_type", "_n")).alias("_parts"),
    )


def _hops(panes: DataFrame, size: str, slide: str) -> DataFrame:
    """``_stream_hops`` of a table, where only panes are shuffled and not their copies.

    A pane looks at the panes of its user that follow within the size, and gives the windows
    in which it comes first. A user has at most a pane per step and type, however many events.
    """
    at = F.unix_micros(F.col("window.start").cast("timestamp"))
    ordered = Window.partitionBy("user_id").orderBy("_at")
    ahead = ordered.rangeBetween(0, _seconds(size) * MICROS - 1)
    seen = panes.withColumn("_at", at).withColumns({
        "_previous": F.lag("_at").over(ordered),
        "_ahead": F.collect_list(F.struct("event_type", "_n", "_at")).over(ahead),
    })
    # Rows of one pane differ in type only; the first of them stands for all.
    first = seen.where(F.col("_previous").isNull() | (F.col("_previous") < F.col("_at")))
    hops = first.select("user_id", "_previous", "_ahead", F.window("window", size, slide).alias("window"))
    starts, ends = (F.unix_micros(F.col(f"window.{c}").cast("timestamp")) for c in ("start", "end"))
    own = hops.where(F.col("_previous").isNull() | (F.col("_previous") < starts))
    inside = F.when(F.size("_ahead") == 1, F.col("_ahead")).otherwise(F.filter("_ahead", lambda e: e["_at"] < ends))
    counted = own.select("user_id", "window", inside.alias("_parts"))
    total = F.aggregate("_parts", F.lit(0).cast("bigint"), lambda n, e: n + e["_n"])
    total = F.when(F.size("_parts") == 1, F.element_at("_parts", 1)["_n"]).otherwise(total)
    return counted.select("user_id", "window", total.alias("events_last_5min"), "_parts")


def sliding_activity(
    events: DataFrame,
    size: str = "5 minutes",
    slide: str = "1 minute",
    high: int = 100,
    medium: int = 50,
    as_array: bool = False,
) -> DataFrame:
    """Hopping windows with the multiset of event types seen.

    Events are counted once per user, type and pane, the longest span that fits both the size and
    the slide; a window adds up its panes. So the copies that a hop makes are of pane counts, not of
    events, however many events a pane has.

    The multiset is a map from type to multiplicity, which holds the whole collection in a
    bounded row: no group's events are ever gathered. ``as_array=True`` spells the multiset out as a
    sorted array, one element per event; use it only where windows are known to be small.
    """
    pane = f"{math.gcd(_seconds(size), _seconds(slide))} seconds"
    panes = events.groupBy("user_id", F.window("event_timestamp", pane), "event_type").agg(
        F.count(F.lit(1)).alias("_n")
    )
    # At most one entry per pane and type.
    grouped = _stream_hops(panes, size, slide) if events.isStreaming else _hops(panes, size, slide)
    seen = F.filter(F.array_sort(F.array_distinct(F.transform("_parts", lambda e: e["event_type"]))), lambda k: k.isNotNull())

    def total(kind: Column) -> Column:
        of_kind = F.filter("_parts", lambda e: e["event_type"] == kind)
        return F.aggregate(of_kind, F.lit(0).cast("bigint"), lambda n, e: n + e["_n"])

    known = F.transform(seen, lambda kind: F.struct(kind.alias("event_type"), total(kind).alias("_n")))
    if as_array:
        spelled = F.transform(known, lambda e: F.array_repeat(e["event_type"], e["_n"].cast("int")))
        types = F.flatten(spelled)
    else:
        types = F.map_from_entries(known)
    kinds = F.size(seen)

    # A window with one known entry needs no merging, which costs more than all the rest of its row.
    only = F.element_at("_parts", 1)
    plain = (F.size("_parts") == 1) & only["event_type"].isNotNull()
    one = F.array_repeat(only["event_type"], only["_n"].cast("int")) if as_array else F.create_map(only["event_type"], only["_n"])
    types, kinds = F.when(plain, one).otherwise(types), F.when(plain, 1).otherwise(kinds)
    return grouped.select(
        "user_id",
        *_bounds(),
        "events_last_5min",
        kinds.cast("bigint").alias("unique_event_types"),
        types.alias("event_types_array"),
        classify.activity_level(F.col("events_last_5min"), high, medium).alias("activity_level"),
    )


def session_parts(events: DataFrame) -> DataFrame:
    """Partial totals per session; parts of the same session add up with ``merge_sessions``."""
    return (
        with_purchase(events)
        .groupBy("user_id", "session_id")
        .agg(
            F.min("event_timestamp").alias("session_start"),
            F.max("event_timestamp").alias("session_end"),
            F.count(F.lit(1)).alias("session_events"),
            F.array_sort(F.collect_set("event_type")).alias("_types"),
            F.sum("_revenue").alias("session_value"),
            _of_type("purchase").alias("_purchases"),
        )
    )


def merge_sessions(parts: DataFrame) -> DataFrame:
    """One part per session and batch -> one part per session."""
    return parts.groupBy("user_id", "session_id").agg(
        F.min("session_start").alias("session_start"),
        F.max("session_end").alias("session_end"),
        F.sum("session_events").alias("session_events"),
        F.array_distinct(F.flatten(F.collect_set("_types"))).alias("_types"),
        F.sum("session_value").cast("decimal(20,2)").alias("session_value"),
        F.sum("_purchases").alias("_purchases"),
    )


def describe_sessions(parts: DataFrame, browser_over: int = 20, quick_under: int = 5) -> DataFrame:
    kind = classify.session_type(
        F.col("session_events"), F.col("_purchases"), browser_over, quick_under
    )
    return parts.select(
        "user_id",
        "session_id",
        "session_start",
        "session_end",
        "session_events",
        F.size("_types").cast("bigint").alias("unique_event_types_in_session"),
        exprs.elapsed("MINUTE", "session_start", "session_end").alias("session_duration_minutes"),
        "session_value",
        kind.alias("session_type"),
    )


def user_sessions(events: DataFrame, browser_over: int = 20, quick_under: int = 5) -> DataFrame:
    return describe_sessions(session_parts(events), browser_over, quick_under)


def daily_totals(events: DataFrame) -> DataFrame:
    """One row per user and day, before the comparison with the previous day."""
    one = F.lit(1).cast("bigint")
    hour_bit = F.call_function("shiftleft", one, F.hour("event_timestamp"))
    per_session = (
        with_purchase(events)
        .groupBy("user_id", F.window("event_timestamp", "1 day"), "session_id")
        .agg(
            F.count(F.lit(1)).alias("_events"),
            F.array_sort(F.collect_set("event_type")).alias("_types"),
            F.bit_or(hour_bit).alias("_hours"),
            F.min("event_timestamp").alias("_first"),
            F.max("event_timestamp").alias("_last"),
            _of_type("view").alias("_views"),
            _of_type("click").alias("_clicks"),
            _of_type("purchase").alias("_purchases"),
            F.sum("_revenue").alias("_revenue"),
        )
    )
    # A set of the sessions' type sets: bounded by the type domain, not by the sessions.
    types = F.array_distinct(F.flatten(F.collect_set("_types")))
    grouped = per_session.groupBy("user_id", "window").agg(
        F.sum("_events").alias("daily_events"),
        F.count("session_id").alias("daily_sessions"),
        F.size(types).cast("bigint").alias("unique_event_types"),
        F.bit_count(F.bit_or("_hours")).cast("bigint").alias("active_hours"),
        F.min("_first").alias("first_event_time"),
        F.max("_last").alias("last_event_time"),
        F.sum("_views").alias("page_views"),
        F.sum("_clicks").alias("clicks"),
        F.sum("_purchases").alias("purchases"),
        F.sum("_revenue").cast("decimal(20,2)").alias("daily_revenue"),
    )
    return grouped.select(
        "user_id", F.col("window.start").alias("date_window"), *grouped.columns[2:]
    )


def with_daily_trend(daily: DataFrame, **segments) -> DataFrame:
    """Adds segment, previous day's events and growth. A user has one row per day here."""
    by_day = Window.partitionBy("user_id").orderBy("date_window")
    previous = F.col("previous_day_events")
    growth = F.when(
        previous > 0, exprs.percent(F.col("daily_events") - previous, previous)
    ).otherwise(0.0)
    segment = classify.customer_segment(F.col("daily_events"), F.col("purchases"), **segments)
    return (
        daily.withColumn("customer_segment", segment)
        .withColumn("previous_day_events", F.lag("daily_events", 1).over(by_day))
        .withColumn("activity_growth_rate", growth)
    )


def daily_analytics(events: DataFrame, **segments) -> DataFrame:
    return with_daily_trend(daily_totals(events), **segments)


def gap_sessions(events: DataFrame, gap_seconds: int = 1800) -> DataFrame:
    """Sessions per user that end after a pause longer than the gap.

    Two events in the same gap-wide slot are never more than a gap apart, so a slot belongs to
    one session as a whole. Slots are built with a map-side combine; only their first and last
    times are ordered per user, at most one row per slot whatever the user's event count.
    """
    return merge_gaps(events, ["user_id"], "event_timestamp", gap_seconds)


def merge_gaps(events: DataFrame, keys: list[str], ts: str, gap_seconds: int) -> DataFrame:
    gap = gap_seconds * MICROS
    at = exprs.micros(ts)
    slots = (
        events.where(F.col(ts).isNotNull())
        .groupBy(*keys, slot_of(at, gap).alias("_slot"))
        .agg(
            F.min(ts).alias("session_start"),
            F.max(ts).alias("session_end"),
            F.count(F.lit(1)).alias("session_events"),
        )
    )
    ordered = Window.partitionBy(*keys).orderBy("_slot")
    pause = exprs.micros("session_start") - exprs.micros(F.lag("session_end").over(ordered))
    starts = F.when(pause.isNull() | (pause > gap), 1).otherwise(0)
    numbered = slots.withColumn("_starts", starts).withColumn(
        "_session",
        F.sum("_starts").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    )
    return (
        numbered.groupBy(*keys, "_session")
        .agg(
            F.min("session_start").alias("session_start"),
            F.max("session_end").alias("session_end"),
            F.sum("session_events").alias("session_events"),
        )
        .drop("_session")
    )


def gap_sessions_window(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """The streaming form: Spark's own session window (its end is last event plus gap)."""
    return (
        events.groupBy("user_id", F.session_window("event_timestamp", gap).alias("window"))
        .agg(F.max("event_timestamp").alias("session_end"), F.count(F.lit(1)).alias("session_events"))
        .select(
            "user_id", F.col("window.start").alias("session_start"), "session_end", "session_events"
        )
    )


def performance_monitor(events: DataFrame, arrival: str = "processing_time") -> DataFrame:
    """Per minute of arrival: records, users and the mean of the JSON processing time."""
    taken = exprs.json_value("payload", "$.processing_time_ms").try_cast("double")
    per_user = (
        events.withColumn("_ms", taken)
        .groupBy(F.window(arrival, "1 minute"), "user_id")
        .agg(
            F.count(F.lit(1)).alias("_records"),
            F.sum("_ms").alias("_ms"),
            F.count("_ms").alias("_timed"),
        )
    )
    return (
        per_user.groupBy("window")
        .agg(
            F.sum("_records").alias("processed_records"),
            F.count("user_id").alias("unique_users"),
            exprs.ratio(F.sum("_ms"), F.sum("_timed")).alias("avg_processing_time_ms"),
        )
        .select(
            F.lit("performance_metrics").alias("metric_type"),
            "processed_records",
            "unique_users",
            "avg_processing_time_ms",
            F.col("window.end").alias("measurement_time"),
        )
    )


def time_slices(df: DataFrame, size: str, ts: str = "ts") -> DataFrame:
    """Adds ``timeslice``, the start of the bucket a row falls into."""
    return df.withColumn("timeslice", F.window(ts, size)["start"])
