"""Queries: per-row derivations, joins, windows, trailing counts."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import classify, exprs
from eventloom.operators import anomaly, asof, checks, compare, enrich, windows
from eventloom.plans.catalog import Tables, query
from eventloom.sources.events import compacted_latest

_AMOUNT = "CAST(json_extract_string(payload, '$.amount') AS DECIMAL(10,2))"

# --- per-row derivations -------------------------------------------------------------------


@query("proj_purchase_amount", f"""
    SELECT event_id, event_type, CAST(CASE WHEN event_type = 'purchase' THEN {_AMOUNT} ELSE 0 END
      AS DECIMAL(38,2)) AS purchase_amount FROM user_events""")
def _(t: Tables):
    return t.user_events.select(
        "event_id", "event_type", exprs.purchase_amount().alias("purchase_amount")
    )


@query("proj_tier_multiplier", """
    SELECT user_id, ver, user_tier, CAST(CASE user_tier WHEN 'premium' THEN 1.5 WHEN 'gold' THEN 1.2
      ELSE 1.0 END AS DOUBLE) AS tier_multiplier FROM users""")
def _(t: Tables):
    return t.users.select(
        "user_id", F.col("ver"), "user_tier", exprs.tier_multiplier().alias("tier_multiplier")
    )


@query("filter_event_types", "SELECT event_id, event_type FROM known_events")
def _(t: Tables):
    return enrich.keep_event_types(t.user_events).select("event_id", "event_type")


@query("proj_event_time", """
    SELECT event_id, date_trunc('milliseconds', event_timestamp) AS event_time FROM user_events""")
def _(t: Tables):
    return t.user_events.select("event_id", exprs.event_time().alias("event_time"))


@query("proj_processing_time", "SELECT event_id, processing_time FROM user_events")
def _(t: Tables):
    return t.user_events.select(
        "event_id", F.col("processing_time").cast("timestamp").alias("processing_time")
    )


@query("proj_user_events_transformed", f"""
    SELECT user_id, event_type, event_timestamp, session_id, payload,
      date_trunc('milliseconds', event_timestamp) AS event_time,
      json_extract_string(payload, '$.product_id') AS product_id,
      CAST(CASE WHEN event_type = 'purchase' THEN {_AMOUNT} ELSE 0 END AS DECIMAL(38,2))
        AS purchase_amount, processing_time
    FROM user_events WHERE event_type IN ('purchase', 'view', 'click')""")
def _(t: Tables):
    return enrich.transform_events(t.user_events)


@query("proj_transformed_users", """
    SELECT user_id, upper(user_name) AS user_name, age,
      CASE WHEN age >= 18 THEN 'adult' ELSE 'minor' END AS age_group FROM users""")
def _(t: Tables):
    return enrich.transform_users(t.users)


@query("case_activity_level", """
    SELECT user_id, window_start, events_last_5min, CASE WHEN events_last_5min > 2 THEN 'HIGH_ACTIVITY'
      WHEN events_last_5min > 1 THEN 'MEDIUM_ACTIVITY' ELSE 'LOW_ACTIVITY' END AS activity_level
    FROM sliding""")
def _(t: Tables):
    level = classify.activity_level(F.col("events_last_5min"), high=2, medium=1)
    return t.sliding.select("user_id", "window_start", "events_last_5min", level.alias("activity_level"))


@query("case_session_type", "SELECT user_id, session_id, session_type FROM sessions")
def _(t: Tables):
    return t.sessions.select("user_id", "session_id", "session_type")


@query("case_customer_segment", """
    SELECT user_id, date_window, CASE WHEN daily_events > 4 AND purchases > 1 THEN 'HIGH_VALUE_CUSTOMER'
      WHEN daily_events > 3 AND purchases > 0 THEN 'REGULAR_CUSTOMER'
      WHEN daily_events > 2 AND purchases = 0 THEN 'BROWSER' ELSE 'OCCASIONAL_USER' END
      AS customer_segment FROM daily_totals""")
def _(t: Tables):
    daily = windows.daily_analytics(t.user_events, high=(4, 1), regular=(3, 0), browser_over=2)
    return daily.select("user_id", "date_window", "customer_segment")


@query("case_anomaly_flag", """
    SELECT user_id, event_timestamp, event_type, anomaly_flag FROM anomalies_lowered""")
def _(t: Tables):
    flagged = anomaly.anomaly_detection(t.user_events_dense, types_over=3)
    return flagged.select("user_id", "event_timestamp", "event_type", "anomaly_flag")


@query("case_risk_score", """
    SELECT user_id, event_timestamp, event_type, risk_score FROM anomalies""")
def _(t: Tables):
    return t.anomalies.select("user_id", "event_timestamp", "event_type", "risk_score")


@query("scalar_functions", """
    SELECT event_id, json_extract_string(payload, '$.product_id') AS product_id,
      json_extract_string(payload, '$.absent') AS absent,
      hour(event_timestamp) AS hour_of_day, CAST(event_timestamp AS DATE) AS day,
      date_sub('second', event_timestamp, processing_time) AS late_seconds,
      date_sub('minute', TIMESTAMP '2024-01-01', event_timestamp) AS minutes_since,
      date_sub('day', TIMESTAMP '2024-01-01', event_timestamp) AS days_since,
      event_timestamp - INTERVAL 1 MINUTE AS minute_before,
      abs(event_id - 500) AS distance, greatest(event_id % 7, 3) AS at_least_three,
      upper(event_type) AS upper_type, event_id // 7 AS sevenths,
      event_type IN ('view', 'click') AS browsing, event_id BETWEEN 10 AND 20 AS in_range,
      session_id IS NOT NULL AS has_session, event_type <> 'view' AS no_view,
      strftime(event_timestamp, '%Y-%m-%d') AS day_text,
      regexp_matches(json_extract_string(payload, '$.product_id'), '^[0-9]+$') AS numeric_product,
      CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS is_error,
      CASE WHEN event_id < 60 THEN event_id || 's'
        WHEN event_id < 3600 THEN (event_id // 60) || 'm ' || (event_id % 60) || 's'
        ELSE (event_id // 3600) || 'h ' || (event_id % 3600 // 60) || 'm ' || (event_id % 60) || 's'
        END AS duration_text
    FROM user_events""")
def _(t: Tables):
    ts, key = F.col("event_timestamp"), F.col("event_id")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    product = exprs.json_value("payload", "$.product_id")
    return t.user_events.select(
        "event_id",
        product.alias("product_id"),
        exprs.json_value("payload", "$.absent").alias("absent"),
        F.hour(ts).cast("bigint").alias("hour_of_day"),
        F.to_date(ts).alias("day"),
        exprs.elapsed("SECOND", ts, F.col("processing_time")).alias("late_seconds"),
        exprs.elapsed("MINUTE", start, ts).alias("minutes_since"),
        exprs.elapsed("DAY", start, ts).alias("days_since"),
        (ts - F.make_dt_interval(mins=F.lit(1))).alias("minute_before"),
        F.abs(key - 500).alias("distance"),
        F.greatest(key % 7, F.lit(3).cast("bigint")).alias("at_least_three"),
        F.upper("event_type").alias("upper_type"),
        exprs.int_div(key, F.lit(7).cast("bigint")).alias("sevenths"),
        F.col("event_type").isin("view", "click").alias("browsing"),
        key.between(10, 20).alias("in_range"),
        F.col("session_id").isNotNull().alias("has_session"),
        (F.col("event_type") != "view").alias("no_view"),
        F.date_format(ts, "yyyy-MM-dd").alias("day_text"),
        product.rlike("^[0-9]+$").alias("numeric_product"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("is_error"),
        exprs.duration_text(key).alias("duration_text"),
    )


# --- joins ---------------------------------------------------------------------------------

_ENRICHED = """user_id, event_type, event_timestamp, session_id, payload, user_name, user_email,
    registration_date, user_tier, country, CAST(purchase_amount AS DECIMAL(38,2)) AS purchase_amount,
    CAST(tier_multiplier AS DOUBLE) AS tier_multiplier, event_time, processing_time"""


@query("user_enrichment", f"SELECT {_ENRICHED} FROM enriched")
def _(t: Tables):
    return t.enriched


@query("user_enrichment_left", f"SELECT {_ENRICHED} FROM enriched_left")
def _(t: Tables):
    return t.enriched_left


@query("user_enrichment_split_keys", f"SELECT {_ENRICHED} FROM enriched")
def _(t: Tables):
    """Day slots: few carried versions."""
    return enrich.enrich_events(t.user_events, t.users, slot_seconds=86400)


@query("user_enrichment_shuffled", f"SELECT {_ENRICHED} FROM enriched_left")
def _(t: Tables):
    """One-minute slots: nearly every event sees a carried version."""
    return enrich.enrich_events(t.user_events, t.users, how="left", slot_seconds=60)


@query("src_compacted_latest", """
    SELECT user_id, ver, valid_from, user_name, user_tier FROM users_latest WHERE user_id % 7 <> 3""")
def _(t: Tables):
    """A topic with tombstones: for some users the last record is one, for others one lies between
    two versions and hides nothing in the end."""
    columns = ["user_id", "ver", "valid_from", "user_name", "user_tier"]
    records = t.users.select(*columns, F.lit(False).alias("deleted"))
    ends = t.users.where("ver = 1 AND user_id % 7 IN (3, 4)").select(
        "user_id", F.lit(2).alias("ver"),
        F.when(F.col("user_id") % 7 == 3, F.timestamp_add("DAY", F.lit(1), "valid_from"))
        .otherwise(F.timestamp_add("HOUR", F.lit(-12), "valid_from")).alias("valid_from"),
        F.lit(None).cast("string").alias("user_name"), F.lit(None).cast("string").alias("user_tier"),
        F.lit(True).alias("deleted"),
    )
    latest = compacted_latest(records.unionByName(ends), "user_id", "valid_from", "ver", F.col("deleted"))
    return latest.select(*columns)


@query("lookup_join", """
    SELECT e.event_id, e.user_id, e.event_type, u.user_name, u.user_tier, u.country
    FROM user_events e LEFT JOIN users_latest u USING (user_id)""")
def _(t: Tables):
    latest = asof.latest_per_key(t.users, "user_id", ["valid_from", "ver"])
    return enrich.lookup_join(t.user_events, latest).select(
        "event_id", "user_id", "event_type", "user_name", "user_tier", "country"
    )


_ATTRIBUTED = """
    SELECT p.event_id AS purchase_id, p.user_id, p.event_timestamp AS purchase_time,
      v.event_id AS view_id, v.event_timestamp AS view_time,
      date_sub('second', v.event_timestamp, p.event_timestamp) AS seconds_to_purchase
    FROM (SELECT * FROM user_events WHERE event_type = 'purchase') p
    ASOF JOIN (SELECT * FROM user_events WHERE event_type = 'view') v
      ON p.user_id = v.user_id AND p.event_timestamp >= v.event_timestamp
    WHERE p.event_timestamp - v.event_timestamp <= INTERVAL 1 HOUR"""


@query("stream_stream_join", _ATTRIBUTED)
def _(t: Tables):
    return enrich.attribute_purchases(t.user_events)


@query("cross_join_scalars", """
    SELECT (SELECT count(*) FROM enriched) AS enriched, (SELECT count(*) FROM user_events) AS events,
      (SELECT CAST(sum(session_events) AS BIGINT) FROM sessions) AS in_sessions,
      (SELECT CAST(sum(daily_events) AS BIGINT) FROM daily) AS in_days""")
def _(t: Tables):
    return checks.stacked_scalars(
        {
            "enriched": t.enriched.agg(F.count(F.lit(1))),
            "events": t.user_events.agg(F.count(F.lit(1))),
            "in_sessions": t.sessions.agg(F.sum("session_events")),
            "in_days": t.daily.agg(F.sum("daily_events")),
        }
    )


@query("scalar_subqueries", """
    SELECT (SELECT count(*) FROM user_events) AS events,
      (SELECT max(event_timestamp) FROM user_events) AS newest,
      (SELECT count(*) FROM sessions) AS sessions,
      (SELECT CAST(sum(daily_revenue) AS DECIMAL(38,2)) FROM daily) AS revenue""")
def _(t: Tables):
    return checks.one_row(
        {
            "events": t.user_events.agg(F.count(F.lit(1))),
            "newest": t.user_events.agg(F.max("event_timestamp")),
            "sessions": t.sessions.agg(F.count(F.lit(1))),
            "revenue": t.daily.agg(F.sum("daily_revenue")),
        }
    )


@query("diff_join", """
    WITH b AS (SELECT * FROM users WHERE ver = 0), a AS (SELECT * FROM users WHERE ver = 1),
      j AS (SELECT coalesce(b.user_id, a.user_id) AS user_id, b.user_id IS NULL AS added,
              a.user_id IS NULL AS removed, b.user_tier AS tb, a.user_tier AS ta,
              CAST(b.valid_from AS VARCHAR) AS fb, CAST(a.valid_from AS VARCHAR) AS fa
            FROM b FULL JOIN a ON b.user_id = a.user_id)
    SELECT user_id, '<added>' AS field, NULL AS "before", NULL AS "after" FROM j WHERE added
    UNION ALL SELECT user_id, '<removed>', NULL, NULL FROM j WHERE removed
    UNION ALL SELECT user_id, 'user_tier', tb, ta FROM j
      WHERE NOT added AND NOT removed AND tb IS DISTINCT FROM ta
    UNION ALL SELECT user_id, 'valid_from', fb, fa FROM j
      WHERE NOT added AND NOT removed AND fb IS DISTINCT FROM fa""")
def _(t: Tables):
    users = t.users
    return compare.diff_join(
        users.where("ver = 0"), users.where("ver = 1"), ["user_id"],
        ["user_name", "user_tier", "valid_from", "country"],
    )


# --- windows -------------------------------------------------------------------------------

HOURLY_SQL = """SELECT user_id, window_start, window_end, total_events, unique_sessions, purchase_count,
    view_count, click_count, login_count, total_revenue,
    round(CAST(avg_purchase_amount AS DOUBLE), 6) AS avg_purchase_amount,
    round(conversion_rate, 6) AS conversion_rate FROM hourly"""
SLIDING_SQL = """SELECT user_id, window_start, window_end, events_last_5min, unique_event_types,
    event_types_array, activity_level FROM sliding"""
SESSIONS_SQL = "SELECT * FROM sessions"
DAILY_SQL = """SELECT * REPLACE (round(activity_growth_rate, 6) AS activity_growth_rate) FROM daily"""
GAP_SQL = """
    WITH g AS (SELECT user_id, event_timestamp AS ts, CASE WHEN event_timestamp
            - lag(event_timestamp) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS first
          FROM user_events WINDOW w AS (PARTITION BY user_id ORDER BY event_timestamp)),
      n AS (SELECT *, sum(first) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM g)
    SELECT user_id, min(ts) AS session_start, max(ts) AS session_end, count(*) AS session_events
    FROM n GROUP BY user_id, s"""
MONITOR_SQL = """
    SELECT 'performance_metrics' AS metric_type, count(*) AS processed_records,
      count(DISTINCT user_id) AS unique_users,
      round(avg(CAST(json_extract_string(payload, '$.processing_time_ms') AS DOUBLE)), 6)
        AS avg_processing_time_ms,
      date_trunc('minute', processing_time) + INTERVAL 1 MINUTE AS measurement_time
    FROM user_events GROUP BY date_trunc('minute', processing_time)"""


@query("user_activity_hourly", HOURLY_SQL)
def _(t: Tables):
    return t.hourly


@query("user_activity_sliding", SLIDING_SQL)
def _(t: Tables):
    return t.sliding


@query("user_activity_sliding_dense", """
    WITH w AS (SELECT user_id, date_trunc('minute', event_timestamp) - to_minutes(i) AS window_start,
        count(*) AS events_last_5min, count(DISTINCT event_type) AS unique_event_types
      FROM user_events_dense, range(5) AS hop(i) GROUP BY 1, 2)
    SELECT *, CASE WHEN events_last_5min > 20 THEN 'HIGH_ACTIVITY' WHEN events_last_5min > 10
      THEN 'MEDIUM_ACTIVITY' ELSE 'LOW_ACTIVITY' END AS activity_level FROM w""")
def _(t: Tables):
    table = windows.sliding_activity(t.user_events_dense, high=20, medium=10)
    return table.drop("window_end", "event_types_array")


@query("user_sessions", SESSIONS_SQL)
def _(t: Tables):
    return t.sessions


@query("user_analytics_daily", DAILY_SQL)
def _(t: Tables):
    return t.daily


@query("event_count_hourly_simple", """
    SELECT user_id, window_start, window_end, total_events AS event_count, purchase_count
    FROM hourly""")
def _(t: Tables):
    return windows.event_counts_hourly(t.user_events)


@query("session_gap_window", GAP_SQL)
def _(t: Tables):
    return windows.gap_sessions(t.user_events)


@query("session_gap_window_builtin", GAP_SQL)
def _(t: Tables):
    return windows.gap_sessions_window(t.user_events)


@query("perf_monitor_1min", MONITOR_SQL)
def _(t: Tables):
    return windows.performance_monitor(t.user_events)


@query("win_bounds", """
    SELECT date_trunc('hour', event_timestamp) AS tumble_start,
      date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS tumble_end, count(*) AS events
    FROM user_events GROUP BY ALL""")
def _(t: Tables):
    w = F.window("event_timestamp", "1 hour")
    return (
        t.user_events.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("events"))
        .select(F.col("w.start").alias("tumble_start"), F.col("w.end").alias("tumble_end"), "events")
    )


def _slices(size: str, bucket: str, name: str) -> None:
    @query(name, f"""
        SELECT source_category, time_bucket(INTERVAL '{bucket}', ts) AS timeslice, count(*) AS lines
        FROM logs GROUP BY ALL""")
    def _(t: Tables):
        sliced = windows.time_slices(t.logs, size)
        return sliced.groupBy("source_category", "timeslice").agg(F.count(F.lit(1)).alias("lines"))


_slices("1 minute", "1 minute", "timeslice_1m")
_slices("5 minutes", "5 minutes", "timeslice_5m")
_slices("10 minutes", "10 minutes", "timeslice_10m")

# --- trailing counts -----------------------------------------------------------------------


@query("user_anomaly_detection", "SELECT * FROM anomalies_natural")
def _(t: Tables):
    return anomaly.anomaly_detection(t.user_events)


@query("user_anomaly_detection_dense", "SELECT * FROM anomalies")
def _(t: Tables):
    return t.anomalies


@query("user_anomaly_detection_split_keys", "SELECT * FROM anomalies_lowered")
def _(t: Tables):
    """The dense events in one-minute slots."""
    return anomaly.anomaly_detection(t.user_events_dense, types_over=3, slot_seconds=60)
