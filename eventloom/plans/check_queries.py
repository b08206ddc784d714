"""Queries: the twenty assertion queries and the monitor."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from eventloom.operators import asof, checks, enrich
from eventloom.plans.catalog import ORACLES, Tables, query


def _mean(column: str) -> str:
    return f"round(CAST(sum({column}) AS DOUBLE) / count({column}), 6)"


def _money(expression: str) -> str:
    return f"CAST({expression} AS DECIMAL(38,2))"


def _big(expression: str) -> str:
    return f"CAST({expression} AS BIGINT)"


def _verdict(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 'PASS' ELSE 'FAIL' END"


def _share(part: str, whole: str = "count(*)") -> str:
    return f"round(CAST({part} AS DOUBLE) / {whole} * 100, 6)"


_LAG = "date_sub('second', event_time, processing_time)"


def _check(name: str, build, table: str, columns: dict[str, str], label: str, where: str = "true"):
    listed = ", ".join(f"{sql} AS {column}" for column, sql in columns.items())
    query(name, f"SELECT '{label}' AS test_name, {listed} FROM {table} WHERE {where}")(build)


_check(
    "chk_enrichment_completeness",
    lambda t: checks.enrichment_completeness(t.enriched),
    "enriched",
    {
        "total_events": "count(*)",
        "events_with_user_name": "count(user_name)",
        "events_with_user_email": "count(user_email)",
        "test_result": _verdict("count(*) = count(user_name) AND count(*) = count(user_email)"),
        "enrichment_rate": _share("count(user_name)"),
    },
    "user_enrichment_completeness",
)
_check(
    "chk_purchase_amount",
    lambda t: checks.purchase_amounts(t.enriched),
    "enriched",
    {
        "total_purchase_events": "count(*)",
        "total_calculated_amount": _money("sum(purchase_amount)"),
        "avg_purchase_amount": _mean("purchase_amount"),
        "min_purchase_amount": _money("min(purchase_amount)"),
        "max_purchase_amount": _money("max(purchase_amount)"),
        "test_result": _verdict("min(purchase_amount) >= 0 AND max(purchase_amount) <= 10000"),
    },
    "purchase_amount_calculation",
    "event_type = 'purchase' AND purchase_amount > 0",
)
_check(
    "chk_temporal_join",
    lambda t: checks.temporal_join(t.enriched),
    "enriched",
    {
        "total_joined_events": "count(*)",
        "unique_users": "count(DISTINCT user_id)",
        "missing_user_data": "count(*) - count(user_name)",
        "test_result": _verdict("count(*) = count(user_name)"),
        "earliest_event": "min(event_time)",
        "latest_event": "max(event_time)",
    },
    "temporal_join_accuracy",
)
_check(
    "chk_hourly",
    lambda t: checks.hourly_aggregation(t.hourly),
    "hourly",
    {
        "total_windows": "count(*)",
        "sum_of_events_in_windows": _big("sum(total_events)"),
        "avg_events_per_window": _mean("total_events"),
        "avg_conversion_rate": "round(avg(conversion_rate), 6)",
        "test_result": _verdict("avg(conversion_rate) BETWEEN 0 AND 100"),
    },
    "hourly_aggregation_accuracy",
)
_check(
    "chk_revenue",
    lambda t: checks.revenue(t.hourly),
    "hourly",
    {
        "windows_with_revenue": "count(*)",
        "total_calculated_revenue": _money("sum(total_revenue)"),
        "avg_calculated_purchase_amount": _mean("avg_purchase_amount"),
        "test_result": _verdict("sum(total_revenue) > 0 AND avg(avg_purchase_amount) > 0"),
        "min_window_revenue": _money("min(total_revenue)"),
        "max_window_revenue": _money("max(total_revenue)"),
    },
    "revenue_calculation_accuracy",
    "total_revenue > 0",
)
_check(
    "chk_sliding",
    lambda t: checks.sliding_windows(t.sliding),
    "sliding",
    {
        "total_sliding_windows": "count(*)",
        "avg_events_per_5min_window": _mean("events_last_5min"),
        "unique_activity_levels": "count(DISTINCT activity_level)",
        "test_result": _verdict("count(DISTINCT activity_level) >= 2 AND avg(events_last_5min) >= 0"),
    },
    "sliding_window_accuracy",
)
_check(
    "chk_sessions",
    lambda t: checks.session_analysis(t.sessions),
    "sessions",
    {
        "total_sessions": "count(*)",
        "avg_session_duration": _mean("session_duration_minutes"),
        "unique_session_types": "count(DISTINCT session_type)",
        "total_session_value": _money("sum(session_value)"),
        "test_result": _verdict(
            "avg(session_duration_minutes) >= 0 AND count(DISTINCT session_type) >= 3"
        ),
    },
    "session_analysis_accuracy",
)
_check(
    "chk_daily",
    lambda t: checks.daily_rollup(t.daily),
    "daily",
    {
        "total_daily_records": "count(*)",
        "avg_daily_events": _mean("daily_events"),
        "unique_segments": "count(DISTINCT customer_segment)",
        "avg_daily_revenue": _mean("daily_revenue"),
        "test_result": _verdict("count(DISTINCT customer_segment) >= 3 AND avg(daily_revenue) >= 0"),
    },
    "daily_analytics_accuracy",
)
_check(
    "chk_anomaly",
    lambda t: checks.anomaly_logic(t.anomalies),
    "anomalies",
    {
        "total_analyzed_events": "count(*)",
        "unique_anomaly_types": "count(DISTINCT anomaly_flag)",
        "flagged_events": "count(*) FILTER (anomaly_flag <> 'NORMAL')",
        "avg_risk_score": _mean("risk_score"),
        "test_result": _verdict("count(DISTINCT anomaly_flag) >= 2 AND avg(risk_score) BETWEEN 1 AND 5"),
        "anomaly_rate": _share("count(*) FILTER (anomaly_flag <> 'NORMAL')"),
    },
    "anomaly_detection_accuracy",
)


@query("chk_cross_consistency", f"""
    SELECT 'cross_transformation_consistency' AS test_name, *,
      {_verdict('abs(total_events_enriched - total_events_hourly) <= greatest(total_events_enriched * 0.01, 10)')}
        AS test_result,
      abs(total_events_enriched - total_events_hourly) AS event_count_difference
    FROM (SELECT (SELECT count(*) FROM enriched) AS total_events_enriched,
      (SELECT {_big('sum(total_events)')} FROM hourly) AS total_events_hourly,
      (SELECT {_big('sum(session_events)')} FROM sessions) AS total_events_sessions,
      (SELECT {_big('sum(daily_events)')} FROM daily) AS total_events_daily)""")
def _(t: Tables):
    return checks.cross_consistency(t.enriched, t.hourly, t.sessions, t.daily)


_check(
    "chk_throughput",
    lambda t: checks.throughput(t.enriched),
    "enriched",
    {
        "processed_events": "count(*)",
        "unique_users_processed": "count(DISTINCT user_id)",
        "processing_window_seconds": "date_sub('second', min(processing_time), max(processing_time))",
        "events_per_second": "round(CAST(count(*) AS DOUBLE) / "
        "nullif(date_sub('second', min(processing_time), max(processing_time)), 0), 6)",
        "performance_test_result": _verdict(
            "CAST(count(*) AS DOUBLE) / "
            "nullif(date_sub('second', min(processing_time), max(processing_time)), 0) >= 1000"
        ),
    },
    "throughput_validation",
    "processing_time IS NOT NULL",
)
_check(
    "chk_latency",
    lambda t: checks.latency(t.enriched),
    "enriched",
    {
        "measured_events": "count(*)",
        "avg_latency_seconds": _mean(_LAG),
        "max_latency_seconds": f"max({_LAG})",
        "min_latency_seconds": f"min({_LAG})",
        "latency_test_result": _verdict(f"avg({_LAG}) <= 5"),
    },
    "latency_validation",
    "processing_time IS NOT NULL AND event_time IS NOT NULL",
)
_check(
    "chk_resource",
    lambda t: checks.resource_usage(t.enriched),
    "enriched",
    {
        "total_processed_events": "count(*)",
        "processing_days": "count(DISTINCT CAST(event_time AS DATE))",
        "unique_users": "count(DISTINCT user_id)",
        "avg_events_per_user": "count(*) // count(DISTINCT user_id)",
        "resource_test_result": _verdict("count(*) // count(DISTINCT user_id) <= 10000"),
    },
    "resource_usage_validation",
)
_check(
    "chk_window_bounds",
    lambda t: checks.window_boundaries(t.hourly),
    "hourly",
    {
        "total_windows": "count(*)",
        "unique_start_times": "count(DISTINCT window_start)",
        "unique_end_times": "count(DISTINCT window_end)",
        "avg_window_duration_minutes": _mean("date_sub('minute', window_start, window_end)"),
        "window_test_result": _verdict("avg(date_sub('minute', window_start, window_end)) = 60"),
    },
    "window_boundary_validation",
)
_check(
    "chk_late_data",
    lambda t: checks.late_data(t.enriched),
    "enriched",
    {
        "total_events": "count(*)",
        "on_time_events": "count(*) FILTER (event_time < processing_time)",
        "late_events": f"count(*) FILTER ({_LAG} > 60)",
        "late_data_percentage": _share(f"count(*) FILTER ({_LAG} > 60)"),
        "late_data_test_result": _verdict(f"100.0 * count(*) FILTER ({_LAG} > 60) / count(*) <= 5"),
    },
    "late_data_handling",
    "processing_time IS NOT NULL AND event_time IS NOT NULL",
)
_check(
    "chk_event_time",
    lambda t: checks.event_times(t.enriched),
    "enriched",
    {
        "events_with_event_time": "count(*)",
        "earliest_event_time": "min(event_time)",
        "latest_event_time": "max(event_time)",
        "unique_event_dates": "count(DISTINCT CAST(event_time AS DATE))",
        "event_time_test_result": _verdict("min(event_time) IS NOT NULL"),
        "time_span_days": "date_sub('day', min(event_time), max(event_time))",
    },
    "event_time_validation",
)
_check(
    "chk_join_accuracy",
    lambda t: checks.join_accuracy(t.enriched_left),
    "enriched_left",
    {
        "total_join_attempts": "count(*)",
        "successful_joins": "count(user_name)",
        "failed_joins": "count(*) - count(user_name)",
        "join_success_rate": _share("count(user_name)"),
        "join_test_result": _verdict("100.0 * count(user_name) / count(*) >= 95"),
    },
    "join_accuracy_validation",
)
_check(
    "chk_aggregation",
    lambda t: checks.aggregation_accuracy(t.hourly),
    "hourly",
    {
        "total_aggregation_windows": "count(*)",
        "sum_of_events": _big("sum(total_events)"),
        "sum_of_revenue": _money("sum(total_revenue)"),
        "avg_conversion_rate": "round(avg(conversion_rate), 6)",
        "conversion_rate_stddev": "round(stddev_samp(conversion_rate), 6)",
        "aggregation_test_result": _verdict(
            "avg(conversion_rate) BETWEEN 0 AND 100 AND sum(total_events) > 0 AND sum(total_revenue) >= 0"
        ),
    },
    "aggregation_accuracy_validation",
)
_check(
    "chk_data_types",
    lambda t: checks.data_types(t.enriched),
    "enriched",
    {
        "total_records": "count(*)",
        "valid_amounts": "count(*) FILTER (purchase_amount >= 0)",
        "valid_multipliers": "count(*) FILTER (tier_multiplier >= 1.0)",
        "valid_timestamps": "count(event_time)",
        "data_type_test_result": _verdict(
            "bool_and(coalesce(purchase_amount >= 0 AND tier_multiplier >= 1.0, false) "
            "AND event_time IS NOT NULL)"
        ),
    },
    "data_type_validation",
)


@query("chk_quality_comprehensive", f"""
    SELECT 'data_quality_comprehensive' AS test_name, * REPLACE (round(avg_session_duration, 6)
        AS avg_session_duration),
      {_verdict('enriched_count > 0 AND complete_enrichments = enriched_count AND hourly_aggregations > 0 AND sliding_aggregations > 0 AND session_count > 0 AND avg_session_duration > 0 AND daily_records > 0 AND total_daily_revenue >= 0')}
        AS comprehensive_test_result,
      round(100.0 * complete_enrichments / enriched_count, 6) AS data_completeness_percentage
    FROM (SELECT (SELECT count(*) FROM enriched) AS enriched_count,
      (SELECT count(user_name) FROM enriched) AS complete_enrichments,
      (SELECT count(*) FROM hourly) AS hourly_aggregations,
      (SELECT count(*) FROM sliding) AS sliding_aggregations,
      (SELECT count(*) FROM sessions) AS session_count,
      (SELECT avg(session_duration_minutes) FROM sessions) AS avg_session_duration,
      (SELECT count(*) FROM daily) AS daily_records,
      (SELECT {_money('sum(daily_revenue)')} FROM daily) AS total_daily_revenue)""")
def _(t: Tables):
    return checks.quality_comprehensive(t.enriched, t.hourly, t.sliding, t.sessions, t.daily)


def all_checks(t: Tables):
    """Every check with the name of its verdict column."""
    left = t.enriched_left
    return [
        (checks.enrichment_completeness(t.enriched), "test_result"),
        (checks.purchase_amounts(t.enriched), "test_result"),
        (checks.temporal_join(t.enriched), "test_result"),
        (checks.hourly_aggregation(t.hourly), "test_result"),
        (checks.revenue(t.hourly), "test_result"),
        (checks.sliding_windows(t.sliding), "test_result"),
        (checks.session_analysis(t.sessions), "test_result"),
        (checks.daily_rollup(t.daily), "test_result"),
        (checks.anomaly_logic(t.anomalies), "test_result"),
        (checks.cross_consistency(t.enriched, t.hourly, t.sessions, t.daily), "test_result"),
        (checks.throughput(t.enriched), "performance_test_result"),
        (checks.latency(t.enriched), "latency_test_result"),
        (checks.resource_usage(t.enriched), "resource_test_result"),
        (checks.window_boundaries(t.hourly), "window_test_result"),
        (checks.late_data(t.enriched), "late_data_test_result"),
        (checks.event_times(t.enriched), "event_time_test_result"),
        (checks.join_accuracy(left), "join_test_result"),
        (checks.aggregation_accuracy(t.hourly), "aggregation_test_result"),
        (checks.data_types(t.enriched), "data_type_test_result"),
        (
            checks.quality_comprehensive(t.enriched, t.hourly, t.sliding, t.sessions, t.daily),
            "comprehensive_test_result",
        ),
    ]


# Oracle names in the order of all_checks, with the checks' verdict columns.
_VERDICTS = {
    "chk_throughput": "performance_test_result",
    "chk_latency": "latency_test_result",
    "chk_resource": "resource_test_result",
    "chk_window_bounds": "window_test_result",
    "chk_late_data": "late_data_test_result",
    "chk_event_time": "event_time_test_result",
    "chk_join_accuracy": "join_test_result",
    "chk_aggregation": "aggregation_test_result",
    "chk_data_types": "data_type_test_result",
    "chk_quality_comprehensive": "comprehensive_test_result",
}


@query("union_checks", " UNION ALL ".join(
    f'SELECT test_name, {_VERDICTS.get(name, "test_result")} AS "result" FROM ({sql})'
    for name, sql in ORACLES.items() if name.startswith("chk_")))
def _(t: Tables):
    """All checks stacked. The derived tables are written once and read by every check."""
    saved = materialised(t)
    found = all_checks(saved)
    stacked = checks.union_checks([df for df, _ in found], [v for _, v in found])
    return stacked.select("test_name", "result")


def materialised(t: Tables, at_once: int = 3) -> Tables:
    """The derived tables as written tables, so that many checks do not recompute them.

    Some are written at the same time: one fills the cores that another's last tasks leave idle. Both
    joins with the users cut only busy users into time slots.
    """
    saved = Tables(t.spark, t.sf_dir)
    root = t.scratch("derived")
    busy = asof.busy_keys(t.known_events, t.users, "user_id")
    derived = {
        "enriched": enrich.enrich_events(t.user_events, t.users, busy=busy),
        "enriched_left": enrich.enrich_events(t.user_events, t.users, how="left", busy=busy),
        **{name: getattr(t, name) for name in ("hourly", "sliding", "sessions", "daily", "anomalies")},
    }

    def save(name: str) -> None:
        derived[name].write.mode("overwrite").parquet(f"{root}/{name}")

    with ThreadPoolExecutor(at_once) as pool:
        list(pool.map(save, derived))
    for name in derived:
        saved.__dict__[name] = t.spark.read.parquet(f"{root}/{name}")
    return saved
