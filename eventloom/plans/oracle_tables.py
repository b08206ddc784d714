"""Derived tables of the SQL oracle, written for DuckDB from the table definitions.

They say independently of the Spark code what each table holds. Sums are DECIMAL(38,2),
ratios DOUBLE; names match the Spark tables.
"""

_AMOUNT = "CAST(json_extract_string(payload, '$.amount') AS DECIMAL(10,2))"
_BUY = "event_type = 'purchase'"

TABLES = {
    # --- inputs ---
    "user_events": """
        SELECT event_id, user_id,
               CASE event_type WHEN 'signup' THEN 'login' ELSE event_type END AS event_type,
               ts AS event_timestamp,
               user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
               '{"amount": ' || CAST(CAST(CAST(value AS DECIMAL(10,2)) * 10 AS DECIMAL(10,2)) AS VARCHAR)
                 || ', "product_id": "p' || json_extract_string(props, '$.k')
                 || '", "processing_time_ms": ' || (event_id % 250) || '}' AS payload,
               ts + to_seconds(CASE WHEN event_id % 100 = 0 THEN 120 ELSE event_id % 5 END)
                 AS processing_time
        FROM events""",
    "user_events_dense": """
        SELECT * REPLACE (TIMESTAMP '2024-01-01' + to_microseconds(
                 (epoch_us(event_timestamp) - epoch_us(TIMESTAMP '2024-01-01')) // 4000)
                 AS event_timestamp)
        FROM user_events""",
    "known_events": """
        SELECT * FROM user_events
        WHERE event_type IN ('purchase', 'view', 'click', 'login', 'logout')""",
    "users": """
        SELECT c_custkey AS user_id, ver,
               TIMESTAMP '2024-01-01' + to_days(CAST(CASE ver WHEN 1 THEN 1 + c_custkey % 28 ELSE 0 END AS INTEGER))
                 AS valid_from,
               c_name AS user_name,
               lower(replace(c_name, '#', '.')) || '@example.com' AS user_email,
               DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS registration_date,
               CASE (c_custkey + ver) % 3 WHEN 0 THEN 'premium' WHEN 1 THEN 'gold' ELSE 'basic' END
                 AS user_tier,
               n_name AS country, 10 + c_custkey % 60 AS age
        FROM customer JOIN nation ON c_nationkey = n_nationkey, (VALUES (0), (1)) AS v(ver)
        WHERE NOT (c_custkey % 10 = 9 AND ver = 0)""",
    "users_latest": """
        SELECT * FROM users QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ver DESC) = 1""",
    "logs": """
        SELECT ts,
               CASE event_id % 3 WHEN 0 THEN 'kafka/dev/metrics' WHEN 1 THEN 'kafka/connectors'
                 ELSE 'kafka/flink' END AS source_category,
               CASE event_id % 3
                 WHEN 0 THEN '{"consumer.lag": ' || CAST(round(value * 40) AS BIGINT)
                   || ', "consumer_group": "g' || (user_id % 3) || '", "topic": "' || event_type
                   || '", "throughput": ' || CAST(value AS DECIMAL(10,2)) || ', "partitions": 6}'
                 WHEN 1 THEN '{"connector_name": "c' || (user_id % 20) || '", "status": "' || st
                   || '", "level": "' || CASE st WHEN 'FAILED' THEN 'ERROR' ELSE 'INFO' END || '"}'
                 ELSE '{"job_name": "j' || (user_id % 4) || '", "job_id": ' || user_id
                   || ', "job_status": "' || st || '", "checkpoint_status": "'
                   || CASE st WHEN 'FAILED' THEN 'FAILED' ELSE 'COMPLETED' END
                   || '", "processing_latency": '
                   || CAST(CAST(value AS DECIMAL(10,2)) / 100 AS DECIMAL(10,4))
                   || ', "checkpoint_duration": '
                   || CAST(CAST(value AS DECIMAL(10,2)) / 10 AS DECIMAL(10,3)) || '}' END AS raw
        FROM (SELECT *, CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END AS st FROM events)""",
    "metric_lines": """
        SELECT ts, CAST(json_extract_string(raw, '$."consumer.lag"') AS BIGINT) AS lag,
               json_extract_string(raw, '$.consumer_group') AS consumer_group,
               json_extract_string(raw, '$.topic') AS topic,
               CAST(json_extract_string(raw, '$.throughput') AS DECIMAL(18,6)) AS throughput
        FROM logs WHERE source_category LIKE 'kafka/%/metrics'""",
    "connector_lines": """
        SELECT ts, json_extract_string(raw, '$.connector_name') AS connector_name,
               json_extract_string(raw, '$.status') AS status,
               json_extract_string(raw, '$.level') AS level
        FROM logs WHERE source_category = 'kafka/connectors'""",
    "job_lines": """
        SELECT ts, json_extract_string(raw, '$.job_name') AS job_name,
               json_extract_string(raw, '$.job_id') AS job_id,
               json_extract_string(raw, '$.job_status') AS job_status,
               json_extract_string(raw, '$.checkpoint_status') AS checkpoint_status,
               CAST(json_extract_string(raw, '$.processing_latency') AS DECIMAL(18,6)) AS latency,
               CAST(json_extract_string(raw, '$.checkpoint_duration') AS DECIMAL(18,6)) AS duration
        FROM logs WHERE source_category = 'kafka/flink'""",
    "test_results": """
        SELECT 'test_' || user_id AS test_name, 'suite_' || (user_id % 5) AS test_suite, status,
               CAST(value AS DECIMAL(10,2)) AS duration, ts AS "timestamp",
               CASE status WHEN 'FAILED' THEN 'err ' || event_id END AS error_message,
               CASE event_id % 3 WHEN 0 THEN 'Failure' WHEN 1 THEN 'Error' END AS error_type,
               CASE event_id % 3 WHEN 0 THEN 'dev' WHEN 1 THEN 'staging' ELSE 'prod' END
                 AS environment,
               CASE WHEN user_id % 7 <> 0 THEN 'comp_' || (user_id % 4) END AS component
        FROM (SELECT *, CASE WHEN event_id % 17 = 0 THEN 'SKIPPED' WHEN event_type = 'error'
                THEN 'FAILED' ELSE 'PASSED' END AS status FROM events)""",
    "recent_tests": """
        SELECT * FROM test_results
        WHERE "timestamp" > (SELECT max("timestamp") FROM test_results) - INTERVAL 14 DAY""",
    "suite_runs": """
        SELECT test_suite, CAST("timestamp" AS DATE) AS run_date,
               CASE WHEN avg(CASE status WHEN 'FAILED' THEN 1.0 ELSE 0 END) > 0.2 THEN 'FAILED'
                 ELSE 'PASSED' END AS status,
               CAST(floor(sum(duration)) AS BIGINT) AS duration_seconds
        FROM test_results GROUP BY 1, 2""",
    "flow_source": """
        SELECT u.event_id, u.user_id, u.event_type, u.event_timestamp,
               CAST(e.value AS DECIMAL(10,2)) AS value, u.processing_time AS delivered_at,
               u.user_id % 6 AS "partition", u.event_id AS "offset"
        FROM user_events u JOIN events e USING (event_id)""",
    "flow_sink": """
        SELECT * REPLACE (CAST(value + CASE WHEN event_id % 983 = 0 THEN 1 ELSE 0 END
                 AS DECIMAL(10,2)) AS value)
        FROM flow_source, (VALUES (0), (1)) AS c(copy)
        WHERE event_id % 997 <> 0 AND (copy = 0 OR event_id % 991 = 0)""",
    "transform_rows": """
        SELECT *, CAST(c_acctbal AS DECIMAL(10,2)) AS balance
        FROM (SELECT c_custkey AS record_id, c_name AS user_name, c_acctbal,
                lower(replace(c_name, '#', '.')) || '@example.com' AS user_email,
                CASE WHEN c_custkey % 101 = 0 THEN 'bad' ELSE CAST(c_custkey AS VARCHAR) END AS user_id,
                CASE WHEN c_custkey % 2 = 0 THEN 'true' ELSE 'false' END AS active,
                CAST(CAST(c_acctbal AS DECIMAL(10,2)) AS VARCHAR) AS score,
                CAST(1692144000 + c_custkey AS VARCHAR) AS login_time
              FROM customer)""",
    "json_lines": """
        SELECT event_id, '{"user_id": '
            || CASE WHEN event_id % 41 = 0 THEN '""' ELSE '"user' || user_id || '"' END
            || ', "event_type": "'
            || CASE event_type WHEN 'signup' THEN 'LOGIN' WHEN 'error' THEN 'INVALID_TYPE'
                 ELSE upper(event_type) END
            || '", "timestamp": '
            || CASE WHEN event_id % 37 = 0 THEN '-1' WHEN event_id % 43 = 0 THEN '"late"'
                 WHEN event_id % 47 = 0 THEN '0' ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END
            || ', "properties": {"k": ' || CASE WHEN event_id % 31 = 0 THEN '7' ELSE '"7"' END || '}'
            || CASE WHEN event_id % 29 = 0 THEN ', "extra": 1'
                 WHEN event_id % 23 = 0 THEN ', "session_id": null' ELSE ', "session_id": "s1"' END
            || CASE WHEN event_id % 53 = 0 THEN '' ELSE '}' END AS value
        FROM events""",
    "csv_rows": """
        SELECT event_id, CASE WHEN event_id % 41 <> 0 THEN 'user' || user_id END AS user_id,
               CASE WHEN event_id % 59 = 0 THEN '' ELSE upper(event_type) END AS event_type,
               CASE WHEN event_id % 37 = 0 THEN '-1' WHEN event_id % 43 = 0 THEN 'late'
                 ELSE CAST(epoch_us(ts) // 1000 AS VARCHAR) END AS "timestamp"
        FROM events""",
    "events_of_strangers": """
        SELECT CASE WHEN user_id % 90 = 0 THEN -user_id ELSE user_id END AS user_id FROM user_events""",
    "access_checks": """
        SELECT 'sa_' || (user_id % 10) AS service_account, event_type AS operation,
               event_id % 3 <> 0 AS expected_success,
               (event_id % 3 <> 0) <> (event_id % 19 = 0) AS actual_success
        FROM events""",
    # --- derived tables ---
    "enriched_left": f"""
        SELECT e.user_id, e.event_type, e.event_timestamp, e.session_id, e.payload,
               u.user_name, u.user_email, u.registration_date, u.user_tier, u.country,
               CASE WHEN {_BUY} THEN {_AMOUNT} ELSE 0 END AS purchase_amount,
               CASE u.user_tier WHEN 'premium' THEN 1.5 WHEN 'gold' THEN 1.2 ELSE 1.0 END
                 AS tier_multiplier,
               date_trunc('milliseconds', e.event_timestamp) AS event_time, e.processing_time
        FROM known_events e ASOF LEFT JOIN users u
          ON e.user_id = u.user_id AND e.event_timestamp >= u.valid_from""",
    "enriched": "SELECT * FROM enriched_left WHERE user_name IS NOT NULL",
    "hourly": f"""
        SELECT user_id, date_trunc('hour', event_timestamp) AS window_start,
               date_trunc('hour', event_timestamp) + INTERVAL 1 HOUR AS window_end,
               count(*) AS total_events, count(DISTINCT session_id) AS unique_sessions,
               count(*) FILTER ({_BUY}) AS purchase_count,
               count(*) FILTER (event_type = 'view') AS view_count,
               count(*) FILTER (event_type = 'click') AS click_count,
               count(*) FILTER (event_type = 'login') AS login_count,
               CAST(coalesce(sum({_AMOUNT}) FILTER ({_BUY}), 0) AS DECIMAL(38,2)) AS total_revenue,
               CAST(round(CAST(sum({_AMOUNT}) FILTER ({_BUY}) AS DOUBLE)
                 / count(*) FILTER ({_BUY}), 6) AS DECIMAL(14,6)) AS avg_purchase_amount,
               CAST(count(*) FILTER ({_BUY}) AS DOUBLE) / count(*) * 100 AS conversion_rate
        FROM user_events GROUP BY 1, 2, 3""",
    "sliding_types": """
        SELECT user_id, date_trunc('minute', event_timestamp) - to_minutes(i) AS window_start,
               event_type, count(*) AS n
        FROM user_events, range(5) AS hop(i) GROUP BY ALL""",
    "sliding": """
        SELECT user_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end,
               CAST(sum(n) AS BIGINT) AS events_last_5min, count(*) AS unique_event_types,
               string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS event_types_array,
               CASE WHEN sum(n) > 100 THEN 'HIGH_ACTIVITY' WHEN sum(n) > 50 THEN 'MEDIUM_ACTIVITY'
                 ELSE 'LOW_ACTIVITY' END AS activity_level
        FROM sliding_types GROUP BY 1, 2""",
    "sessions": f"""
        SELECT user_id, session_id, min(event_timestamp) AS session_start,
               max(event_timestamp) AS session_end, count(*) AS session_events,
               count(DISTINCT event_type) AS unique_event_types_in_session,
               date_sub('minute', min(event_timestamp), max(event_timestamp))
                 AS session_duration_minutes,
               CAST(coalesce(sum({_AMOUNT}) FILTER ({_BUY}), 0) AS DECIMAL(38,2)) AS session_value,
               CASE WHEN count(*) FILTER ({_BUY}) > 0 THEN 'CONVERTER' WHEN count(*) > 20
                 THEN 'BROWSER' WHEN count(*) < 5 THEN 'QUICK_VISIT' ELSE 'REGULAR' END AS session_type
        FROM user_events GROUP BY 1, 2""",
    "daily_totals": f"""
        SELECT user_id, CAST(date_trunc('day', event_timestamp) AS TIMESTAMP) AS date_window,
               count(*) AS daily_events, count(DISTINCT session_id) AS daily_sessions,
               count(DISTINCT event_type) AS unique_event_types,
               count(DISTINCT hour(event_timestamp)) AS active_hours,
               min(event_timestamp) AS first_event_time, max(event_timestamp) AS last_event_time,
               count(*) FILTER (event_type = 'view') AS page_views,
               count(*) FILTER (event_type = 'click') AS clicks,
               count(*) FILTER ({_BUY}) AS purchases,
               CAST(coalesce(sum({_AMOUNT}) FILTER ({_BUY}), 0) AS DECIMAL(38,2)) AS daily_revenue
        FROM user_events GROUP BY 1, 2""",
    "daily": """
        SELECT *, CASE WHEN daily_events > 100 AND purchases > 5 THEN 'HIGH_VALUE_CUSTOMER'
                 WHEN daily_events > 50 AND purchases > 2 THEN 'REGULAR_CUSTOMER'
                 WHEN daily_events > 20 AND purchases = 0 THEN 'BROWSER'
                 ELSE 'OCCASIONAL_USER' END AS customer_segment,
               lag(daily_events) OVER by_day AS previous_day_events,
               coalesce(CAST(daily_events - lag(daily_events) OVER by_day AS DOUBLE)
                 / lag(daily_events) OVER by_day * 100, 0) AS activity_growth_rate
        FROM daily_totals WINDOW by_day AS (PARTITION BY user_id ORDER BY date_window)""",
}


def _anomaly(events: str, types_over: int = 5) -> str:
    def last(span: str, what: str = "count(*)") -> str:
        return (
            f"{what} OVER (PARTITION BY user_id ORDER BY event_timestamp RANGE BETWEEN "
            f"INTERVAL {span} PRECEDING AND CURRENT ROW)"
        )

    return f"""
        SELECT user_id, event_timestamp, event_type, events_last_hour, events_last_day,
               CASE WHEN burst > 20 THEN 'SUSPICIOUS_ACTIVITY'
                 WHEN {_BUY} AND {_AMOUNT} > 1000 THEN 'HIGH_VALUE_TRANSACTION'
                 WHEN kinds > {types_over} THEN 'RAPID_BEHAVIOR_CHANGE' ELSE 'NORMAL' END AS anomaly_flag,
               CASE WHEN burst > 50 THEN 5 WHEN burst > 30 THEN 3 WHEN burst > 15 THEN 2 ELSE 1 END
                 AS risk_score
        FROM (SELECT *, {last("1 HOUR")} AS events_last_hour, {last("1 DAY")} AS events_last_day,
                {last("5 MINUTE")} AS burst, {last("1 MINUTE", "count(DISTINCT event_type)")} AS kinds
              FROM {events})"""


TABLES["anomalies"] = _anomaly("user_events_dense")
TABLES["anomalies_natural"] = _anomaly("user_events")
TABLES["anomalies_lowered"] = _anomaly("user_events_dense", types_over=3)
